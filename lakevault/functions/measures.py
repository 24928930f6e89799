"""Measures that come out equal whatever the order in which partitions are combined."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def money(amount: str | Column) -> Column:
    """A stored double as exact cents; sums over it do not depend on row order.

    An amount that no 18 digits hold is null, so that it cannot stop a view; ``quality.lost_amounts`` counts them.
    """
    column = F.col(amount) if isinstance(amount, str) else amount
    return column.try_cast(MONEY)


def money_sum(amount: str | Column) -> Column:
    return F.sum(money(amount)).cast("double")


def money_avg(amount: str | Column) -> Column:
    return F.sum(money(amount)).cast("double") / F.count(money(amount))


def exact_avg(number: str | Column) -> Column:
    """Average of a whole-number column as double, nulls ignored."""
    column = F.col(number) if isinstance(number, str) else number
    return F.sum(column).cast("double") / F.count(column)


def complete_days(start: str, end: str) -> Column:
    """Complete 24-hour days from start to end, towards zero; negative when end is earlier."""
    return F.timestamp_diff("DAY", F.col(start), F.col(end))


def value_counts(df: DataFrame, group: str, value: str) -> DataFrame:
    """Rows of (group, value, n, running): how often each value occurs and how many rows lie at or below it.

    The counting runs as a partial and a final aggregate, so the ordered step sees distinct values,
    not rows: for money that is at most the number of different amounts in cents.
    """
    counts = df.groupBy(group, value).agg(F.count(F.lit(1)).alias("n"))
    upwards = Window.partitionBy(group).orderBy(value)
    return counts.withColumn("running", F.sum("n").over(upwards))
