"""Reports on declared constraints and on the health of the event stream."""
from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakevault.functions.measures import money
from lakevault.sources.schemas import SOURCES, Source

# Fixed value: a landed event older than this when it reaches the vault counts as backlog.
BACKLOG_SECONDS = 900


def duplicate_keys(table: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once, and how often."""
    return table.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Values of a reference that exist in the child only, with the number of child rows.

    The child is counted per value first, so a value that very many rows share is one row when it
    is looked up.
    """
    used = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("missing_key")).agg(
        F.count(F.lit(1)).alias("child_rows")
    )
    keys = parent.select(F.col(parent_key).alias("missing_key"))
    return used.join(keys, "missing_key", "left_anti")


def orphan_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per declared reference between the given tables: distinct missing keys and child rows."""
    parts = []
    for name, child in tables.items():
        for column, parent_name in SOURCES[name].foreign_keys.items():
            if parent_name not in tables:
                continue
            parent_key = SOURCES[parent_name].primary_key[0]
            missing = orphans(child, column, tables[parent_name], parent_key)
            parts.append(
                missing.agg(
                    F.count(F.lit(1)).alias("missing_keys"),
                    F.coalesce(F.sum("child_rows"), F.lit(0)).alias("child_rows"),
                ).select(
                    F.lit(name).alias("table_name"), F.lit(column).alias("column_name"),
                    F.lit(parent_name).alias("parent_table"), "missing_keys", "child_rows",
                )
            )
    return reduce(DataFrame.unionByName, parts)


def null_report(table: DataFrame, source: Source) -> DataFrame:
    """One row per required column: nulls found, counted in a single pass over the table."""
    required = list(dict.fromkeys((*source.primary_key, *source.required)))
    counts = table.agg(
        F.count(F.lit(1)).alias("rows"), *(F.count_if(F.col(c).isNull()).alias(c) for c in required)
    )
    entries = F.explode(
        F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_rows")) for c in required))
    )
    return counts.select(F.lit(source.name).alias("table_name"), F.col("rows").alias("total_rows"), entries.alias("e")).select(
        "table_name", "e.column_name", "e.null_rows", "total_rows"
    )


def pipeline_health(events: DataFrame, happened: str, handled: str, bad: Column) -> DataFrame:
    """Per hour of handling: events, rejected events, largest delay in seconds, and whether that is backlog."""
    delay = F.unix_timestamp(handled) - F.unix_timestamp(happened)
    return (
        events.groupBy(F.date_trunc("hour", handled).alias("hora"))
        .agg(
            F.count(F.lit(1)).alias("eventos"),
            F.count_if(bad).alias("rejeitados"),
            F.max(delay).alias("maior_atraso_segundos"),
        )
        .withColumn("alarme", (F.col("maior_atraso_segundos") > BACKLOG_SECONDS) | (F.col("rejeitados") > 0))
    )


def lost_amounts(table: DataFrame, columns: list[str]) -> DataFrame:
    """Amounts that the views leave out because no 18-digit decimal holds them: (column_name, lost_rows)."""
    lost = [F.count_if(F.col(name).isNotNull() & money(name).isNull()).alias(name) for name in columns]
    return table.agg(*lost).unpivot([], columns, "column_name", "lost_rows")
