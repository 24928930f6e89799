"""Small frames for tests."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakevault.operators.model import stamped
from lakevault.sources.schemas import SOURCES

LOADED = dt.datetime(2026, 7, 10, 12, tzinfo=dt.timezone.utc)


def day(number: int) -> dt.datetime:
    return dt.datetime(2026, 1, 1) + dt.timedelta(days=number)


def dataset(spark: SparkSession, name: str, rows: list[dict], at: int | None = 0, loaded: dt.datetime = LOADED) -> DataFrame:
    """Rows of a source table with load metadata; columns left out are null."""
    source = SOURCES[name]
    values = [tuple(row.get(c) for c in source.columns) for row in rows]
    frame = spark.createDataFrame(values, source.schema)
    when = F.lit(None if at is None else day(at)).cast("timestamp")
    frame = frame.withColumn("seq", F.struct(when.alias("at"), F.lit("").alias("tie")))
    return stamped(frame, f"raw.olist.{name}", loaded)


def versions(spark: SparkSession, rows: list[tuple[str, int, str]]) -> DataFrame:
    """Satellite-like rows (key, day, hashdiff)."""
    frame = spark.createDataFrame(rows, "k string, d int, hashdiff string")
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("d") * 86400)
    return frame.select("k", "hashdiff", F.struct(at.alias("at"), F.lit("").alias("tie")).alias("seq"), F.col("d").alias("d"))


def exchanges(frame: DataFrame) -> int:
    """Shuffles in the plan as written, before run-time changes."""
    text = frame._jdf.queryExecution().executedPlan().toString()
    return text.count("Exchange hashpartitioning") + text.count("Exchange rangepartitioning")


def plan(frame: DataFrame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()
