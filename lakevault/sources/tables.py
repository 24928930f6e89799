"""Typed CSV loads and the summary of what was loaded."""
from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakevault.sources.schemas import SOURCES


# Datasets with free text, in which a quoted value may span lines; files of the others can be split anywhere.
SPANNING = {"order_reviews"}


def read_csv(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """A CSV export with a header line, in the declared types; quoted texts of ``SPANNING`` datasets may span lines."""
    return (
        spark.read.schema(SOURCES[dataset].schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("multiLine", dataset in SPANNING)
        .option("escape", '"')
        .csv(path)
    )


def load_csv_tables(spark: SparkSession, folder: str, database: str) -> list[str]:
    """Every CSV dataset into a table of its own, referenced tables first; the names loaded."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for dataset in SOURCES:
        rows = read_csv(spark, f"{folder}/{dataset}", dataset)
        rows.write.mode("overwrite").saveAsTable(f"{database}.{dataset}")
    return list(SOURCES)


def load_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
