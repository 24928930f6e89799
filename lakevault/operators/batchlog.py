"""Logs of batches beside a table that is kept up from them."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakevault.sources.files import written_folders


class BatchLog:
    """Folders of batches, one for each: complete or not there. A batch is open until what follows from it is stored."""

    def __init__(self, spark: SparkSession, path: str, key: list[str], payload: list[str]):
        self.spark = spark
        self.path = path.rstrip("/")
        self.key, self.payload = key, payload

    def add(self, part: str, rows: DataFrame) -> list[str]:
        """Write a batch; all open batches, this one and those of jobs that died."""
        rows.write.parquet(f"{self.path}/{part}/batch={uuid.uuid4().hex}")
        return sorted(self._batches(part) - self._batches("closed"))

    def close(self, batches: list[str]) -> None:
        for batch in batches:
            self.spark.range(0).write.mode("overwrite").parquet(f"{self.path}/closed/batch={batch}")

    def read(self, part: str, schema: str | None = None) -> DataFrame | None:
        """All complete batches of a part; None without any."""
        folders = written_folders(self.spark, f"{self.path}/{part}/batch=*")
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        return reader.parquet(*folders) if folders else None

    def _batches(self, part: str) -> set[str]:
        return {folder.rpartition("batch=")[2] for folder in written_folders(self.spark, f"{self.path}/{part}/batch=*")}


class NewestRows(BatchLog):
    """The newest row of each key by ``seq``, under batches that come in any order or are repeated."""

    def take(self, rows: DataFrame) -> tuple[DataFrame, list[str]]:
        """Take in a batch: the newest rows of the keys of all open batches, and these batches."""
        # Of equally new rows the first by content counts, as in a load of all of them at once.
        equal = rows.groupBy(*self.key, "seq").agg(F.min(F.struct(*self.payload, "load_dts", "record_source")).alias("first"))
        newest = equal.groupBy(*self.key).agg(F.max_by("first", "seq").alias("now"), F.max("seq").alias("seq"))
        logged = self.read("rows")
        if logged is not None:
            known = logged.join(newest.select(*self.key), self.key, "left_semi").groupBy(*self.key).agg(F.max("seq").alias("known"))
            newest = newest.join(known, self.key, "left").where(F.col("known").isNull() | (F.col("seq") > F.col("known"))).drop("known")
        batches = self.add("rows", newest)
        logged = self.read("rows")
        opened = self.spark.read.parquet(*[f"{self.path}/rows/batch={batch}" for batch in batches]).select(*self.key).distinct()
        last = logged.join(opened, self.key, "left_semi").groupBy(*self.key).agg(F.max_by("now", "seq").alias("now"))
        return last.select(*self.key, "now.*"), batches
