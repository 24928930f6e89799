"""Sinks of the raw layer: date-partitioned JSON."""
from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakevault.operators.merge import fits_broadcast, missing_rows
from lakevault.operators.model import first_row
from lakevault.sources.files import compressed, has_files, is_written
from lakevault.sources.schemas import EVENTS, SOURCES

# Fixed value: microseconds survive the way through JSON.
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def day_folder(root: str, dataset: str, day: dt.date) -> str:
    return f"{root.rstrip('/')}/{dataset}/year={day:%Y}/month={day:%m}/day={day:%d}"


def land_batch(
    rows: DataFrame, root: str, dataset: str, run_date: dt.date, rows_per_array: int | None = None
) -> DataFrame:
    """Append rows below the folder of the run date and return them as they were landed.

    By default one object per line, compressed. With ``rows_per_array`` every file holds one JSON array of about
    that many rows, the layout of systems that land page by page.
    """
    source = SOURCES[dataset]
    spark = rows.sparkSession
    # Run folders sort by time, so the file name orders the runs of one day.
    started = dt.datetime.now(dt.timezone.utc)
    target = f"{day_folder(root, dataset, run_date)}/run-{started:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    rows = rows.select(*source.columns)
    if rows_per_array is None:
        compressed(rows.write).option("timestampFormat", TIMESTAMP_FORMAT).json(target)
        return spark.read.schema(source.schema).json(target)
    pages = -(-rows.count() // rows_per_array) or 1
    page = F.pmod(F.xxhash64(*source.primary_key), F.lit(pages))
    arrays = rows.groupBy(page.alias("page")).agg(
        F.to_json(
            F.collect_list(F.struct(*source.columns)), {"timestampFormat": TIMESTAMP_FORMAT}
        ).alias("value")
    )
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(target)
    return spark.read.schema(source.schema).json(target)  # an array on one line is read row by row


def once(spark: SparkSession, path: str, value: str) -> str:
    """The value kept at a place: what was written there first, by whichever attempt came to its end."""
    if not is_written(spark, path):
        spark.createDataFrame([(value,)], "value string").coalesce(1).write.mode("overwrite").parquet(path)
    return spark.read.schema("value string").parquet(path).first()["value"]


def land_messages(batch: DataFrame, root: str, run: str, batch_id: int, run_date: dt.date) -> None:
    """Land one micro-batch of (message_id, body) so that each message id is landed once.

    ``run`` names the checkpoint the micro-batch belongs to. A message id that any other micro-batch of any
    run has landed is left out, wherever its date folder is; messages without an id are all landed. Both outputs live in folders of their own,
    named after run and micro-batch; a repeated micro-batch replaces its own output and keeps the date of
    its first attempt, and no run ever writes over another one's folder. The ledger is scanned, not
    shuffled, as long as the micro-batch is small enough to be broadcast.
    """
    spark = batch.sparkSession
    ledger = f"{root.rstrip('/')}/landed_message_ids"
    name = f"run={run}/batch={batch_id:010d}"
    day = dt.date.fromisoformat(once(spark, f"{root.rstrip('/')}/landing_dates/{name}", run_date.isoformat()))
    messages = batch.select("message_id", "body")
    named = messages.where("message_id is not null")
    fresh = first_row(named, ["message_id"])
    if has_files(spark, ledger):
        seen = spark.read.schema("message_id string, run string, batch bigint").parquet(ledger)
        others = seen.where((F.col("run") != run) | (F.col("batch") != batch_id))
        fresh = missing_rows(named, others, ["message_id"], fits_broadcast(batch.count()))
    fresh = fresh.unionByName(messages.where("message_id is null"))
    target = f"{day_folder(root, EVENTS, day)}/run-{run}-batch-{batch_id:010d}"
    # A line break can only stand between JSON tokens, never inside a JSON text.
    line = F.regexp_replace("body", r"[\r\n]+", " ")
    fresh = fresh.select("message_id", line.alias("value"))
    compressed(fresh.select("value").write).mode("overwrite").text(target)
    # Of ids that another run has landed this one keeps no entry: each id is in the ledger once.
    fresh.select("message_id").where("message_id is not null").write.mode("overwrite").parquet(f"{ledger}/{name}")
