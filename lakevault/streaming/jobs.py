"""Micro-batch jobs over files. Each job has a checkpoint; a run without new files does nothing."""
from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from lakevault.functions.hashing import packed
from lakevault.operators.contract import accepted, parsed, quarantined, redrive
from lakevault.operators.store import COMPRESSION, VaultStore
from lakevault.plans.pipeline import load_dataset, load_now
from lakevault.session import remove, shared_folder
from lakevault.sources.files import RAW_FILES, has_files, is_written, written_folders
from lakevault.sources.landing import land_messages, once
from lakevault.sources.raw import CORRUPT, PARTITIONS, flat_events, unreadable_rows, with_raw_metadata
from lakevault.sources.schemas import EVENT_SCHEMA, EVENTS, RECORD_SOURCE


def drain(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """Process everything that is there, then stop; the scheduled form of a micro-batch job."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def event_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Landed events as a stream, nested, with their file and landing date."""
    declared = StructType([*EVENT_SCHEMA.fields, StructField(CORRUPT, StringType()), *PARTITIONS.fields])
    reader = (
        spark.readStream.schema(declared)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("pathGlobFilter", RAW_FILES)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path).withColumn("raw_file", F.col("_metadata.file_path"))


def vault_job(store: VaultStore, path: str, checkpoint: str, files_per_batch: int | None = None) -> StreamingQuery:
    """Landed events into the vault; lines that are no event into the vault's quarantine (see ``rejected_events``).

    A micro-batch that is repeated after a failure adds nothing twice, because every write takes
    only what is missing; so the vault's tables need no memory of batch numbers. The quarantine's folders are named
    after the checkpoint's run and the micro-batch, and replaced by a repetition.
    """
    record_source = f"{RECORD_SOURCE['events']}.{EVENTS}"
    run = once(store.spark, f"{checkpoint.rstrip('/')}/run_id", uuid.uuid4().hex)

    def take(batch: DataFrame, batch_id: int) -> None:
        unreadable = unreadable_rows(EVENT_SCHEMA)
        rows = flat_events(with_raw_metadata(batch.where(~unreadable).drop(CORRUPT), record_source, load_now()))
        load_dataset(store.within(batch.sparkSession), EVENTS, rows)
        rejected = batch.where(unreadable).select("raw_file", F.col(CORRUPT).alias("payload"), F.lit("unreadable").alias("reason"))
        keyless = batch.where(~unreadable & F.col("event_id").isNull())
        keyless = keyless.select("raw_file", F.to_json(F.struct(*EVENT_SCHEMA.fieldNames())).alias("payload"), F.lit("no event id").alias("reason"))
        rejected.unionByName(keyless).write.option("compression", COMPRESSION).mode("overwrite").parquet(f"{store.root}/_rejected_events/run={run}/batch={batch_id}")

    stream = event_stream(store.spark, path, files_per_batch)
    return drain(stream.writeStream.foreachBatch(take), checkpoint)


def rejected_events(store: VaultStore) -> DataFrame:
    """What ``vault_job`` could not take in: raw_file, payload and reason; a line that several runs met counts once."""
    schema = "raw_file string, payload string, reason string"
    folders = written_folders(store.spark, f"{store.root}/_rejected_events/run=*/batch=*")
    if not folders:
        return store.spark.createDataFrame([], schema)
    rows = store.spark.read.schema(schema).option("basePath", f"{store.root}/_rejected_events").parquet(*folders)
    # Equal lines of one file came in one run as often as they are there. They meet by a digest, shorter than the line,
    # and only who asks for lines has them moved.
    line = ["raw_file", "line", "reason"]
    copies = rows.withColumn("line", packed(F.sha2("payload", 256))).groupBy(*line, "run")
    copies = copies.agg(F.count(F.lit(1)).alias("count"), F.first("payload").alias("payload"))
    most = copies.groupBy(*line).agg(F.max("count").alias("copies"), F.first("payload").alias("payload"))
    return most.select("raw_file", "payload", "reason", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).drop("copy")


def message_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Messages (message_id, body, sent_at) as they were received, one JSON object per line."""
    reader = spark.readStream.schema("message_id string, body string, sent_at timestamp")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def landing_job(
    spark: SparkSession,
    path: str,
    raw_root: str,
    quarantine: str,
    checkpoint: str,
    run_date: dt.date,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Messages into the raw layer, each id once; messages that break the contract into quarantine.

    The checkpoint has an id of its own, kept in it; sinks are folders named after that and the
    micro-batch, so a repeated micro-batch replaces itself and a new checkpoint touches nothing of an
    earlier one's. The judged micro-batch is a file until both sinks are written.
    """
    run = once(spark, f"{checkpoint.rstrip('/')}/run_id", uuid.uuid4().hex)

    def take(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        staged = f"{shared_folder(session)}/lakevault/judged/{run}-{batch_id}"
        parsed(batch).write.option("compression", COMPRESSION).mode("overwrite").parquet(staged)
        judged = session.read.parquet(staged)
        land_messages(accepted(judged), raw_root, run, batch_id, run_date)
        quarantined(judged).write.mode("overwrite").parquet(f"{quarantine}/run={run}/batch={batch_id}")
        remove(session, staged)

    return drain(message_stream(spark, path, files_per_batch).writeStream.foreachBatch(take), checkpoint)


def redrive_job(spark: SparkSession, raw_root: str, quarantine: str, run_date: dt.date) -> dict[str, int]:
    """Judge all quarantined messages again: the good ones are landed, the others wait on or are given up.

    Only whole repeated messages (id, body and attempt) count once; those without an id each count. The micro-batch
    folders to be replaced are noted with the run before anything is written, so a run that died is carried on
    under its own name: it lands and writes the same folders again, and removes the old ones when both are written.
    """
    quarantine = quarantine.rstrip("/")
    pending = f"{quarantine}/_redrive"
    noted = is_written(spark, f"{pending}/plan")
    plan = spark.read.schema("run string, folder string").parquet(f"{pending}/plan").collect() if noted else []
    if plan:
        run, folders = plan[0]["run"], [row["folder"] for row in plan]
    else:
        if not has_files(spark, quarantine):
            return {"landed": 0, "waiting": 0, "given_up": 0}
        run, folders = f"redrive-{uuid.uuid4().hex}", written_folders(spark, f"{quarantine}/run=*/batch=*")
        if not folders:
            return {"landed": 0, "waiting": 0, "given_up": 0}
        spark.createDataFrame([(run, folder) for folder in folders], "run string, folder string").coalesce(1).write.mode("overwrite").parquet(f"{pending}/plan")
    judged = f"{pending}/judged-{run}"
    if not is_written(spark, judged):
        held = spark.read.schema("message_id string, body string, reasons array<string>, attempt int").parquet(*folders)
        named = held.where("message_id is not null").dropDuplicates(["message_id", "body", "attempt"])
        good, again, spent = redrive(named.unionByName(held.where("message_id is null")))
        kinds = [good.select("message_id", "body").withColumn("kind", F.lit("landed")), again.withColumn("kind", F.lit("waiting")), spent.withColumn("kind", F.lit("given_up"))]
        kinds[0].unionByName(kinds[1], True).unionByName(kinds[2], True).write.mode("overwrite").parquet(judged)
    found = spark.read.schema("message_id string, body string, reasons array<string>, attempt int, kind string").parquet(judged)
    counts = {"landed": 0, "waiting": 0, "given_up": 0} | {row["kind"]: row["count"] for row in found.groupBy("kind").count().collect()}
    land_messages(found.where("kind = 'landed'"), raw_root, run, 0, run_date)
    found.where("kind != 'landed'").drop("kind").write.mode("overwrite").parquet(f"{quarantine}/run={run}/batch=0")
    for folder in folders:
        remove(spark, folder)
    remove(spark, f"{pending}/plan")
    remove(spark, judged)
    return counts


def distinct_messages(messages: DataFrame, delay: str) -> DataFrame:
    """Each message id once, as long as copies are sent within ``delay`` of each other."""
    return messages.withWatermark("sent_at", delay).dropDuplicatesWithinWatermark(["message_id"])


HOUR = ["hora", "event_type", "product_category_name"]
# Sketches of this many register bits: an estimate is within about 2 % of the count.
SKETCH_BITS = 12


def hourly_activity(events: DataFrame) -> DataFrame:
    """What events add to their hours, per type and category: counts, sums, and sketches of the different orders and customers.

    Sums are exact decimals and sketches can be united, so parts of an hour that were worked out apart add up to
    the whole. Events without a time belong to no hour.
    """
    price, freight = F.col("order.price").cast("decimal(18,2)"), F.col("order.freight_value").cast("decimal(18,2)")
    hours = F.date_trunc("hour", "event_timestamp").alias("hora")
    return (
        events.where("event_timestamp is not null")
        .groupBy(hours, "event_type", F.col("order.product_category_name").alias("product_category_name"))
        .agg(
            F.count(F.lit(1)).alias("eventos"),
            F.hll_sketch_agg("order.order_id", SKETCH_BITS).alias("pedidos"),
            F.hll_sketch_agg("customer.customer_unique_id", SKETCH_BITS).alias("clientes"),
            F.sum(price + freight).cast("decimal(28,2)").alias("valor"),
        )
    )


PARTS_SCHEMA = (
    "hora timestamp, event_type string, product_category_name string, eventos bigint, pedidos binary, clientes binary, "
    "valor decimal(28,2), raw_file string, run string, batch bigint"
)


def hourly_job(spark: SparkSession, path: str, sink: str, checkpoint: str, files_per_batch: int | None = None) -> StreamingQuery:
    """Hourly activity as a growing table of parts: each micro-batch adds what its files hold, however late their events are.

    A micro-batch writes one folder, named after the checkpoint's run and its number, with the parts of hours and
    the names of its files; repeated, it replaces itself. Files that any other micro-batch has taken in are left out, so
    a new checkpoint, which sees all files again, counts nothing twice.
    """
    run = once(spark, f"{checkpoint.rstrip('/')}/run_id", uuid.uuid4().hex)
    parts = f"{sink.rstrip('/')}/parts"

    def take(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        files = batch.select("raw_file").distinct()
        if has_files(session, parts):
            taken = session.read.schema(PARTS_SCHEMA).parquet(parts).where("raw_file is not null")
            others = taken.where((F.col("run") != run) | (F.col("batch") != batch_id)).select("raw_file")
            # First those of this micro-batch, which are few, then the rest of its files.
            known = others.join(F.broadcast(files), "raw_file", "left_semi").distinct()
            files = files.join(known, "raw_file", "left_anti")
        fresh = batch.join(F.broadcast(files), "raw_file", "left_semi")
        rows = hourly_activity(fresh).unionByName(files, allowMissingColumns=True)
        rows.write.mode("overwrite").parquet(f"{parts}/run={run}/batch={batch_id:010d}")

    return drain(event_stream(spark, path, files_per_batch).writeStream.foreachBatch(take), checkpoint)


def latest_hours(spark: SparkSession, sink: str) -> DataFrame:
    """The figures of every hour, type and category over all parts that ``hourly_job`` wrote; counts of different keys are estimates."""
    parts = spark.read.schema(PARTS_SCHEMA).parquet(f"{sink.rstrip('/')}/parts").where("raw_file is null")
    return parts.groupBy(*HOUR).agg(
        F.sum("eventos").alias("eventos"),
        F.hll_sketch_estimate(F.hll_union_agg("pedidos")).alias("pedidos_aproximados"),
        F.hll_sketch_estimate(F.hll_union_agg("clientes")).alias("clientes_aproximados"),
        F.sum("valor").cast("double").alias("valor_total"),
    )
