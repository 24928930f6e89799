"""Readers of landed raw files: ``<root>/<dataset>/year=YYYY/month=MM/day=DD/*.json``.

Partition columns are declared, not discovered from the data, so a filter on them prunes folders.
"""
from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakevault.operators.model import sequence, stamped
from lakevault.sources.files import RAW_FILES, has_files
from lakevault.sources.schemas import EVENT_SCHEMA, EVENTS, RECORD_SOURCE, SOURCES

CORRUPT = "_corrupt"
LINES, PRETTY = "lines", "pretty"
PARTITIONS = StructType().add("year", "integer").add("month", "integer").add("day", "integer")


def dataset_path(root: str, dataset: str = EVENTS) -> str:
    return f"{root.rstrip('/')}/{dataset}"


def _json_rows(spark: SparkSession, path: str, schema: StructType, array_files: bool, files: list[str] | None = None) -> DataFrame:
    declared = StructType(list(schema.fields)).add(CORRUPT, "string")
    for field in PARTITIONS.fields:
        declared.add(field)
    reader = (
        spark.read.schema(declared)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", array_files)
        .option("pathGlobFilter", RAW_FILES)
    )
    try:
        found = reader.json(path) if files is None else reader.option("basePath", path).json(files)
        rows = found.withColumn("raw_file", F.col("_metadata.file_path"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], StructType(list(declared.fields)).add("raw_file", "string"))
    return rows


def refuse_many_values(spark: SparkSession, path: str) -> None:
    """Raise if a file has several lines that begin and end a JSON value: of such a file only the first would be read."""
    if not has_files(spark, path):
        return
    lines = spark.read.option("pathGlobFilter", RAW_FILES).option("recursiveFileLookup", True).text(path)
    whole = F.col("value").rlike(r"^(\{.*\}|\[.*\])\s*$")
    files = lines.where(whole).groupBy(F.col("_metadata.file_path").alias("file")).count().where("count > 1")
    found = files.limit(1).collect()
    if found:
        raise ValueError(f"{found[0]['file']} holds several values, one to a line; read it with layout='{LINES}'")


def unreadable_rows(schema: StructType) -> Column:
    """A file or line that gave no value at all. One bad value only empties its own field."""
    return F.col(CORRUPT).isNotNull() & F.coalesce(
        *(F.when(F.col(f"`{name}`").isNotNull(), F.lit(False)) for name in schema.fieldNames()), F.lit(True)
    )


def with_raw_metadata(rows: DataFrame, record_source: str, load_dts: dt.datetime) -> DataFrame:
    """Where a row was landed, when it was loaded and from which source."""
    parts = {
        "raw_year": F.lpad(F.col("year").cast("string"), 4, "0"),
        "raw_month": F.lpad(F.col("month").cast("string"), 2, "0"),
        "raw_day": F.lpad(F.col("day").cast("string"), 2, "0"),
    }
    dated = rows.withColumns(parts).drop("year", "month", "day")
    day = F.try_to_date(F.concat_ws("-", "raw_year", "raw_month", "raw_day"))
    return stamped(dated.withColumn("raw_partition_date", day), record_source, load_dts)


def read_batches(
    spark: SparkSession,
    root: str,
    dataset: str,
    load_dts: dt.datetime,
    layout: str = LINES,
    since: dt.date | None = None,
    files: list[str] | None = None,
) -> DataFrame:
    """Rows of a batch dataset; no folder at all gives an empty frame of the same schema.

    ``layout``: ``lines`` takes one object or one whole array of objects per line, so it reads landings
    of both forms, and files can be split. ``pretty`` is for files of one value printed over many lines;
    it raises if a file holds more than one. ``since`` limits the landing dates read, ``files`` the files.
    """
    schema = SOURCES[dataset].schema
    if layout not in (LINES, PRETTY):
        raise ValueError(f"unknown layout {layout!r}; known: {LINES}, {PRETTY}")
    if layout == PRETTY:
        refuse_many_values(spark, dataset_path(root, dataset))
    rows = _json_rows(spark, dataset_path(root, dataset), schema, layout == PRETTY, files)
    if since is not None:
        rows = rows.where(F.make_date("year", "month", "day") >= F.lit(since))
    good = rows.where(~unreadable_rows(schema)).drop(CORRUPT)
    loaded = with_raw_metadata(good, f"{RECORD_SOURCE['batch']}.{dataset}", load_dts)
    # The place below the dataset's folder: another spelling of the root does not change the order.
    place = F.substring_index("raw_file", f"/{dataset}/year=", -1)
    return loaded.withColumn("_place", place).withColumn("seq", sequence("raw_partition_date", "_place")).drop("_place")


def read_events(
    spark: SparkSession, root: str, load_dts: dt.datetime, since: dt.date | None = None
) -> DataFrame:
    """Landed events, one object per file or per line, still nested."""
    rows = _json_rows(spark, dataset_path(root), EVENT_SCHEMA, array_files=False)
    if since is not None:
        rows = rows.where(F.make_date("year", "month", "day") >= F.lit(since))
    good = rows.where(~unreadable_rows(EVENT_SCHEMA)).drop(CORRUPT)
    return with_raw_metadata(good, f"{RECORD_SOURCE['events']}.{EVENTS}", load_dts)


def read_unreadable(spark: SparkSession, root: str, dataset: str, layout: str = LINES) -> DataFrame:
    """What the readers leave out: (raw_file, payload) of files or lines that are no JSON."""
    schema = EVENT_SCHEMA if dataset == EVENTS else SOURCES[dataset].schema
    rows = _json_rows(spark, dataset_path(root, dataset), schema, layout == PRETTY and dataset != EVENTS)
    return rows.where(unreadable_rows(schema)).select("raw_file", F.col(CORRUPT).alias("payload"))


def flat_events(events: DataFrame) -> DataFrame:
    """Nested events as flat rows; a missing part gives null columns. ``seq`` is event time, event id."""
    carried = [c for c in ("raw_file", "raw_partition_date", "load_dts", "record_source") if c in events.columns]
    return events.select(
        "event_id", "event_type", "event_timestamp", "customer.*", "order.*", "payment.*", *carried
    ).withColumn("seq", sequence("event_timestamp", "event_id"))
