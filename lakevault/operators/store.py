"""Vault tables as append-only Parquet tables in the session catalog.

Every write is an append of rows that were found missing, so repeating a write adds nothing. Upserts
are appends as well: a reference keeps its superseded rows and ``read`` returns the newest per key.
"""
from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakevault.functions.hashing import packed, unpacked
from lakevault.operators.history import VERSION_ORDER, current
from lakevault.operators.model import SEQ_SCHEMA, first_row, vault_rows
from lakevault.operators.specs import MODEL, TABLES, VaultTable
from lakevault.session import remove, shared_folder
from lakevault.sources.schemas import EVENT_SCHEMA, SOURCES

# Hub and link rows are unique per hash key, so buckets over that key are even. Satellites stay
# unbucketed: one key may own a large share of all versions and a bucket cannot be split by a join.
BUCKETED_KINDS = {"hub", "link"}

# Tables of notes beside a satellite: its unchanged rows, and versions that were retired or revived.
SEEN_TABLE, RETIRED_TABLE = "seen", "retired"

# Codec of tables: digests are hexadecimal text, which only an entropy coder halves.
COMPRESSION = "zstd"

# A lease that was not renewed for so long belongs to a job that died.
LEASE_SECONDS = 300


class VaultStore:
    """All tables of one vault below ``root``, registered in ``database``."""

    def __init__(self, spark: SparkSession, root: str, database: str, buckets: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.database = database
        self.buckets = buckets
        self.brief = False  # reports, which show no digests, meet rows by half of each

    def qualified(self, name: str) -> str:
        return f"{self.database}.{name}"

    def ensure_database(self) -> None:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database} LOCATION '{self.root}'")

    def ensure_table(self, table: VaultTable, schema: StructType) -> None:
        """Register the table; one that has no rows yet can still be read."""
        bucketing = ""
        if self.buckets and table.kind in BUCKETED_KINDS:
            bucketing = f"CLUSTERED BY ({table.key[0]}) INTO {self.buckets} BUCKETS"
        columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema.fields)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.qualified(table.name)} ({columns}) USING parquet "
            f"OPTIONS (compression '{COMPRESSION}') {bucketing} LOCATION '{self.root}/{table.name}'"
        )

    def ensure_note(self, table: VaultTable, kind: str) -> VaultTable:
        """A table of notes beside a satellite: remembered rows (its columns), or retired and revived versions."""
        note = replace(table, name=f"{table.name}_{kind}")
        schema = self.spark.table(self.qualified(table.name)).schema
        if kind == RETIRED_TABLE:
            kept = [schema[name] for name in (table.key[0], *VERSION_ORDER)]
            schema = StructType(kept).add("dead", "boolean").add("turn", "long")
        self.ensure_table(note, schema)
        return note

    def noted(self, table: VaultTable, kind: str) -> DataFrame | None:
        """The notes of a satellite; None if there are none."""
        if not self.spark.catalog.tableExists(self.qualified(f"{table.name}_{kind}")):
            return None
        rows = self.rows(f"{table.name}_{kind}")
        return None if rows.isEmpty() else rows

    def retired(self, table: VaultTable) -> DataFrame | None:
        """(key, seq, hashdiff) of versions that count no more, digests as bytes; None if there are none."""
        notes = self.noted(table, RETIRED_TABLE)
        if notes is None:
            return None
        place = [table.key[0], *VERSION_ORDER]
        return first_row(compact(notes, table), place, [F.desc("turn")]).where("dead").select(*place)

    def compact_versions(self, name: str) -> DataFrame:
        """``versions`` with their digests as bytes, to go on with: half as long as text, and most of what is shuffled."""
        table = TABLES[name]
        rows, retired = compact(self.rows(name), table), self.retired(table)
        return rows if retired is None else rows.join(retired, retired.columns, "left_anti")

    def versions(self, name: str) -> DataFrame:
        """A satellite's versions, those that late rows have made superfluous left out."""
        if self.noted(TABLES[name], RETIRED_TABLE) is None:
            return self.rows(name)
        return spelled(self.compact_versions(name), TABLES[name])

    def ensure_all(self) -> None:
        """Register every table of the model, so that views resolve before the first load."""
        self.ensure_database()
        for table in TABLES.values():
            self.ensure_table(table, table_schema(self.spark, table))

    def within(self, spark: SparkSession) -> VaultStore:
        """The same tables seen from another session, such as that of a micro-batch."""
        return VaultStore(spark, self.root, self.database, self.buckets)

    def rows(self, name: str) -> DataFrame:
        """All stored rows, including those other sessions and jobs have appended by now."""
        self.spark.catalog.refreshTable(self.qualified(name))
        return self.spark.table(self.qualified(name))

    def read(self, name: str) -> DataFrame:
        """A table's rows; for a reference the newest row per key, for a satellite the versions that count."""
        table = TABLES[name]
        if table.kind == "satellite":
            return self.versions(name)
        rows = self.rows(name)
        if table.kind == "reference":
            others = [F.asc(column) for column in table.payload]
            rows = first_row(rows, table.key, [F.desc("load_dts"), *others])
            if table.upkeep:  # a row without a source says that the key is gone
                rows = rows.where("record_source is not null")
        return rows

    def current(self, name: str) -> DataFrame:
        """The newest version per key of a satellite."""
        return spelled(self.compact_current(name), TABLES[name])

    def compact_current(self, name: str) -> DataFrame:
        """``current`` with its digests as bytes."""
        return current(self.compact_versions(name), TABLES[name].key[0])

    @contextmanager
    def lease(self, name: str) -> Iterator[None]:
        """Be the only writer of a table, among all jobs of the vault, until the block ends.

        A file that only one job can create stands for the lease, in the vault's own folder. What is missing is
        found and appended under one lease, so two loads that share a hub cannot both add a key. The holder renews
        it as long as the block runs, however long that is; one that nobody has renewed belongs to a job that died.
        A holder that was away too long and lost the lease gets an error at the end.
        """
        path, owner = f"{self.root}/_leases/{name}", uuid.uuid4().hex
        while not self._create(path, owner):
            self._take_from_dead(path)
            time.sleep(0.1)
        done, lost = threading.Event(), []

        def renew() -> None:
            while not done.wait(LEASE_SECONDS / 6):
                if self._owner(path) != owner:
                    lost.append(True)
                    return
                self._create(path, owner, again=True)

        keeper = threading.Thread(target=renew, daemon=True)
        keeper.start()
        try:
            yield
        finally:
            done.set()
            keeper.join()
            if not lost and self._owner(path) == owner:
                self._system(path)[0].delete(self._system(path)[1], False)
            else:
                lost.append(True)
        if lost:
            raise RuntimeError(f"lost the lease of {name} while writing; another job may have added the same rows")

    def _system(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def _create(self, path: str, text: str, again: bool = False) -> bool:
        """Write a small file; False if it is there already and not to be written again."""
        system, place = self._system(path)
        try:
            stream = system.create(place, again)
            stream.write(bytearray(text.encode()))
            stream.close()
            return True
        except Py4JJavaError as error:
            if "AlreadyExists" not in error.java_exception.getClass().getName():
                raise
            return False

    def _owner(self, path: str) -> str | None:
        system, place = self._system(path)
        try:
            stream = system.open(place)
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            stream.close()
            return text
        except Py4JJavaError as error:
            if "FileNotFound" not in error.java_exception.getClass().getName():
                raise
            return None

    def _take_from_dead(self, path: str) -> None:
        """Put a lease aside that was not renewed in time. Another job may have done so and taken it in between: then it gets it back."""
        system, place = self._system(path)
        try:
            age = time.time() - system.getFileStatus(place).getModificationTime() / 1000
            owner = self._owner(path)
            if age <= LEASE_SECONDS or owner is None:
                return
            aside = self._system(f"{path}.{uuid.uuid4().hex}")[1]
            if system.rename(place, aside):
                if self._owner(aside.toString()) != owner:
                    system.rename(aside, place)
                else:
                    system.delete(aside, False)
        except Py4JJavaError as error:  # given back meanwhile
            if "FileNotFound" not in error.java_exception.getClass().getName():
                raise

    @contextmanager
    def parked(self, rows: DataFrame) -> Iterator[DataFrame]:
        """Rows that several writes need, worked out once: as files in the shared folder, deleted afterwards."""
        folder = f"{shared_folder(self.spark)}/lakevault/{self.database}_parked/{uuid.uuid4().hex}"
        try:
            rows.write.option("compression", COMPRESSION).parquet(folder)
            yield self.spark.read.schema(rows.schema).parquet(folder)
        finally:
            remove(self.spark, folder)

    def is_empty(self, name: str) -> bool:
        return self.rows(name).isEmpty()

    def append(self, table: VaultTable, rows: DataFrame) -> int:
        """Append rows and return how many there were, counted while they are written."""
        target = self.qualified(table.name)
        if self.buckets and table.kind in BUCKETED_KINDS:
            rows = rows.repartition(self.buckets, table.key[0])
        written = Observation()
        counted = rows.select(*self.spark.table(target).columns).observe(
            written, F.count(F.lit(1)).alias("rows")
        )
        counted.write.insertInto(target)
        return int(written.get.get("rows", 0))


def compact(rows: DataFrame, table: VaultTable) -> DataFrame:
    """Rows of a satellite with key and hashdiff as bytes."""
    return rows.withColumns({name: packed(name) for name in (table.key[0], "hashdiff")})


def spelled(rows: DataFrame, table: VaultTable) -> DataFrame:
    """Compact rows with key and hashdiff as text again."""
    return rows.withColumns({name: unpacked(name) for name in (table.key[0], "hashdiff")})


def input_schema(dataset: str) -> StructType:
    """Columns a dataset's rows have when they reach the model."""
    if dataset == "events":
        flat = StructType()
        for field in EVENT_SCHEMA.fields:
            for leaf in field.dataType.fields if isinstance(field.dataType, StructType) else [field]:
                flat.add(leaf)
    else:
        flat = SOURCES[dataset].schema
    return (
        StructType(list(flat.fields))
        .add("raw_file", "string")
        .add("raw_partition_date", "date")
        .add("seq", SEQ_SCHEMA)
        .add("load_dts", "timestamp")
        .add("record_source", "string")
    )


def table_schema(spark: SparkSession, table: VaultTable) -> StructType:
    """Schema of a vault table, by modelling an empty dataset."""
    dataset = next(name for name, tables in MODEL.items() if table in tables)
    return vault_rows(spark.createDataFrame([], input_schema(dataset)), table).schema
