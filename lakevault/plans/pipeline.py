"""Loads: dataset rows into the vault, one dataset or many."""
from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import replace

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from lakevault.operators.merge import Written, keep_up, write
from lakevault.operators.model import source_rows, stamped, vault_rows
from lakevault.operators.specs import MODEL, VaultTable
from lakevault.operators.store import COMPRESSION, VaultStore
from lakevault.session import release, shared_folder
from lakevault.sources.ledger import BATCH_FILES, Ledger
from lakevault.sources.raw import LINES, read_batches


@contextmanager
def staged(store: VaultStore, rows: DataFrame, dataset: str) -> Iterator[DataFrame]:
    """The batch as a Parquet table in the shared folder, dropped afterwards.

    A dataset feeds several vault tables. Parsing and joining happen once; each table then reads just its columns, and a
    lost executor only re-reads files. Digests are left to the tables: written here, they would be most of the bytes.
    """
    spark, database = rows.sparkSession, f"{store.database}_stage"
    folder = f"{shared_folder(spark)}/lakevault/{database}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{folder}'")
    name = f"{database}.{dataset}_{uuid.uuid4().hex[:12]}"
    try:
        rows.write.format("parquet").option("compression", COMPRESSION).saveAsTable(name)
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def load_dataset(store: VaultStore, dataset: str, rows: DataFrame, part: bool = False) -> list[Written]:
    """Take one batch of a dataset into all its vault tables.

    Averages are those of the batch, or with ``part`` those of all parts taken in so far.

    ``rows`` carry the dataset's columns plus ``load_dts``, ``record_source`` and ``seq``. Keys are
    digests of business keys, so no table waits for another one's keys and all are written side by side.
    """
    if dataset not in MODEL:
        raise ValueError(f"unknown dataset {dataset!r}; known: {list(MODEL)}")
    tables = MODEL[dataset]
    with staged(store, rows, dataset) as batch, ThreadPoolExecutor(len(tables)) as pool:
        batch_rows = batch.count()
        # The threads keep the job group of the caller, so cancelling a stream cancels its writes.

        def take(table: VaultTable) -> Written:
            if part and table.upkeep:
                return keep_up(store, table, batch, batch_rows)
            ready = vault_rows(batch, table) if table.kind == "reference" else source_rows(batch, table)
            return write(store, table, ready, batch_rows)

        done = list(pool.map(inheritable_thread_target(rows.sparkSession)(take), tables))
    release(rows.sparkSession)
    return done


def load_new_files(store: VaultStore, raw_root: str, dataset: str, layout: str = LINES, files: int = BATCH_FILES) -> list[Written]:
    """Take in the raw files of a dataset that this vault has not taken in yet, whatever their landing date.

    At most ``files`` of them at once, in landing order. The ledger lies in the vault's folder; a batch of files is listed
    there once all tables have it, so a load that died takes them again, without effect where it had come.
    """
    ledger = Ledger(store.spark, f"{store.root}/_ledger")
    total = {table.name: Written(table.name, table.kind, 0, 0) for table in MODEL[dataset]}
    for batch in ledger.batches(raw_root, dataset, files):
        paths = [row["path"] for row in batch.collect()]
        rows = read_batches(store.spark, raw_root, dataset, load_now(), layout, files=paths)
        for done in load_dataset(store, dataset, rows, part=True):
            before = total[done.table]
            total[done.table] = replace(before, staged_rows=before.staged_rows + done.staged_rows, appended_rows=before.appended_rows + done.appended_rows)
        ledger.commit(dataset, batch)
    return list(total.values())


def load_now() -> dt.datetime:
    """One load time per batch, in UTC."""
    return dt.datetime.now(dt.timezone.utc)


def load_table(
    store: VaultStore, dataset: str, rows: DataFrame, record_source: str, load_dts: dt.datetime | None = None
) -> list[Written]:
    """``load_dataset`` for rows that come straight from a source table."""
    return load_dataset(store, dataset, stamped(rows, record_source, load_dts or load_now()))


def run_all(
    store: VaultStore, sources: Mapping[str, Callable[[], DataFrame]], load: Callable[..., list[Written]] = load_dataset
) -> DataFrame:
    """Load every dataset; one that fails does not stop the others. The outcome, one row per table."""
    outcome = []
    for dataset, rows in sources.items():
        try:
            for done in load(store, dataset, rows()):
                outcome.append((dataset, done.table, done.staged_rows, done.appended_rows, "ok", None))
        except Exception as error:  # the other datasets still have to run
            outcome.append((dataset, None, 0, 0, "failed", f"{type(error).__name__}: {error}"))
    return report(store.spark, outcome)


def report(spark: SparkSession, outcome: list[tuple]) -> DataFrame:
    schema = (
        "dataset string, table_name string, staged_rows bigint, appended_rows bigint, status string, error string"
    )
    return spark.createDataFrame(outcome, schema)


def raise_if_failed(outcome: DataFrame) -> None:
    """End a run with an error that names the datasets that failed."""
    failed = sorted({row["dataset"] for row in outcome.where("status = 'failed'").collect()})
    if failed:
        raise RuntimeError(f"datasets failed: {', '.join(failed)}")
