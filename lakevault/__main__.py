"""Jobs from the command line.

    python -m lakevault load-batch   --raw RAW --vault VAULT [--database NAME] [--datasets all|a,b] [--all-files]
    python -m lakevault load-events  --raw RAW --vault VAULT [--database NAME] --checkpoint FOLDER
    python -m lakevault views        --vault VAULT [--database NAME] [--prefix NAME]
    python -m lakevault report       --vault VAULT [--database NAME] [REPORT]
    python -m lakevault extract      --tables FOLDER --raw RAW --marks FOLDER [--datasets all|a,b] [--mode cursor|diff]
    python -m lakevault bootstrap    --tables FOLDER --raw RAW --marks FOLDER [--datasets all|a,b]
    python -m lakevault land-events  --inbox FOLDER --raw RAW --quarantine FOLDER --checkpoint FOLDER
    python -m lakevault redrive      --raw RAW --quarantine FOLDER
    python -m lakevault hourly       --raw RAW --sink FOLDER --checkpoint FOLDER
    python -m lakevault check        --tables FOLDER

``extract``, ``bootstrap`` and ``check`` read one Parquet folder per table. ``report`` without a name lists the
reports. Master and resources come from spark-submit.
"""
from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from lakevault.operators import quality
from lakevault.operators.store import VaultStore
from lakevault.plans import gold, reports
from lakevault.plans.lasting import lasting_views
from lakevault.plans.pipeline import load_new_files, load_now, raise_if_failed, run_all
from lakevault.session import configure
from lakevault.sources.extract import Marks, bootstrap, extract
from lakevault.sources.raw import dataset_path, read_batches
from lakevault.sources.schemas import SOURCES, choose
from lakevault.streaming import jobs

VAULT_JOBS = ("load-batch", "load-events", "views", "report")
# What each of the other jobs has to be told.
FOLDERS = {
    "extract": ("tables", "raw", "marks"),
    "bootstrap": ("tables", "raw", "marks"),
    "land-events": ("inbox", "raw", "quarantine", "checkpoint"),
    "redrive": ("raw", "quarantine"),
    "hourly": ("raw", "sink", "checkpoint"),
    "check": ("tables",),
}


def arguments(given: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="lakevault")
    kinds = parser.add_subparsers(dest="job", required=True)
    for name in VAULT_JOBS:
        job = kinds.add_parser(name)
        job.add_argument("--vault", required=True, help="folder of the vault tables")
        job.add_argument("--database", default="silver")
        job.add_argument("--buckets", type=int, help="buckets of hubs and links, for large vaults")
        if name.startswith("load"):
            job.add_argument("--raw", required=True, help="folder of the landed files")
    for name, folders in FOLDERS.items():
        job = kinds.add_parser(name)
        for folder in folders:
            job.add_argument(f"--{folder}", required=True)
        job.add_argument("--day", type=dt.date.fromisoformat, help="landing date, today by default")
    for name in ("load-batch", "extract", "bootstrap", "check"):
        kinds.choices[name].add_argument("--datasets", default="all")
    kinds.choices["load-batch"].add_argument("--layout", choices=("lines", "pretty"), default="lines")
    kinds.choices["load-batch"].add_argument("--all-files", action="store_true", help="read files again that were loaded before")
    kinds.choices["load-events"].add_argument("--checkpoint", required=True)
    kinds.choices["report"].add_argument("name", nargs="?")
    kinds.choices["views"].add_argument("--prefix", default="")
    kinds.choices["extract"].add_argument("--mode", choices=("cursor", "diff"), default="cursor")
    return parser.parse_args(given)


def source_tables(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    return {name: spark.read.schema(SOURCES[name].schema).parquet(f"{folder}/{name}") for name in names}


def check(tables: dict[str, DataFrame]) -> None:
    """Print broken keys, references and required columns."""
    for name, table in tables.items():
        broken = quality.duplicate_keys(table, list(SOURCES[name].primary_key))
        print(f"{name}: {broken.count()} keys occur more than once")
        quality.null_report(table, SOURCES[name]).show(len(SOURCES[name].columns), truncate=False)
    if any(parent in tables for name in tables for parent in SOURCES[name].foreign_keys.values()):
        quality.orphan_report(tables).show(len(SOURCES) * 4, truncate=False)


def run(spark: SparkSession, asked: argparse.Namespace) -> None:
    """The jobs that have no vault."""
    day = asked.day or load_now().date()
    if asked.job in ("extract", "bootstrap", "check"):
        tables = source_tables(spark, asked.tables, choose(asked.datasets))
    if asked.job == "extract":
        marks = Marks(spark, asked.marks)
        for name, table in tables.items():
            print(extract(spark, table, name, asked.raw, marks, day, mode=asked.mode))
    elif asked.job == "bootstrap":
        print(bootstrap(spark, tables, asked.raw, Marks(spark, asked.marks), day))
    elif asked.job == "check":
        check(tables)
    elif asked.job == "land-events":
        jobs.landing_job(spark, asked.inbox, asked.raw, asked.quarantine, asked.checkpoint, day)
    elif asked.job == "redrive":
        print(jobs.redrive_job(spark, asked.raw, asked.quarantine, day))
    else:
        jobs.hourly_job(spark, dataset_path(asked.raw), asked.sink, asked.checkpoint)


def main(given: list[str] | None = None) -> None:
    asked = arguments(given)
    if asked.job == "report" and not asked.name:
        print("\n".join(reports.REPORTS))
        return
    spark = configure(SparkSession.builder.appName(f"lakevault {asked.job}").getOrCreate())
    if asked.job in FOLDERS:
        run(spark, asked)
        return
    store = VaultStore(spark, asked.vault, asked.database, asked.buckets)
    store.ensure_all()
    if asked.job == "report":
        reports.show_report(asked.name, gold.reader(store))
    elif asked.job == "views":
        print("\n".join(lasting_views(store, asked.prefix)))
    elif asked.job == "load-events":
        jobs.vault_job(store, dataset_path(asked.raw), asked.checkpoint)
    else:
        now = load_now()
        names = choose(asked.datasets)
        if asked.all_files:
            sources = {name: (lambda name=name: read_batches(spark, asked.raw, name, now, asked.layout)) for name in names}
            outcome = run_all(store, sources)
        else:
            sources = dict.fromkeys(names, lambda: None)
            outcome = run_all(store, sources, lambda store, name, _: load_new_files(store, asked.raw, name, asked.layout))
        outcome.show(len(sources) * 5, truncate=False)
        raise_if_failed(outcome)


if __name__ == "__main__":
    main()
