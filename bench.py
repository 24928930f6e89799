"""Time the pipeline on one machine and print one JSON line.

Loads come first (they fill the vault the views read), then a second load of the same rows, then every
view and report: the median of three runs after a warm-up, with all result rows produced.
"""
from __future__ import annotations

import json
import os
import statistics
import time

from lakevault.plans import gold, registry, reports
from lakevault.session import configure, local_session
from lakevault.sources import benchtables

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def rows_of(spark, dataset: str):
    """A dataset's rows, dealt over all cores: each test table is one small file, which one core would read."""
    rows = registry.flat(spark, FOLDER) if dataset == "events" else benchtables.versioned(spark, FOLDER, dataset)
    return rows.repartition(int(CPUS), rows.columns[0])


def consume(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = configure(local_session(CPUS, int(CPUS), os.environ.get("BENCH_MEMORY", "12g")))
    consume(spark.read.parquet(f"{FOLDER}/lineitem.parquet").groupBy("l_returnflag").count())
    store = registry.new_store(spark, "bench")
    times: dict[str, float] = {}
    datasets = [*benchtables.BUILDERS, "events"]
    for dataset in datasets:
        times[f"load_{dataset}"] = seconds(lambda: registry.load(store, FOLDER, dataset, rows_of(spark, dataset)))
    for dataset in ("order_items", "order_payments", "events"):
        times[f"reload_{dataset}"] = seconds(lambda: registry.load(store, FOLDER, dataset, rows_of(spark, dataset)))
    work = {name: (lambda view=view: consume(view(store, None))) for name, view in gold.VIEWS.items()}
    for name in reports.REPORTS:
        work[name] = lambda name=name: consume(reports.run_report(name, gold.reader(store)))
    for name, action in work.items():
        action()
        times[name] = statistics.median(seconds(action) for _ in range(RUNS))
    total = round(sum(times.values()), 3)
    print(
        json.dumps(
            {"metric": "vault load, views and reports", "value": total, "unit": "sec", "queries": times,
             "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf")}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
