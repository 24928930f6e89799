import datetime as dt

from helpers import dataset
from pyspark.sql import functions as F

from lakevault.operators import quality
from lakevault.sources.schemas import SOURCES


def test_duplicate_keys(spark):
    rows = dataset(spark, "order_reviews", [{"review_id": "r", "order_id": o} for o in ("o1", "o2", "o2")])
    assert [tuple(r) for r in quality.duplicate_keys(rows, ["review_id", "order_id"]).collect()] == [("r", "o2", 2)]
    assert [tuple(r) for r in quality.duplicate_keys(rows, ["review_id"]).collect()] == [("r", 3)]


def test_orphans(spark):
    orders = dataset(spark, "orders", [{"order_id": o, "customer_id": c} for o, c in (("o1", "c1"), ("o2", "cx"), ("o3", "cx"), ("o4", None))])
    customers = dataset(spark, "customers", [{"customer_id": "c1"}])
    report = quality.orphan_report({"orders": orders, "customers": customers})
    assert [tuple(r) for r in report.collect()] == [("orders", "customer_id", "customers", 1, 2)]


def test_nulls_in_one_pass(spark):
    rows = dataset(spark, "customers", [{"customer_id": "c1"}, {"customer_unique_id": "u"}, {}])
    report = quality.null_report(rows, SOURCES["customers"])
    assert {(r["column_name"], r["null_rows"], r["total_rows"]) for r in report.collect()} == {
        ("customer_id", 2, 3), ("customer_unique_id", 2, 3),
    }


def test_health(spark):
    start = dt.datetime(2026, 7, 10, 10)
    rows = [(start, start + dt.timedelta(seconds=s), bad) for s, bad in ((10, False), (900, False), (3700, True), (3601, False))]
    frame = spark.createDataFrame(rows, "happened timestamp, handled timestamp, bad boolean")
    found = quality.pipeline_health(frame, "happened", "handled", F.col("bad")).orderBy("hora").collect()
    assert [tuple(r)[1:] for r in found] == [(2, 0, 900, False), (2, 1, 3700, True)]
