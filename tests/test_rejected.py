"""Rejected lines are counted by digests of them."""
from helpers import plan
from pyspark.sql import functions as F

from lakevault.streaming import jobs


def test_rejected_lines_do_not_travel_to_be_counted(spark, store):
    rows = [("f1", "{" * 50, "unreadable"), ("f1", "{" * 50, "unreadable"), ("f2", "x", "unreadable")]
    for run, found in (("a", rows), ("b", rows[1:])):
        frame = spark.createDataFrame(found, "raw_file string, payload string, reason string")
        frame.write.parquet(f"{store.root}/_rejected_events/run={run}/batch=0")
    lost = jobs.rejected_events(store)
    assert sorted(map(tuple, lost.collect())) == sorted(rows)
    counted = plan(lost.groupBy("reason").agg(F.count(F.lit(1))))
    assert not any("payload" in line for line in counted.splitlines() if "HashAggregate(keys" in line)
