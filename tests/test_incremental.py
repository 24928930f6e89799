"""Loads of new files only, centroids that are kept up, and what dead writes leave behind."""
import datetime as dt
import random
import threading
import time
from pathlib import Path

import pytest
from helpers import LOADED
from pyspark.sql import functions as F

from lakevault.operators import merge
from lakevault.operators.centroid import KeptPoints, zip_centroids
from lakevault.plans import pipeline
from lakevault.plans.pipeline import load_new_files
from lakevault.plans.registry import leave_behind
from lakevault.sources.extract import Marks, extract
from lakevault.sources.files import has_files
from lakevault.sources.landing import land_batch, once
from lakevault.sources.ledger import Ledger
from lakevault.sources.raw import read_batches
from lakevault.sources.schemas import SOURCES

TODAY = dt.date(2026, 7, 10)


def sellers(spark, *rows):
    return spark.createDataFrame([(a, "1", city, "SP") for a, city in rows], SOURCES["sellers"].schema)


def test_files_are_taken_once_whatever_their_date(spark, store, folder):
    raw = f"{folder}/raw"
    assert load_new_files(store, raw, "sellers")[0].staged_rows == 0
    land_batch(sellers(spark, ("s1", "b"), ("s2", "x")), raw, "sellers", TODAY)
    assert [w.staged_rows for w in load_new_files(store, raw, "sellers")] == [2, 2]
    land_batch(sellers(spark, ("s1", "a"), ("s3", "x")), raw, "sellers", TODAY - dt.timedelta(days=9))
    assert [w.staged_rows for w in load_new_files(store, raw, "sellers", files=1)] == [2, 2]
    assert [w.staged_rows for w in load_new_files(store, raw, "sellers")] == [0, 0]
    cities = {(r["seller_city"], r["seq"]["at"].date()) for r in store.read("sat_seller_profile").collect()}
    assert cities == {("b", TODAY), ("a", TODAY - dt.timedelta(days=9)), ("x", TODAY), ("x", TODAY - dt.timedelta(days=9))}
    assert {r["seller_city"] for r in store.current("sat_seller_profile").collect()} == {"b", "x"}


def test_a_load_that_dies_before_the_ledger_is_repeated_without_effect(spark, store, folder, monkeypatch):
    raw = f"{folder}/raw"
    land_batch(sellers(spark, ("s1", "b")), raw, "sellers", TODAY)

    def die(*_):
        raise OSError("lost")

    monkeypatch.setattr(Ledger, "commit", die)
    with pytest.raises(OSError):
        load_new_files(store, raw, "sellers")
    monkeypatch.undo()
    assert [(w.staged_rows, w.appended_rows) for w in load_new_files(store, raw, "sellers")] == [(1, 0), (1, 0)]
    assert Ledger(spark, f"{store.root}/_ledger").fresh(raw, "sellers").isEmpty()


def points(spark, rows):
    """(id, zip, lat, city, moment)"""
    frame = spark.createDataFrame(rows, "geolocation_id bigint, geolocation_zip_code_prefix string, geolocation_lat double, geolocation_city string, d int")
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("d") * 86400)
    return frame.select(
        "geolocation_id", "geolocation_zip_code_prefix", "geolocation_lat", (F.col("geolocation_lat") * 3).alias("geolocation_lng"), "geolocation_city",
        F.lit("SP").alias("geolocation_state"), F.struct(at.alias("at"), F.col("d").cast("string").alias("tie")).alias("seq"),
        F.lit(LOADED).cast("timestamp").alias("load_dts"), F.lit("x").alias("record_source"),
    )


def centroids(frame):
    return sorted(tuple(r) for r in frame.drop("load_dts").collect())


@pytest.mark.parametrize("seed", range(3))
def test_kept_centroids_are_those_of_all_points(spark, folder, seed):
    chance = random.Random(seed)
    rows = [
        (chance.choice([None, *range(8)]), chance.choice(["1", "2", "3"]), chance.choice([None, 0.25, -7.1, 1e6 / 3]), chance.choice("ab"), day)
        for day in range(30)
    ]
    kept, order = KeptPoints(spark, folder, [], []), rows[:]
    chance.shuffle(order)
    for start in range(0, 30, 8):
        batch = order[start : start + 8]
        _, open_ = kept.take(points(spark, batch + batch[:2] if start else batch))
        kept.close(open_)
        if start == 8:  # a batch once more
            kept.close(kept.take(points(spark, batch + batch[:2]))[1])
    # Rows without an id are as many points as the file has copies of them.
    copies = [row for start in (8, 16, 24) for row in order[start : start + 2] if row[0] is None]
    assert centroids(kept.centroids()) == centroids(zip_centroids(points(spark, rows + copies)))


def test_centroids_of_a_batch_that_died_are_caught_up_on(spark, store, folder, monkeypatch):
    raw = f"{folder}/raw"

    def land(rows, days):
        land_batch(points(spark, rows).select(*SOURCES["geolocation"].columns), raw, "geolocation", TODAY + dt.timedelta(days=days))

    land([(1, "1", 4.0, "a", 0), (2, "1", 8.0, "a", 0), (3, "2", 1.0, "a", 0)], 0)
    load_new_files(store, raw, "geolocation")
    land([(1, "1", 6.0, "a", 0), (3, "3", 1.0, "a", 0)], 1)

    def die(*_):
        raise OSError("lost")

    for place in ((KeptPoints, "_add_up"), (merge, "upsert")):
        monkeypatch.setattr(*place, die)
        with pytest.raises(OSError):
            load_new_files(store, raw, "geolocation")
        monkeypatch.undo()
    load_new_files(store, raw, "geolocation")
    found = {r[0]: r[1] for r in store.read("ref_geolocation").select("geolocation_zip_code_prefix", "geolocation_lat").collect()}
    assert found == {"1": 7.0, "3": 1.0}  # zip 2 lost its only point
    assert store.read("ref_geolocation").schema == store.rows("ref_geolocation").schema


def test_leftovers_of_dead_writes_are_no_files(spark, folder):
    leave_behind(spark, folder)
    (Path(folder) / ".hidden").mkdir()
    (Path(folder) / ".hidden" / "a.json").write_text("{}")
    assert not has_files(spark, folder)
    assert once(spark, folder, "first") == "first" and once(spark, folder, "second") == "first"
    assert has_files(spark, folder)


def test_a_late_older_row_of_a_reference_stays_behind(spark, store, folder):
    raw, name = f"{folder}/raw", "product_category_name_translation"
    for english, days in (("new", 0), ("old", -1)):
        land_batch(spark.createDataFrame([("a", english)], SOURCES[name].schema), raw, name, TODAY + dt.timedelta(days=days))
    whole = pipeline.load_dataset(store, name, read_batches(spark, raw, name, LOADED))
    assert whole[0].appended_rows == 1 and store.read("ref_product_category").first()["product_category_name_english"] == "new"


def test_references_of_parts_keep_their_newest_rows(spark, store, folder):
    raw, name = f"{folder}/raw", "product_category_name_translation"

    def land(rows, days):
        land_batch(spark.createDataFrame(rows, SOURCES[name].schema), raw, name, TODAY + dt.timedelta(days=days))
        load_new_files(store, raw, name)
        return {r[0]: r[1] for r in store.read("ref_product_category").select("product_category_name", "product_category_name_english").collect()}

    assert land([("a", "x"), ("b", "y"), (None, "z")], 0) == {"a": "x", "b": "y"}
    assert land([("a", "old"), ("c", "q")], -2) == {"a": "x", "b": "y", "c": "q"}
    assert land([("b", None), ("c", "r")], 1) == {"a": "x", "b": None, "c": "r"}


def test_a_slow_writer_keeps_its_lease_and_a_dead_one_loses_it(store, monkeypatch):
    monkeypatch.setattr("lakevault.operators.store.LEASE_SECONDS", 2.0)
    order = []

    def slow():
        with store.lease("hub_order"):
            order.append("slow in")
            time.sleep(5)
            order.append("slow out")

    thread = threading.Thread(target=slow)
    thread.start()
    time.sleep(0.5)
    with store.lease("hub_order"):
        order.append("second")
    thread.join()
    assert order == ["slow in", "slow out", "second"]
    store._create(f"{store.root}/_leases/hub_order", "a job that died")
    started = time.time()
    with store.lease("hub_order"):
        assert time.time() - started > 1.5
    with pytest.raises(RuntimeError, match="lost the lease"), store.lease("hub_order"):
        store._create(f"{store.root}/_leases/hub_order", "another job", again=True)


def test_rows_out_of_reach_are_counted_and_a_start_can_be_given(spark, folder):
    source = SOURCES["orders"]
    rows = [(f"o{k}", "c", "created", None if k == 3 else dt.datetime(2018, 5, k), None, None, None, None) for k in range(1, 6)]
    table, marks = spark.createDataFrame(rows, source.schema), Marks(spark, f"{folder}/marks")
    done = extract(spark, table, "orders", f"{folder}/raw", marks, TODAY, start=(dt.datetime(2018, 5, 2), "o2"))
    assert (done.rows, done.null_cursors, done.mark) == (2, 1, (dt.datetime(2018, 5, 5), "o5"))
    with pytest.raises(ValueError, match="2 values"):
        extract(spark, table, "orders", f"{folder}/raw", marks, TODAY, start=("o2",))
