import datetime as dt
from functools import reduce

import pytest
from helpers import plan, versions
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakevault.operators import history
from lakevault.operators.history import FRESH, beside_sliced, current, decisions, new_versions, slice_borders


def found(frame):
    return sorted((r["k"], r["d"], r["hashdiff"]) for r in frame.collect())


def expected(rows):
    """Brute force: walk every key's rows in order and keep the changes."""
    kept = []
    for key in {k for k, _, _ in rows}:
        before = None
        for d, h in sorted({(d, h) for k, d, h in rows if k == key}):
            if h != before:
                kept.append((key, d, h))
            before = h
    return sorted(kept)


@pytest.mark.parametrize("small_batch", [True, False])
def test_away_and_back_is_a_new_version(spark, small_batch):
    stored = versions(spark, [("k1", 1, "a"), ("k1", 2, "b")])
    assert found(new_versions(versions(spark, [("k1", 3, "a")]), stored, "k", small_batch)) == [("k1", 3, "a")]


@pytest.mark.parametrize("small_batch", [True, False])
def test_unchanged_and_unseen(spark, small_batch):
    stored = versions(spark, [("k1", 1, "a"), ("k1", 2, "b")])
    incoming = versions(spark, [("k1", 3, "b"), ("k9", 3, "b")])
    assert found(new_versions(incoming, stored, "k", small_batch)) == [("k9", 3, "b")]


@pytest.mark.parametrize("small_batch", [True, False])
def test_repeating_a_load_adds_nothing(spark, small_batch):
    rows = [("k1", 1, "a"), ("k1", 2, "b"), ("k1", 3, "a"), ("k2", 5, "x"), ("k2", 5, "y")]
    stored = new_versions(versions(spark, rows), None, "k")
    assert new_versions(versions(spark, rows), stored, "k", small_batch).isEmpty()


@pytest.mark.parametrize("small_batch", [True, False])
def test_a_late_version_takes_its_place(spark, small_batch):
    stored = versions(spark, [("k1", 1, "a"), ("k1", 5, "c")])
    incoming = versions(spark, [("k1", 3, "b"), ("k1", 0, "a"), ("k1", 6, "c")])
    assert found(new_versions(incoming, stored, "k", small_batch)) == [("k1", 0, "a"), ("k1", 3, "b")]


ROWS = st.lists(st.tuples(st.sampled_from(["k1", "k2", "hot"]), st.integers(0, 30), st.sampled_from("abc")), min_size=1, max_size=60)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS, st.booleans())
def test_batches_in_order_give_the_full_history(spark, rows, small_batch):
    early, late = [r for r in rows if r[1] < 15], [r for r in rows if r[1] >= 15]
    batches = [b for b in (early, late) if b]
    kept = None
    for batch in batches:
        fresh = new_versions(versions(spark, batch), kept, "k", small_batch)
        kept = fresh if kept is None else kept.unionByName(fresh)
    assert found(kept) == expected(rows)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS, st.integers(1, 9))
def test_a_split_timeline_gives_the_same_rows(spark, rows, limit):
    timeline = versions(spark, rows + rows).withColumn("_state", F.lit(FRESH))
    borders = slice_borders(timeline, "k", limit)
    if borders is not None:
        split = beside_sliced(timeline, "k", borders)
        assert found(split.where(~F.col("_before").eqNullSafe(F.col("hashdiff")))) == expected(rows)


def timed(spark, rows):
    """Rows (key, tie, hashdiff) of one moment, told apart by the tie alone."""
    frame = spark.createDataFrame(rows, "k string, d int, hashdiff string")
    at = F.timestamp_seconds(F.lit(1_700_000_000))
    return frame.withColumn("seq", F.struct(at.alias("at"), F.lpad(F.col("d").cast("string"), 6, "0").alias("tie")))


def test_a_hot_key_of_one_moment_is_split_by_rank(spark):
    rows = [("hot", d, "abc"[d * d // 7 % 3]) for d in range(5000)] + [("cold", d, "a") for d in range(50)]
    timeline = timed(spark, rows).withColumn("_state", F.lit(FRESH))
    assert slice_borders(timeline, "k", 10_000) is None
    borders = slice_borders(timeline, "k", 100)
    assert [row["k"] for row in borders.select("k").collect()] == ["hot"]
    sizes = timeline.join(borders, "k").groupBy(history.slice_number().alias("slice")).count().collect()
    assert len(sizes) >= 50 and max(row["count"] for row in sizes) < 300
    assert found(new_versions(timed(spark, rows), None, "k", hot_key_rows=100)) == expected(rows)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 9), st.sampled_from("ab")), min_size=1, max_size=40))
def test_slices_with_equal_times(spark, pairs):
    rows = [("hot", d, h) for d, h in pairs]
    for limit in (1, 3, 8):
        assert found(new_versions(timed(spark, rows + rows[:5]), None, "k", hot_key_rows=limit)) == expected(rows)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS, st.randoms(use_true_random=False), st.integers(1, 4), st.booleans(), st.sampled_from([None, 3]))
def test_any_order_and_any_batches_give_the_versions_of_one_load(spark, rows, random, parts, small_batch, limit):
    """The store's part played by three sets of rows."""
    rows = list(rows)
    random.shuffle(rows)
    stored, dead, seen = set(), set(), set()
    for part in range(parts):
        batch = rows[part::parts]
        if not batch:
            continue
        frames = [versions(spark, sorted(group)) if group else None for group in (stored - dead, dead, seen)]
        done = decisions(versions(spark, batch), "k", *frames, small_batch=small_batch, hot_key_rows=limit or 10**6).collect()
        for row in done:
            # Stored rows come back without their payload.
            place = next(r for r in rows if r[0] == row["k"] and r[2] == row["hashdiff"] and history_day(row) == r[1])
            {"version": stored.add, "seen": seen.add, "retire": dead.add, "revive": dead.discard}[row["action"]](place)
    assert sorted(stored - dead) == expected(rows)
    assert stored | seen == set(rows)


def history_day(row):
    return int(row["seq"]["at"].replace(tzinfo=dt.timezone.utc).timestamp() - 1_700_000_000) // 86400


def test_rows_without_a_time_come_first(spark):
    rows = versions(spark, [("k1", 1, "a")])
    undated = rows.withColumn("seq", F.struct(F.lit(None).cast("timestamp").alias("at"), F.lit("").alias("tie")))
    late = undated.withColumn("hashdiff", F.lit("z"))
    stored = rows.unionByName(undated.limit(0))
    assert new_versions(late, stored, "k", True).count() == 1
    assert new_versions(undated, new_versions(undated, None, "k"), "k", True).isEmpty()
    both = reduce(lambda a, b: a.unionByName(b), [rows, late])
    assert found(new_versions(both, None, "k", hot_key_rows=1)) == [("k1", 1, "a"), ("k1", 1, "z")]


def test_current_is_the_newest(spark):
    rows = versions(spark, [("k1", 1, "a"), ("k1", 2, "b"), ("k2", 1, "z"), ("k1", 2, "c")])
    assert found(current(rows, "k")) == [("k1", 2, "c"), ("k2", 1, "z")]
    assert "WindowGroupLimit" in plan(current(rows, "k"))


def test_a_small_batch_does_not_shuffle_the_stored_table(spark, folder):
    versions(spark, [("k%d" % i, i, "a") for i in range(50)]).write.parquet(folder)
    text = plan(new_versions(versions(spark, [("k1", 99, "b")]), spark.read.parquet(folder), "k", True, most_rows=51))
    scan = text.index("FileScan parquet")
    above = text[:scan]
    assert above.rindex("BroadcastHashJoin") > above.rindex("Exchange hashpartitioning")
    assert "ReadSchema: struct<k:string,hashdiff:string,seq:struct<at:timestamp,tie:string>>" in text
