import dataclasses
import datetime as dt
import hashlib
from random import Random

import pytest
from helpers import LOADED, dataset, plan
from pyspark.sql import functions as F

from lakevault.operators import merge
from lakevault.operators.merge import fits_broadcast, missing_rows, write
from lakevault.operators.model import stamped, vault_rows
from lakevault.operators.specs import HUBS, TABLES
from lakevault.operators.store import VaultStore
from lakevault.plans.pipeline import load_dataset

SATELLITE = TABLES["sat_customer_profile"]
REFERENCE = TABLES["ref_product_category"]


def customers(spark, *rows, at=0):
    return dataset(
        spark, "customers",
        [{"customer_id": a, "customer_unique_id": p, "customer_state": s} for a, p, s in rows], at,
    )


def put(store, table, rows, batch_rows=None):
    ready = vault_rows(rows, table)
    return write(store, table, ready, rows.count() if batch_rows is None else batch_rows).appended_rows


@pytest.mark.parametrize("batch_rows", [None, 10**9])
def test_hubs_keep_the_first_row_of_a_key(spark, store, batch_rows):
    hub = HUBS["customer_account"]
    assert put(store, hub, customers(spark, ("c1", "u1", "SP"), ("c1", "u1", "SP"))) == 1
    assert put(store, hub, customers(spark, ("C1 ", "u1", "RJ"), ("c2", "u2", "RJ")), batch_rows) == 1
    assert sorted(r["customer_id"] for r in store.read(hub.name).collect()) == ["c1", "c2"]


SNAPSHOT = TABLES["sat_hot_customer_profile"]


def profiles(spark, *rows):
    """Event-like rows (customer, day, city)."""
    frame = spark.createDataFrame(rows, "customer_unique_id string, d int, customer_city string")
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("d") * 86400)
    return stamped(
        frame.select(
            "customer_unique_id", "customer_city",
            *(F.lit(None).cast("string").alias(c) for c in ("customer_name", "customer_state", "customer_zip_code_prefix")),
            F.struct(at.alias("at"), F.lit("").alias("tie")).alias("seq"),
        ),
        "raw.hot.events", LOADED,
    )


@pytest.mark.parametrize("batch_rows", [None, 10**9])
def test_a_late_row_does_not_become_current(spark, store, batch_rows):
    def current():
        return {r["customer_hk"][:4]: r["customer_city"] for r in store.current(SNAPSHOT.name).collect()}

    put(store, SNAPSHOT, profiles(spark, ("u1", 1, "a"), ("u1", 5, "A "), ("u2", 1, "x")), batch_rows)
    assert store.read(SNAPSHOT.name).count() == 2
    assert put(store, SNAPSHOT, profiles(spark, ("u1", 3, "b")), batch_rows) == 2
    assert sorted(current().values()) == ["A ", "x"]
    history = [r["customer_city"] for r in store.read(SNAPSHOT.name).orderBy("seq").collect() if r["customer_city"] != "x"]
    assert history == ["a", "b", "A "]
    assert put(store, SNAPSHOT, profiles(spark, ("u1", 3, "b"), ("u1", 1, "a"), ("u1", 5, "A ")), batch_rows) == 0


def test_a_change_back_is_dated_by_the_first_row_that_says_so(spark, store):
    def history():
        return [(r["seq"]["at"].day, r["customer_city"]) for r in store.read(SNAPSHOT.name).orderBy("seq").collect()]

    put(store, SNAPSHOT, profiles(spark, ("u1", 1, "a")))
    put(store, SNAPSHOT, profiles(spark, ("u1", 3, "a"), ("u1", 5, "a")))
    assert put(store, SNAPSHOT, profiles(spark, ("u1", 2, "b"))) == 2
    first, second, third = history()
    assert [city for _, city in (first, second, third)] == ["a", "b", "a"] and third[0] - second[0] == 1
    # A late row takes a version's place, and another one gives it back.
    put(store, SNAPSHOT, profiles(spark, ("u2", 1, "x"), ("u2", 9, "y")))
    put(store, SNAPSHOT, profiles(spark, ("u2", 5, "y")))
    assert [city for _, city in history()].count("y") == 1 and store.rows(SNAPSHOT.name).where("customer_city = 'y'").count() == 2
    put(store, SNAPSHOT, profiles(spark, ("u2", 7, "z")))
    assert [city for _, city in history() if city > "b"] == ["x", "y", "z", "y"]
    again = profiles(spark, *(("u2", d, c) for d, c in [(1, "x"), (9, "y"), (5, "y"), (7, "z")]))
    assert put(store, SNAPSHOT, again) == 0 and len(history()) == 7


def test_batches_in_any_order_agree_on_the_current_row(spark, store):
    random = Random(7)
    rows = [(f"u{i % 3}", day, random.choice("ab")) for i, day in enumerate(random.sample(range(60), 36))]
    for start in range(0, 36, 9):
        put(store, SNAPSHOT, profiles(spark, *rows[start:start + 9]))
    newest = {key: max((d, c) for k, d, c in rows if k == key)[1] for key in ("u0", "u1", "u2")}
    known = {r["customer_hk"]: r["customer_city"] for r in store.current(SNAPSHOT.name).collect()}
    assert known == {hashlib.sha256(k.upper().encode()).hexdigest(): c for k, c in newest.items()}


@pytest.mark.parametrize("batch_rows", [None, 10**9])
def test_satellites_take_changes_only(spark, store, batch_rows):
    states = ["SP", "RJ", "RJ", "sp ", "SP"]
    appended = [
        put(store, SATELLITE, customers(spark, ("c1", "u1", state), at=number), batch_rows)
        for number, state in enumerate(states)
    ]
    assert appended == [1, 1, 0, 1, 0]
    assert store.current(SATELLITE.name).first()["customer_state"] == "sp "


def test_references_hold_the_newest_row(spark, store):
    def names(*pairs, day):
        rows = [{"product_category_name": a, "product_category_name_english": b} for a, b in pairs]
        return dataset(spark, "product_category_name_translation", rows, loaded=LOADED + dt.timedelta(days=day))

    assert put(store, REFERENCE, names(("a", "x"), ("b", None), ("a", "w"), day=0)) == 2
    assert put(store, REFERENCE, names(("a", "z"), ("b", None), ("c", "y"), day=1)) == 2
    found = {r[0]: r[1] for r in store.read(REFERENCE.name).select(*REFERENCE.natural_key, *REFERENCE.payload).collect()}
    assert found == {"a": "z", "b": None, "c": "y"}
    assert put(store, REFERENCE, names(("a", "z"), ("b", None), ("c", "y"), day=2)) == 0


@pytest.mark.parametrize("table", [HUBS["customer"], SATELLITE, REFERENCE], ids=lambda t: t.kind)
def test_an_empty_batch_creates_the_table_only(spark, store, table):
    source = "product_category_name_translation" if table is REFERENCE else "customers"
    assert put(store, table, dataset(spark, source, [])) == 0
    assert store.read(table.name).isEmpty()


def test_an_unknown_kind_is_an_error(spark, store):
    with pytest.raises(ValueError, match="unknown kind"):
        write(store, dataclasses.replace(SATELLITE, kind="bridge"), vault_rows(customers(spark), SATELLITE), 0)


def test_every_table_can_be_registered_twice(spark, store):
    store.ensure_all()
    store.ensure_all()
    assert {t.name for t in spark.catalog.listTables(store.database)} >= set(TABLES)
    assert all(store.read(name).isEmpty() for name in TABLES)


def test_a_store_can_be_opened_again(spark, store):
    load_dataset(store, "customers", customers(spark, ("c1", "u1", "SP")))
    other = VaultStore(spark, store.root, store.database + "_again")
    other.ensure_all()
    assert other.read("hub_customer").count() == 1
    assert put(other, HUBS["customer"], customers(spark, ("c1", "u1", "SP"), ("c2", "u2", "SP"))) == 1
    assert store.read("hub_customer").count() == 2


def test_a_repeated_load_adds_nothing(spark, store):
    rows = customers(spark, ("c1", "u1", "SP"), ("c2", "u1", "RJ"))
    assert all(w.appended_rows for w in load_dataset(store, "customers", rows))
    assert not any(w.appended_rows for w in load_dataset(store, "customers", rows))


def test_a_broadcast_is_bounded_by_the_batch():
    assert fits_broadcast(merge.BROADCAST_BYTES // merge.KEY_ROW_BYTES)
    assert not fits_broadcast(merge.BROADCAST_BYTES // merge.KEY_ROW_BYTES + 1)


def test_a_small_batch_leaves_the_hub_unshuffled(spark, store):
    hub = HUBS["customer_account"]
    put(store, hub, customers(spark, *((f"c{i}", "u", "SP") for i in range(30))))
    rows = vault_rows(customers(spark, ("c1", "u", "SP"), ("d1", "u", "SP")), hub)
    text = plan(missing_rows(rows, store.read(hub.name), hub.key, True))
    scan = text.index("FileScan parquet")
    # Between the stored table and the final join there is nothing but broadcast joins.
    assert "LeftAnti" in text and "LeftSemi" in text
    assert "Exchange hashpartitioning" not in text[text.index("LeftSemi"):scan]
    assert "ReadSchema: struct<customer_account_hk:string>" in text


def test_a_bucketed_hub_is_merged_without_shuffling_it(spark, folder):
    store = VaultStore(spark, f"{folder}/bucketed", "bucketed_" + folder[-10:], buckets=4)
    store.ensure_database()
    hub = HUBS["customer_account"]
    assert put(store, hub, customers(spark, *((f"c{i}", "u", "SP") for i in range(30)))) == 30
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = vault_rows(customers(spark, ("c1", "u", "SP"), ("d1", "u", "SP")), hub)
        text = plan(missing_rows(rows, store.read(hub.name), hub.key, False))
        assert text.count("Exchange hashpartitioning") == 1
        assert "SelectedBucketsCount: 4 out of 4" in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert put(store, hub, customers(spark, ("c1", "u", "SP"), ("d1", "u", "SP"))) == 1
    assert store.read(hub.name).count() == 31
