"""Loads move business columns, not digests: those are added where rows are stored."""
import re
import time
from pathlib import Path

import pytest
from helpers import dataset, plan, versions
from pyspark.sql import functions as F

from lakevault.functions.hashing import digest
from lakevault.operators import history
from lakevault.operators.merge import write
from lakevault.operators.model import modelled, source_rows, vault_rows
from lakevault.operators.specs import MODEL, TABLES
from lakevault.plans import gold
from lakevault.plans.lasting import lasting_views
from lakevault.plans.pipeline import load_dataset, staged
from lakevault.session import release

ITEMS = [
    {"order_id": o, "order_item_id": n, "product_id": "p1", "seller_id": s, "price": float(n)}
    for o in ("o1", " O1", "o2") for n in (1, 2, 2) for s in ("s1", "S1 ")
]


def items(spark, rows=ITEMS, at=0):
    return dataset(spark, "order_items", rows, at)


def test_a_staged_batch_holds_no_digests(spark, store):
    with staged(store, items(spark), "order_items") as batch:
        assert batch.columns == items(spark).columns


def test_tables_are_written_by_an_entropy_coder(spark, store):
    load_dataset(store, "order_items", items(spark))
    files = list(Path(f"{store.root.removeprefix('file:')}/link_order_item").glob("*.parquet"))
    assert files and all(".zstd." in file.name for file in files)


@pytest.mark.parametrize("table", [t for name in ("order_items", "customers", "orders") for t in MODEL[name]], ids=lambda t: t.name)
def test_source_rows_become_the_same_vault_rows(spark, table):
    name = next(n for n, tables in MODEL.items() if table in tables)
    keys = {"order_id": " o1", "customer_id": "c1 ", "customer_unique_id": "u", "product_id": "p", "seller_id": "s", "order_item_id": 1}
    rows = dataset(spark, name, [keys, {}, dict.fromkeys(keys)])
    one, other = modelled(source_rows(rows, table), table), vault_rows(rows, table)
    assert one.schema == other.schema and one.collect() == other.collect() != []


@pytest.mark.parametrize("batch_rows", [18, 10**9])
@pytest.mark.parametrize("name", ["link_order_item", "sat_order_item_pricing"])
def test_source_rows_are_merged_like_vault_rows(spark, store, name, batch_rows):
    table, other = TABLES[name], store.within(spark)
    other.database, other.root = f"{store.database}_x", f"{store.root}_x"
    other.ensure_database()
    late = [{**row, "price": row["price"] + 1} for row in ITEMS] + [{**ITEMS[0], "order_id": "o3"}]
    for rows in (items(spark, ITEMS, 5), items(spark, late, 7), items(spark, late, 3), items(spark, ITEMS, 5)):
        counts = [write(store, table, source_rows(rows, table), batch_rows), write(other, table, vault_rows(rows, table), batch_rows)]
        assert counts[0] == counts[1]
    one, two = (sorted(map(str, s.read(name).collect())) for s in (store, other))
    assert one == two != []


def test_digests_do_not_travel(spark, store):
    """The shuffle of a first batch comes before the digests."""
    found = []
    original = store.append
    store.append = lambda table, rows: (found.append((table.name, plan(rows))), original(table, rows))[1]
    load_dataset(store, "order_items", items(spark))
    texts = dict(found)
    for name in ("link_order_item", "sat_order_item_pricing"):
        lines = texts[name].splitlines()
        shuffle = max(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
        assert any("sha2" in line for line in lines[:shuffle])
        assert not any("sha2" in line for line in lines[shuffle:])


def test_keys_without_a_hot_one_are_counted_by_bucket(spark, monkeypatch):
    """No shuffle of all keys to learn that none is hot; a full bucket is looked into."""
    rows = versions(spark, [(f"k{n % 7}", n, "a") for n in range(70)])
    assert history.slice_borders(rows, "k", 10) is None
    assert history.slice_borders(rows, "k", 9) is not None
    monkeypatch.setattr(history, "KEY_BUCKETS", 1)
    assert history.slice_borders(rows, "k", 10) is None
    assert history.slice_borders(rows, "k", 9).count() <= 7


def test_hashdiffs_are_worked_out_behind_the_shuffle_for_hot_keys_too(spark):
    rows = spark.range(300).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 9).cast("string"))).alias("k"),
        F.expr("id % 4 div 2").alias("value"),
        F.struct(F.timestamp_seconds("id").alias("at"), F.lit("").alias("tie")).alias("seq"),
    )
    ready = rows.withColumn("hashdiff", digest(["value"]))
    expected = history.decisions(ready, "k").select("k", "seq", "hashdiff", "value", "action").collect()
    found = history.decisions(rows, "k", hot_key_rows=50, hashdiff=digest(["value"])).select("k", "seq", "hashdiff", "value", "action").collect()
    assert sorted(map(str, found)) == sorted(map(str, expected))
    assert re.search("version", str(found))


def test_views_shuffle_keys_as_bytes(spark, store):
    """Keys are packed before the first shuffle of a view, and come out as the text that is stored."""
    load_dataset(store, "order_items", items(spark))
    names = dict(zip(gold.VIEWS, lasting_views(store)))
    for view in (gold.fact_order_item(store), spark.table(names["fact_order_item"])):
        lines = plan(view.hint("merge")).splitlines()
        shuffle = max(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
        assert any("unhex" in line for line in lines[shuffle:])
        keys = ["link_order_item_hk", "order_hk", "product_hk", "seller_hk"]
        assert view.select(keys).exceptAll(store.rows("link_order_item").select(keys)).isEmpty()
        assert view.count() == store.rows("link_order_item").count() > 0
    assert dict(gold.fact_order_item.inner(store).dtypes)["order_hk"] == "binary"


def test_a_load_leaves_no_shuffle_files(spark, store):
    def kept():
        return spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses().size()

    release(spark)
    for _ in range(3):
        load_dataset(store, "order_items", items(spark))
    deadline = time.time() + 20
    while kept() > 0 and time.time() < deadline:
        time.sleep(0.2)
    assert kept() == 0
