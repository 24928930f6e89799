"""What queries leave on disk while they run: shuffles of one step at a time."""
import pytest
from conftest import SMALL
from helpers import dataset, plan
from pyspark.sql import functions as F

from lakevault.operators import merge
from lakevault.plans import gold, registry
from lakevault.plans.pipeline import load_dataset


@pytest.mark.parametrize("name", ["lasting_views", "views_as_tables"])
def test_views_are_worked_through_one_by_one(spark, monkeypatch, name):
    """What one view has shuffled is given back before the next one begins."""
    calls = []
    monkeypatch.setattr(registry, "release", lambda session: calls.append(session))
    assert registry.QUERIES[name](spark, SMALL).count() == len(calls) == len(registry.gold.VIEWS)


def test_a_first_load_goes_through_slices_of_its_keys(spark, store, monkeypatch):
    """Rows of a key stay together, whatever the slices; a load in slices stores what one in a piece does."""
    rows = dataset(spark, "order_items", [
        {"order_id": o, "order_item_id": n, "product_id": "p", "seller_id": s, "price": float(n)}
        for o in ("o1", " O1", "o2", "o3") for n in (1, 2, 2) for s in ("s1", "S1 ")
    ])
    later = rows.withColumn("seq", F.struct(F.col("seq.at") + F.expr("interval 1 day"), F.col("seq.tie").alias("tie")).cast(rows.schema["seq"].dataType))
    batch = rows.unionByName(later).unionByName(later.withColumn("price", F.col("price") + 1))
    other = store.within(spark)
    other.database, other.root = f"{store.database}_x", f"{store.root}_x"
    other.ensure_database()
    whole = load_dataset(other, "order_items", batch)
    monkeypatch.setattr(merge, "SLICE_ROWS", 20)
    appends, original = [], store.append
    store.append = lambda table, found: (appends.append(table.name), original(table, found))[1]
    assert load_dataset(store, "order_items", batch) == whole
    assert appends.count("link_order_item") == 4
    for name in ("link_order_item", "sat_order_item_pricing", "sat_order_item_pricing_seen"):
        one, two = (sorted(map(str, s.rows(name).collect())) for s in (store, other))
        assert one == two != []
    assert [w.appended_rows for w in load_dataset(store, "order_items", batch)] == [0, 0]


def test_reports_meet_by_half_a_digest(spark, store):
    store.ensure_all()
    assert "substring(unhex" in plan(gold.reader(store)("fact_order_item", "order_hk", "price"))
    assert "substring(unhex" not in plan(gold.fact_order_item(store))
