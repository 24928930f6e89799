"""Large batches beside stored rows: one shuffle for a hub or link, decisions of a satellite worked out once."""
import re

import pytest
from helpers import dataset, plan

from lakevault.operators import merge
from lakevault.operators.merge import write
from lakevault.operators.model import source_rows
from lakevault.operators.specs import TABLES

LARGE = 10**9


def items(spark, *rows, at=0):
    names = ("order_id", "order_item_id", "product_id", "seller_id", "price")
    return dataset(spark, "order_items", [dict(zip(names, row)) for row in rows], at)


@pytest.mark.parametrize("name,source", [("hub_order", "orders"), ("link_order_customer", "orders")])
def test_rows_and_stored_keys_share_one_shuffle(spark, store, name, source):
    def rows(*orders):
        return source_rows(dataset(spark, source, [{"order_id": o, "customer_id": "c1"} for o in orders]), TABLES[name])

    write(store, TABLES[name], rows("o1", " O2 "), LARGE)
    plans, original = [], store.append
    store.append = lambda table, found: (plans.append(plan(found)), original(table, found))[1]
    assert write(store, TABLES[name], rows("o2", "o3", "O3 ", "o1"), LARGE).appended_rows == 1
    assert len(re.findall("Exchange hashpartitioning", plans[0])) == 1 and "Join" not in plans[0]
    assert store.rows(name).count() == 3


def test_decisions_beside_stored_rows_are_worked_out_once(spark, store, monkeypatch):
    """A late half that brings versions, unchanged rows and a superfluous version: all of them from one comparison."""
    table = TABLES["sat_order_item_pricing"]

    def batch(*rows):
        found = [items(spark, ("o1", 1, "p", "s", price), at=at) for at, price in rows]
        frame = found[0]
        for other in found[1:]:
            frame = frame.unionByName(other)
        return source_rows(frame, table)

    write(store, table, batch((2, 1.0), (4, 1.0), (6, 2.0)), LARGE)
    calls, original = [], merge.decisions
    monkeypatch.setattr(merge, "decisions", lambda *a, **k: (calls.append(1), original(*a, **k))[1])
    assert write(store, table, batch((1, 1.0), (3, 3.0), (5, 2.0), (7, 2.0)), LARGE).appended_rows == 4
    assert len(calls) == 1
    assert [(r["seq"]["at"].day, r["price"]) for r in store.read(table.name).orderBy("seq").collect()] == [(2, 1.0), (4, 3.0), (5, 1.0), (6, 2.0)]
    assert write(store, table, batch((1, 1.0), (2, 1.0), (3, 3.0), (4, 1.0), (5, 2.0), (6, 2.0), (7, 2.0)), LARGE).appended_rows == 0
    assert {r["seq"]["at"].day for r in store.rows(f"{table.name}_retired").where("dead").collect()} == {3, 7}
