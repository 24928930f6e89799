import datetime as dt

import pytest
from helpers import LOADED, plan

from lakevault.sources.benchtables import dataset as bench
from lakevault.sources.extract import Marks, beyond, changed_rows, extract, page_after
from lakevault.sources.landing import land_batch
from lakevault.sources.raw import read_batches
from lakevault.sources.schemas import SOURCES, choose

TODAY = dt.date(2026, 7, 10)


def orders(spark, *rows):
    source = SOURCES["orders"]
    values = [(i, "c", "created", None if t is None else dt.datetime(2018, 5, t), None, None, None, None) for i, t in rows]
    return spark.createDataFrame(values, source.schema)


def ids(frame, column="order_id"):
    return [r[column] for r in frame.collect()]


def test_page_is_ordered_limited_and_beyond_the_mark(spark):
    table = orders(spark, ("o3", 3), ("o1", 1), ("o2", 1), ("o0", 1), ("ox", None))
    source = SOURCES["orders"]
    assert ids(page_after(table, source, None, 2)) == ["o0", "o1"]
    assert ids(page_after(table, source, (dt.datetime(2018, 5, 1), "o1"), 9)) == ["o2", "o3"]
    assert page_after(table, source, (dt.datetime(2018, 5, 3), "o3"), 9).isEmpty()


def test_cursor_needs_all_its_values():
    with pytest.raises(ValueError, match="2 values"):
        beyond(("order_id", "order_item_id"), ("o1",))


def test_the_cursor_reaches_the_scan(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    text = plan(table.where(beyond(("l_orderkey", "l_linenumber"), (10, 2))))
    assert "PushedFilters: [Or(GreaterThan(l_orderkey,10),And(" in text


def test_extract_lands_pages_and_resumes(spark, folder):
    marks = Marks(spark, f"{folder}/marks")
    table = orders(spark, ("o1", 1), ("o2", 2), ("o3", 3))
    first = extract(spark, table, "orders", f"{folder}/raw", marks, TODAY, 2)
    assert (first.rows, first.mark) == (2, (dt.datetime(2018, 5, 2), "o2"))
    second = extract(spark, table, "orders", f"{folder}/raw", marks, TODAY, 2)
    assert (second.rows, second.mark) == (1, (dt.datetime(2018, 5, 3), "o3"))
    third = extract(spark, table, "orders", f"{folder}/raw", marks, TODAY)
    assert (third.rows, third.mark) == (0, second.mark)
    landed = read_batches(spark, f"{folder}/raw", "orders", LOADED, layout="lines")
    assert sorted(ids(landed)) == ["o1", "o2", "o3"]
    assert landed.first()["raw_partition_date"] == TODAY


def test_nothing_to_extract_leaves_no_mark(spark, folder):
    marks = Marks(spark, f"{folder}/marks")
    assert extract(spark, orders(spark), "orders", f"{folder}/raw", marks, TODAY).mark is None
    assert marks.read(SOURCES["orders"]) is None


def test_changes_are_found_wherever_they_sort(spark, folder):
    source = SOURCES["sellers"]
    rows = [("s2", "1", "x", "SP"), ("s5", "1", "x", "SP")]
    land_batch(spark.createDataFrame(rows, source.schema), folder, "sellers", TODAY)
    land_batch(spark.createDataFrame([("s5", "1", "y", "SP")], source.schema), folder, "sellers", TODAY + dt.timedelta(1))
    today = [("s2", "1", "x", "SP"), ("s5", "1", "x", "SP"), ("s1", "1", "x", "SP")]
    landed = read_batches(spark, folder, "sellers", LOADED, layout="lines")
    found = changed_rows(spark.createDataFrame(today, source.schema), landed, source)
    assert sorted(ids(found, "seller_id")) == ["s1", "s5"]  # new below the mark, and changed back


def test_array_files_hold_every_row_once(spark, folder):
    items = bench(spark, "/root/testdata/sf0.001", "order_items")
    land_batch(items, folder, "order_items", TODAY, rows_per_array=500)
    back = read_batches(spark, folder, "order_items", LOADED)
    assert back.select("raw_file").distinct().count() > 5
    assert back.select(*items.columns).exceptAll(items).isEmpty() and back.count() == items.count()


def test_dataset_selection():
    assert choose(" ALL ") == list(SOURCES)
    assert choose("orders, customers,,") == ["orders", "customers"]
    with pytest.raises(ValueError, match="nope"):
        choose("orders,nope")


def test_referenced_tables_come_first():
    order = list(SOURCES)
    assert all(order.index(parent) < order.index(s.name) for s in SOURCES.values() for parent in s.foreign_keys.values())
