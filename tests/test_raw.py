import datetime as dt
import json
from pathlib import Path

import pytest
from helpers import LOADED

from lakevault.sources.raw import flat_events, has_files, read_batches, read_events, read_unreadable
from lakevault.sources.schemas import SOURCES

DAY = "year=2026/month=07/day=10"


def put(folder, dataset, name, text, day=DAY):
    target = Path(folder) / dataset / day
    target.mkdir(parents=True, exist_ok=True)
    (target / name).write_text(text)


def event(number, **more):
    return {
        "event_id": f"e{number}", "event_type": "order_created", "event_timestamp": "2026-07-10T10:00:00.123456+00:00",
        "customer": {"customer_unique_id": "u1", "customer_name": "n", "customer_city": "c", "customer_state": "SP",
                     "customer_zip_code_prefix": "1"},
        "order": {"order_id": "o1", "product_category_name": "p", "product_name": "q", "items_count": 1, "price": 2.5,
                  "freight_value": 1.0},
        "payment": {"payment_type": "boleto", "payment_installments": 1}, **more,
    }


def test_one_row_per_array_element(spark, folder):
    people = [{"customer_id": "c1", "customer_unique_id": "u1"}, {"customer_id": "c2", "customer_unique_id": "u2"}]
    put(folder, "customers", "120000-000001-page0001.json", json.dumps(people, indent=2))
    rows = read_batches(spark, folder, "customers", LOADED, layout="pretty").collect()
    assert sorted(r["customer_id"] for r in rows) == ["c1", "c2"]
    assert {r["raw_partition_date"] for r in rows} == {dt.date(2026, 7, 10)}
    assert {(r["raw_year"], r["raw_month"], r["raw_day"]) for r in rows} == {("2026", "07", "10")}
    assert {r["record_source"] for r in rows} == {"raw.olist.customers"}
    assert all(r["raw_file"].endswith("page0001.json") for r in rows)


def test_lines_and_one_line_arrays_side_by_side(spark, folder):
    put(folder, "sellers", "a.json", '[{"seller_id":"s1"},{"seller_id":"s2"}]')
    put(folder, "sellers", "b.json", '{"seller_id":"s3"}\n{"seller_id":"s4"}\n')
    rows = read_batches(spark, folder, "sellers", LOADED).collect()
    assert sorted(r["seller_id"] for r in rows) == ["s1", "s2", "s3", "s4"]
    assert {r["seq"]["tie"] for r in rows} == {"2026/month=07/day=10/a.json", "2026/month=07/day=10/b.json"}
    with pytest.raises(ValueError, match="several values"):
        read_batches(spark, folder, "sellers", LOADED, layout="pretty")
    with pytest.raises(ValueError, match="unknown layout"):
        read_batches(spark, folder, "sellers", LOADED, layout="array")


def test_a_broken_file_and_a_bad_value(spark, folder):
    put(folder, "order_items", "a.json", '[{"order_id":"o1","order_item_id":1,"price":"x"},{"order_id":"o2","order_item_id":2,"price":2.5}]')
    put(folder, "order_items", "b.json", '[{"order_id":"o3"},')
    rows = {r["order_id"]: r["price"] for r in read_batches(spark, folder, "order_items", LOADED).collect()}
    assert rows == {"o1": None, "o2": 2.5}
    left_out = read_unreadable(spark, folder, "order_items").collect()
    assert [(r["raw_file"].rsplit("/", 1)[1], r["payload"]) for r in left_out] == [("b.json", '[{"order_id":"o3"},')]


def test_an_event_file(spark, folder):
    put(folder, "events", "m1.json", json.dumps(event(1)))
    put(folder, "events", "m2.json", '{"event_id":"e2"}')
    put(folder, "events", "m3.json", "nao-e-json{")
    rows = {r["event_id"]: r for r in flat_events(read_events(spark, folder, LOADED)).collect()}
    assert set(rows) == {"e1", "e2"}
    assert rows["e1"]["record_source"] == "raw.hot.events"
    assert rows["e1"]["price"] == 2.5 and rows["e1"]["event_timestamp"].microsecond == 123456
    assert rows["e2"]["order_id"] is None and rows["e2"]["payment_type"] is None
    assert read_unreadable(spark, folder, "events").count() == 1


def test_nothing_landed_gives_an_empty_frame_of_the_same_schema(spark, folder):
    empty = read_batches(spark, folder, "orders", LOADED)
    assert empty.isEmpty()
    put(folder, "orders", "a.json", "[]")
    assert read_batches(spark, folder, "orders", LOADED).schema.names == empty.schema.names
    assert set(SOURCES["orders"].columns) < set(empty.columns)
    assert read_events(spark, folder, LOADED).isEmpty()


def test_has_files(spark, folder):
    assert not has_files(spark, f"{folder}/orders")
    put(folder, "orders", "a.json", "[]")
    assert has_files(spark, f"{folder}/orders")


def test_only_the_asked_days_are_read(spark, folder):
    from helpers import plan

    put(folder, "customers", "a.json", '[{"customer_id":"old"}]', "year=2026/month=07/day=09")
    put(folder, "customers", "b.json", '[{"customer_id":"new"}]')
    rows = read_batches(spark, folder, "customers", LOADED, since=dt.date(2026, 7, 10))
    assert [r["customer_id"] for r in rows.collect()] == ["new"]
    assert "PartitionFilters: [isnotnull(year" in plan(rows)
