import datetime as dt
import inspect
import json

import pytest
from conftest import SMALL
from helpers import dataset, exchanges, plan
from test_raw import event, put

from lakevault.plans import gold, registry, reports
from lakevault.plans.pipeline import load_dataset
from lakevault.plans.registry import new_store
from lakevault.session import run_folder
from lakevault.sources.raw import flat_events, read_events

LOADED = dt.datetime(2026, 7, 10, tzinfo=dt.timezone.utc)


def at(month, day, hour=0):
    return dt.datetime(2018, month, day, hour)


@pytest.fixture(scope="module")
def shop(spark):
    """Two accounts, three orders with items, one order that only an event knows."""
    folder = run_folder(spark, "shop")
    store = new_store(spark, "shop")

    def load(name, *rows):
        load_dataset(store, name, dataset(spark, name, list(rows)))

    store.ensure_all()
    load("customers",
         {"customer_id": "a1", "customer_unique_id": "u1", "customer_zip_code_prefix": "1", "customer_state": "SP"},
         {"customer_id": "a2", "customer_unique_id": "u1", "customer_zip_code_prefix": "9", "customer_state": None})
    load("geolocation", {"geolocation_id": 1, "geolocation_zip_code_prefix": "1", "geolocation_lat": 1.0, "geolocation_lng": 2.0})
    load("products",
         {"product_id": "p1", "product_category_name": "livros", "product_length_cm": 2000, "product_height_cm": 2000, "product_width_cm": 2000},
         {"product_id": "p2", "product_category_name": "moda"}, {"product_id": "p3"})
    load("product_category_name_translation", {"product_category_name": "livros", "product_category_name_english": "books"})
    load("orders",
         {"order_id": "o1", "customer_id": "a1", "order_status": "delivered", "order_purchase_timestamp": at(5, 1, 23),
          "order_delivered_customer_date": at(5, 3, 1), "order_estimated_delivery_date": at(5, 4, 0)},
         {"order_id": "o2", "customer_id": "a1", "order_status": "delivered", "order_purchase_timestamp": at(5, 1),
          "order_delivered_customer_date": at(5, 9, 0), "order_estimated_delivery_date": at(5, 4, 0)},
         {"order_id": "o3", "customer_id": "a1", "order_status": "shipped", "order_purchase_timestamp": at(5, 2)},
         {"order_id": "o3", "customer_id": "a2", "order_status": "shipped", "order_purchase_timestamp": at(5, 2)})
    item = {"seller_id": "s1", "freight_value": 0.2}
    load("order_items",
         {"order_id": "o1", "order_item_id": 1, "product_id": "p1", "price": 0.1, **item},
         {"order_id": "o1", "order_item_id": 2, "product_id": "p2", "price": 10.0, **item},
         {"order_id": "o2", "order_item_id": 1, "product_id": "p1", "price": 5.0, **item},
         {"order_id": "o3", "order_item_id": 1, "product_id": "p3", "price": 1.0, **item})
    load("order_reviews",
         {"review_id": "r1", "order_id": "o1", "review_score": 5, "review_creation_date": at(5, 4), "review_answer_timestamp": at(5, 4, 23)},
         {"review_id": "r1", "order_id": "o2", "review_score": 5, "review_creation_date": at(5, 4), "review_answer_timestamp": at(5, 5, 1)})
    put(folder, "events", "e1.json", json.dumps(event(1)))
    first = {**event(2), "event_timestamp": "2026-07-10T09:00:00Z", "event_type": "order_approved"}
    first["order"] = {**first["order"], "order_id": "o9", "price": 7.0}
    put(folder, "events", "e2.json", json.dumps(first))
    load_dataset(store, "events", flat_events(read_events(spark, folder, LOADED)))
    return store


def by(frame, key):
    return {r[key]: r for r in frame.collect()}


def test_dim_customer(shop):
    rows = by(gold.dim_customer(shop), "customer_id")
    assert (rows["a1"]["customer_unique_id"], rows["a1"]["customer_lat"], rows["a1"]["customer_lng"]) == ("u1", 1.0, 2.0)
    assert rows["a2"]["customer_hk"] == rows["a1"]["customer_hk"] and rows["a2"]["customer_lat"] is None


def test_dim_product(shop):
    rows = by(gold.dim_product(shop), "product_id")
    assert [rows[p]["product_category_name_english"] for p in ("p1", "p2", "p3")] == ["books", "moda", None]
    assert rows["p1"]["product_volume_cm3"] == 8_000_000_000 and rows["p2"]["product_volume_cm3"] is None


def test_fact_order_days_and_fan_out(shop):
    rows = gold.fact_order(shop).collect()
    assert sorted(r["order_id"] for r in rows) == ["o1", "o2", "o3", "o3", "o9"]  # o3 has two accounts
    one = next(r for r in rows if r["order_id"] == "o1")
    assert (one["dias_ate_entrega"], one["dias_de_atraso"]) == (1, 0)  # 26 hours; 23 hours early
    assert one["order_purchase_date"] == dt.date(2018, 5, 1)
    only_event = next(r for r in rows if r["order_id"] == "o9")
    assert only_event["order_status"] is None and only_event["customer_account_hk"] is None


def test_fact_order_item_adds_up_exactly(shop):
    assert sorted(r["valor_total_item"] for r in gold.fact_order_item(shop).collect()) == [0.3, 1.2, 5.2, 10.2]


def test_fact_order_review_has_a_row_per_review_and_order(shop):
    rows = gold.fact_order_review(shop).collect()
    assert len(rows) == 2 and len({r["order_hk"] for r in rows}) == 2
    assert {r["dias_ate_resposta"] for r in rows} <= {0, 1}


def test_fact_order_event_and_hours(shop):
    rows = by(gold.fact_order_event(shop), "event_id")
    assert (rows["e1"]["valor_total_evento"], rows["e2"]["valor_total_evento"]) == (3.5, 8.0)
    assert rows["e1"]["raw_partition_date"] == dt.date(2026, 7, 10)
    hours = {(r["hora"].hour, r["event_type"]): (r["eventos"], r["pedidos_distintos"], r["valor_total"]) for r in gold.agg_order_event_hourly(shop).collect()}
    assert hours == {(10, "order_created"): (1, 1, 3.5), (9, "order_approved"): (1, 1, 8.0)}


def test_reports(shop):
    view = gold.reader(shop)
    revenue = reports.run_report("receita_por_categoria", view).collect()
    assert [(r["categoria"], r["pedidos"], r["itens"], r["receita"]) for r in revenue] == [
        ("moda", 1, 1, 10.0), ("books", 2, 2, 5.1), (None, 1, 1, 1.0),
    ]
    tickets = reports.run_report("ticket_medio_por_estado", view).collect()
    assert [(r["estado"], r["pedidos"], r["receita"], r["ticket_mediano"]) for r in tickets] == [("SP", 3, 16.9, 5.2)]
    delivery = reports.run_report("prazo_de_entrega_por_estado", view).collect()
    assert [(r["estado"], r["pedidos_entregues"], r["dias_medios_ate_entrega"], r["entregas_atrasadas"], r["taxa_de_atraso"]) for r in delivery] == [
        ("SP", 2, 4.5, 1, 0.5)
    ]
    funnel = reports.run_report("funil_de_eventos", view).collect()
    assert [(r["estagio"], r["pedidos"], r["conversao_do_topo"]) for r in funnel] == [("order_approved", 1, 1.0), ("order_created", 1, 1.0)]


def test_views_can_be_asked_for_some_columns(shop):
    for name, view in gold.VIEWS.items():
        everything = view(shop, None)
        for column in everything.columns:
            part = view(shop, (column,))
            assert part.columns == [column], name
        last = everything.columns[-1]
        assert view(shop, (last,)).exceptAll(everything.select(last)).isEmpty(), name


def test_a_report_does_not_read_what_it_does_not_need(shop):
    text = plan(reports.run_report("ticket_medio_por_estado", gold.reader(shop)))
    assert "sat_order_status" not in text and "ref_geolocation" not in text
    assert "sat_hot_" not in plan(reports.run_report("funil_de_eventos", gold.reader(shop)))


def test_the_largest_categories_come_from_a_top_k(shop):
    assert "TakeOrderedAndProject" in plan(reports.run_report("receita_por_categoria", gold.reader(shop)))


def test_views_as_tables(spark, shop):
    names = gold.create_views(shop, "t_")
    assert names == [f"t_{n}" for n in gold.VIEWS]
    assert spark.sql("select count(*) as n from t_dim_customer where customer_state = 'SP'").first()["n"] == 1
    gold.create_views(shop, "t_")


def test_reports_read_views_only():
    source = inspect.getsource(reports)
    assert "store" not in source and "hub_" not in source and "sat_" not in source


def test_an_unknown_report_names_the_known_ones():
    with pytest.raises(ValueError, match="receita_por_categoria"):
        reports.run_report("nope", None)


def test_views_resolve_before_the_first_load(store):
    store.ensure_all()
    assert all(view(store, None).isEmpty() for view in gold.VIEWS.values())


def test_reports_read_no_table_they_do_not_need(spark):
    registry.vault(spark, SMALL, "customers", "geolocation", "orders", "order_items", "events")
    view = gold.reader(registry.vault(spark, SMALL))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert exchanges(reports.run_report("funil_de_eventos", view)) <= 5
        assert exchanges(reports.run_report("ticket_medio_por_estado", view)) <= 10
        for name in ("funil_de_eventos", "ticket_medio_por_estado"):
            assert "hub_" not in plan(reports.run_report(name, view))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_of_two_frames_are_told_apart(spark):
    """Nulls in other places, copies and structs count; the order of rows does not."""
    schema = "a string, b string, seq struct<at: timestamp, tie: string>"
    one = [("x", None, (at(5, 1), "1")), (None, "x", None), ("y", "y", (None, None)), ("y", "y", (None, None)), ("z", "", (None, ""))]
    frame = spark.createDataFrame(one, schema)
    assert registry.sides(frame, spark.createDataFrame(one[::-1], schema)) == (5, 0)
    other = [("x", None, (at(5, 1), "1")), ("x", None, None), ("y", "y", (None, None)), ("z", None, (None, ""))]
    assert registry.sides(frame, spark.createDataFrame(other, schema)) == (5, 5)
    assert registry.sides(frame.where("false"), frame.where("false")) == (0, 0)
