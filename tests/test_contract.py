import json

import pytest
from pyspark.sql import functions as F
from test_raw import event

from lakevault.operators.contract import (
    MAX_ATTEMPTS, accepted, checked, checked_requests, parsed, quarantined, redrive,
)
from lakevault.sources.schemas import EVENT_SCHEMA


def messages(spark, *bodies):
    return spark.createDataFrame([(f"m{i}", b) for i, b in enumerate(bodies)], "message_id string, body string")


def changed(part, **values):
    base = event(1)
    return json.dumps({**base, part: {**base[part], **values}})


@pytest.mark.parametrize(
    ("body", "rule"),
    [
        (changed("customer", customer_state="SAO"), "customer.customer_state:length"),
        (changed("customer", customer_name=None), "customer.customer_name:required"),
        (changed("order", items_count=0), "order.items_count:minimum"),
        (changed("order", price=-0.01), "order.price:minimum"),
        (changed("order", freight_value=-1), "order.freight_value:minimum"),
        (changed("payment", payment_installments=0), "payment.payment_installments:minimum"),
        (json.dumps({**event(1), "event_id": None}), "event_id:required"),
        ("nao-e-json{", "malformed"),
        (json.dumps(event(1))[:-2], "malformed"),
    ],
)
def test_each_rule(spark, body, rule):
    assert parsed(messages(spark, body)).first()["violations"] == [rule]


def test_a_good_event_and_values_at_the_limits(spark):
    bodies = [json.dumps(event(1)), changed("order", price=0, freight_value=0, items_count=1)]
    assert accepted(parsed(messages(spark, *bodies))).count() == 2


def test_a_missing_part_breaks_all_its_fields(spark):
    body = json.dumps({**event(1), "payment": None})
    found = parsed(messages(spark, body)).first()["violations"]
    assert found == ["payment.payment_type:required", "payment.payment_installments:required"]


def test_one_bad_message_leaves_the_others_alone(spark):
    judged = parsed(messages(spark, json.dumps(event(1)), "nao-e-json{", json.dumps(event(2))))
    assert sorted(r["message_id"] for r in accepted(judged).collect()) == ["m0", "m2"]
    bad = quarantined(judged).collect()
    assert [(r["message_id"], r["body"], r["attempt"]) for r in bad] == [("m1", "nao-e-json{", 1)]


def test_a_body_is_parsed_once(spark):
    from helpers import plan

    text = plan(accepted(parsed(messages(spark, "{}"))))
    assert text.count("from_json") == 1


def events(spark, *rows):
    lines = [json.dumps({**e, "request": r}) for e, r in rows]
    frame = spark.createDataFrame([(line,) for line in lines], "value string")
    from pyspark.sql import functions as F

    shape = type(EVENT_SCHEMA)(list(EVENT_SCHEMA.fields)).add("request", "string")
    return frame.select(F.from_json("value", shape).alias("e")).select("e.*")


def test_one_bad_event_rejects_its_request(spark):
    bad = {**event(2), "event_type": None}
    judged = checked_requests(events(spark, (event(1), "a"), (bad, "a"), (event(3), "b")), "request")
    assert {(r["event_id"], r["rejected"]) for r in judged.collect()} == {("e1", True), ("e2", True), ("e3", False)}
    assert checked(events(spark, (event(1), "a"))).first()["violations"] == []


def test_a_request_has_a_largest_size(spark):
    rows = [(event(i), "full") for i in range(500)] + [(event(i), "over") for i in range(501)]
    judged = checked_requests(events(spark, *rows), "request")
    assert {(r["request"], r["rejected"]) for r in judged.select("request", "rejected").distinct().collect()} == {
        ("full", False), ("over", True),
    }


def test_redrive_gives_up_after_the_last_attempt(spark):
    waiting = quarantined(parsed(messages(spark, "nao-e-json{")))
    for _ in range(MAX_ATTEMPTS - 1):
        _, waiting, spent = redrive(waiting)
        assert spent.isEmpty()
    good, again, spent = redrive(waiting)
    assert (good.count(), again.count(), spent.count()) == (0, 0, 1)


def test_a_repaired_message_passes(spark):
    row = ("m1", json.dumps(event(1)), ["malformed"], 1)
    waiting = spark.createDataFrame([row], "message_id string, body string, reasons array<string>, attempt int")
    good, again, _ = redrive(waiting)
    assert good.first()["event_id"] == "e1" and again.isEmpty()


def test_events_without_request_id_are_kept_and_amounts_are_bounded(spark):
    events = spark.createDataFrame(
        [("r1", 5.0), (None, 5.0), (None, 1e20), ("r2", float("nan"))], "request string, price double"
    )
    order = F.struct(F.lit("o").alias("order_id"), F.lit("c").alias("product_category_name"), F.lit("p").alias("product_name"),
                     F.lit(1).alias("items_count"), F.col("price"), F.lit(1.0).alias("freight_value"))
    customer = F.struct(*[F.lit("SP").alias(name) for name in ("customer_unique_id", "customer_name", "customer_city", "customer_state", "customer_zip_code_prefix")])
    payment = F.struct(F.lit("boleto").alias("payment_type"), F.lit(1).alias("payment_installments"))
    full = events.select("request", F.lit("e").alias("event_id"), F.lit("t").alias("event_type"), F.current_timestamp().alias("event_timestamp"),
                         customer.alias("customer"), order.alias("order"), payment.alias("payment"))
    rows = checked_requests(full, "request").collect()
    assert sorted((r["request"] or "", r["rejected"], r["violations"]) for r in rows) == [
        ("", True, []), ("", True, ["order.price:maximum"]), ("r1", False, []), ("r2", True, ["order.price:maximum"]),
    ]
