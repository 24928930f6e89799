import datetime as dt
import json
from pathlib import Path

from pyspark.sql import functions as F
from test_raw import event

from lakevault.sources.raw import flat_events, read_events
from lakevault.sources.schemas import EVENTS
from lakevault.streaming import jobs

TODAY = dt.date(2026, 7, 10)
DAY = "year=2026/month=07/day=10"
LOADED = dt.datetime(2026, 7, 10, tzinfo=dt.timezone.utc)


def put(folder, name, *lines):
    target = Path(folder)
    target.mkdir(parents=True, exist_ok=True)
    (target / name).write_text("\n".join(line if isinstance(line, str) else json.dumps(line) for line in lines))


def at(number, hour, price=2.5, state="SP", order="o1"):
    base = event(number, event_timestamp=f"2026-07-10T{hour:02d}:30:00Z")
    base["order"] = {**base["order"], "price": price, "order_id": order}
    base["customer"] = {**base["customer"], "customer_state": state}
    return base


def message(number, body, minute=0):
    return {"message_id": f"m{number}", "body": body if isinstance(body, str) else json.dumps(body),
            "sent_at": f"2026-07-10T10:{minute:02d}:00Z"}


def test_events_reach_the_vault_and_a_second_run_finds_nothing(spark, store, folder):
    raw = f"{folder}/raw/{EVENTS}"
    put(f"{raw}/{DAY}", "a.json", at(1, 10))
    put(f"{raw}/{DAY}", "b.json", at(2, 11, price=3.0), "nao-e-json{")
    first = jobs.vault_job(store, raw, f"{folder}/checkpoint", files_per_batch=1)
    assert len([p for p in first.recentProgress if p["numInputRows"]]) == 2
    sizes = {n: store.read(n).count() for n in ("hub_event", "hub_order", "hub_customer", "link_event_order", "sat_hot_order_snapshot")}
    assert sizes == {"hub_event": 2, "hub_order": 1, "hub_customer": 1, "link_event_order": 2, "sat_hot_order_snapshot": 2}
    again = jobs.vault_job(store, raw, f"{folder}/checkpoint")
    assert not any(p["numInputRows"] for p in again.recentProgress)
    put(f"{raw}/{DAY}", "c.json", at(3, 9, price=1.0))
    jobs.vault_job(store, raw, f"{folder}/checkpoint")
    assert store.read("sat_hot_order_snapshot").count() == 3
    assert store.current("sat_hot_order_snapshot").first()["price"] == 3.0  # the late event is not the newest


def test_a_lost_checkpoint_adds_nothing(spark, store, folder):
    raw = f"{folder}/raw/{EVENTS}"
    put(f"{raw}/{DAY}", "a.json", at(1, 10), at(2, 11, price=3.0), at(3, 12))
    jobs.vault_job(store, raw, f"{folder}/checkpoint-1")
    before = {n: store.read(n).count() for n in ("hub_event", "link_event_customer", "sat_hot_order_snapshot", "sat_event_context")}
    jobs.vault_job(store, raw, f"{folder}/checkpoint-2")
    assert before == {n: store.read(n).count() for n in before}


def test_a_redelivered_event_in_another_file_is_no_new_version(spark, store, folder):
    raw = f"{folder}/raw/{EVENTS}"
    put(f"{raw}/{DAY}", "a.json", at(1, 10))
    jobs.vault_job(store, raw, f"{folder}/checkpoint")
    put(f"{raw}/year=2026/month=07/day=11", "b.json", at(1, 10))
    jobs.vault_job(store, raw, f"{folder}/checkpoint")
    assert store.read("sat_event_context").count() == 1


def test_messages_are_landed_once_across_days(spark, folder):
    def run(day):
        jobs.landing_job(spark, f"{folder}/in", f"{folder}/raw", f"{folder}/bad", f"{folder}/check", day)
        return read_events(spark, f"{folder}/raw", LOADED)

    put(f"{folder}/in", "a.json", message(1, at(1, 10)), message(1, at(1, 10)), message(2, "nao-e-json{"))
    assert [r["event_id"] for r in run(TODAY).collect()] == ["e1"]
    put(f"{folder}/in", "b.json", message(1, at(1, 10)), message(3, json.dumps(at(3, 11), indent=1)))
    rows = flat_events(run(TODAY + dt.timedelta(days=1))).collect()
    assert {(r["event_id"], r["raw_partition_date"].day) for r in rows} == {("e1", 10), ("e3", 11)}
    bad = spark.read.parquet(f"{folder}/bad").collect()
    assert [(r["message_id"], r["reasons"], r["attempt"]) for r in bad] == [("m2", ["malformed"], 1)]


def test_a_new_checkpoint_deletes_and_repeats_nothing(spark, folder):
    def run(inbox, check, day):
        jobs.landing_job(spark, f"{folder}/{inbox}", f"{folder}/raw", f"{folder}/bad", f"{folder}/{check}", day)
        rows = flat_events(read_events(spark, f"{folder}/raw", LOADED)).collect()
        return sorted((r["event_id"], r["raw_partition_date"].day) for r in rows)

    put(f"{folder}/in1", "a.json", message(1, at(1, 10)), message(2, at(2, 10)), message(9, "nao-e-json{"))
    assert run("in1", "check-1", TODAY) == [("e1", 10), ("e2", 10)]
    put(f"{folder}/in2", "b.json", message(2, at(2, 10)), message(3, at(3, 11)))
    assert run("in2", "check-2", TODAY + dt.timedelta(days=1)) == [("e1", 10), ("e2", 10), ("e3", 11)]
    assert run("in2", "check-3", TODAY + dt.timedelta(days=2)) == [("e1", 10), ("e2", 10), ("e3", 11)]
    assert [r["message_id"] for r in spark.read.parquet(f"{folder}/bad").collect()] == ["m9"]


def test_copies_within_the_delay_are_dropped_in_the_stream(spark, folder):
    put(f"{folder}/in", "a.json", message(1, "{}"), message(2, "{}"))
    put(f"{folder}/in", "b.json", message(1, "{}", 5), message(3, "{}", 5))
    unique = jobs.distinct_messages(jobs.message_stream(spark, f"{folder}/in", 1), "1 hour")
    jobs.drain(unique.writeStream.format("parquet").option("path", f"{folder}/out"), f"{folder}/check")
    assert sorted(r["message_id"] for r in spark.read.parquet(f"{folder}/out").collect()) == ["m1", "m2", "m3"]


def test_hourly_figures_follow_late_events(spark, folder):
    raw = f"{folder}/raw/{EVENTS}"
    put(f"{raw}/{DAY}", "a.json", at(1, 10), at(2, 10, order="o2"), at(3, 11))
    jobs.hourly_job(spark, raw, f"{folder}/hours", f"{folder}/check")
    put(f"{raw}/{DAY}", "b.json", at(4, 10, price=10.0, order="o2"))
    jobs.hourly_job(spark, raw, f"{folder}/hours", f"{folder}/check")
    rows = jobs.latest_hours(spark, f"{folder}/hours").orderBy("hora").collect()
    figures = [(r["hora"].hour, r["eventos"], r["pedidos_aproximados"], r["clientes_aproximados"], r["valor_total"]) for r in rows]
    assert figures == [(10, 3, 2, 1, 18.0), (11, 1, 1, 1, 3.5)]


def test_a_new_checkpoint_counts_nothing_twice(spark, folder):
    raw = f"{folder}/raw/{EVENTS}"
    put(f"{raw}/{DAY}", "a.json", *(at(i, 10, order=f"o{i}") for i in range(5)))
    jobs.hourly_job(spark, raw, f"{folder}/hours", f"{folder}/check")
    put(f"{raw}/{DAY}", "b.json", *(at(i, 10, order=f"o{i % 7}") for i in range(5, 9)))
    for check in ("new", "new", "newer"):
        jobs.hourly_job(spark, raw, f"{folder}/hours", f"{folder}/{check}")
    row = jobs.latest_hours(spark, f"{folder}/hours").first()
    assert (row["eventos"], row["pedidos_aproximados"]) == (9, 7)


def test_the_stream_and_the_batch_agree(spark, folder):
    raw = f"{folder}/raw"
    put(f"{raw}/{EVENTS}/{DAY}", "a.json", *(at(i, i % 24, price=i / 4, order=f"o{i % 5}") for i in range(100)))
    jobs.hourly_job(spark, f"{raw}/{EVENTS}", f"{folder}/hours", f"{folder}/check")
    batch = (
        flat_events(read_events(spark, raw, LOADED))
        .groupBy(F.date_trunc("hour", "event_timestamp").alias("hora"))
        .agg(F.count(F.lit(1)).alias("eventos"), F.sum(F.col("price") + F.col("freight_value")).alias("valor_total"))
    )
    stream = jobs.latest_hours(spark, f"{folder}/hours").select("hora", "eventos", "valor_total")
    assert stream.exceptAll(batch).isEmpty() and stream.count() == batch.count() == 24
