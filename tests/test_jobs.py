"""The command-line jobs, from landed files to a printed report."""
import datetime as dt
import json
from pathlib import Path

import pytest
from helpers import LOADED
from test_raw import event, put

from lakevault.__main__ import main
from lakevault.sources.raw import read_batches
from lakevault.sources.schemas import SOURCES
from lakevault.streaming import jobs


def test_from_files_to_report(spark, folder, capsys):
    put(f"{folder}/raw", "products", "a.json", '[{"product_id":"p1","product_category_name":"livros"}]')
    put(f"{folder}/raw", "order_items", "a.json",
        '[{"order_id":"o1","order_item_id":1,"product_id":"P1","seller_id":"s1","price":2.5,"freight_value":1.0}]')
    put(f"{folder}/raw", "events", "m1.json", json.dumps(event(1)))
    target = ["--vault", f"{folder}/vault", "--database", "jobs_" + folder[-10:]]
    for _ in range(2):
        main(["load-batch", "--raw", f"{folder}/raw", *target, "--datasets", "products, order_items,sellers"])
    main(["load-events", "--raw", f"{folder}/raw", *target, "--checkpoint", f"{folder}/checkpoint"])
    capsys.readouterr()
    main(["report", *target, "receita_por_categoria"])
    assert "|livros   |1      |1    |2.5    |1.0  |2.5             |" in capsys.readouterr().out
    main(["report", *target, "funil_de_eventos"])
    assert "|order_created|1      |1.0              |" in capsys.readouterr().out


def test_reports_are_listed(capsys):
    main(["report", "--vault", "x"])
    assert "ticket_medio_por_estado" in capsys.readouterr().out


def test_an_unknown_dataset_is_refused(folder):
    with pytest.raises(ValueError, match="unknown datasets"):
        main(["load-batch", "--raw", folder, "--vault", f"{folder}/v", "--database", "x_" + folder[-10:], "--datasets", "nope"])


def test_extract_by_cursor_and_by_difference(spark, folder, capsys):
    table = f"{folder}/tables/sellers"
    put_rows = lambda *rows: spark.createDataFrame(list(rows), SOURCES["sellers"].schema).write.mode("overwrite").parquet(table)
    common = ["--tables", f"{folder}/tables", "--raw", f"{folder}/raw", "--marks", f"{folder}/marks", "--datasets", "sellers"]
    put_rows(("s1", "1", "c", "SP"), ("s2", "2", "c", "SP"))
    main(["bootstrap", *common, "--day", "2026-07-10"])
    put_rows(("s1", "1", "C", "SP"), ("s2", "2", "c", "SP"), ("s0", "3", None, ""))
    main(["extract", *common, "--day", "2026-07-11"])
    main(["extract", *common, "--day", "2026-07-12", "--mode", "diff"])
    main(["extract", *common, "--day", "2026-07-13", "--mode", "diff"])
    rows = read_batches(spark, f"{folder}/raw", "sellers", LOADED).collect()
    assert sorted((r["raw_day"], r["seller_id"], r["seller_city"]) for r in rows) == [
        ("10", "s1", "c"), ("10", "s2", "c"), ("12", "s0", None), ("12", "s1", "C"),
    ]
    capsys.readouterr()
    main(["check", "--tables", f"{folder}/tables", "--datasets", "sellers"])
    assert "sellers: 0 keys occur more than once" in capsys.readouterr().out


def test_landing_redrive_and_hours(spark, folder, capsys):
    inbox = Path(folder.removeprefix("file:")) / "inbox"
    inbox.mkdir(parents=True)
    late = event(2)
    late["order"]["price"] = -1.0
    bodies = [("m1", json.dumps(event(1))), ("m2", json.dumps(late)), ("m3", "nao-e-json{")]
    (inbox / "a.json").write_text("".join(json.dumps({"message_id": key, "body": body}) + "\n" for key, body in bodies))
    places = ["--raw", f"{folder}/raw", "--quarantine", f"{folder}/bad"]
    main(["land-events", "--inbox", str(inbox), *places, "--checkpoint", f"{folder}/check", "--day", "2026-07-10"])
    for attempt in (2, 3, 4):
        main(["redrive", *places])
        held = spark.read.parquet(f"{folder}/bad").collect()
        assert sorted((r["message_id"], r["attempt"]) for r in held) == [("m2", attempt), ("m3", attempt)]
    main(["redrive", *places])
    assert "'given_up': 2" in capsys.readouterr().out
    main(["hourly", "--raw", f"{folder}/raw", "--sink", f"{folder}/hours", "--checkpoint", f"{folder}/check-hours"])
    assert jobs.latest_hours(spark, f"{folder}/hours").collect()[0]["eventos"] == 1


def test_redrive_keeps_every_message_without_id(spark, folder):
    day = dt.date(2026, 7, 10)
    good = json.dumps(event(1))
    rows = [(None, "nao-e-json{", 1), (None, "nem isto", 1), ("m1", "a{", 1), ("m1", "b{", 1), ("m1", "b{", 1), (None, good, 1), (None, json.dumps(event(2)), 1), ("m2", "c{", 4)]
    held = spark.createDataFrame([(key, body, ["malformed"], attempt) for key, body, attempt in rows], "message_id string, body string, reasons array<string>, attempt int")
    held.write.parquet(f"{folder}/bad/run=a/batch=0")
    counts = jobs.redrive_job(spark, f"{folder}/raw", f"{folder}/bad", day)
    assert counts["landed"] == 2 and counts["waiting"] + counts["given_up"] == 5
    left = spark.read.parquet(f"{folder}/bad").select("message_id", "body").collect()
    assert sorted(row["body"] for row in left) == ["a{", "b{", "c{", "nao-e-json{", "nem isto"]
    assert spark.read.text(f"{folder}/raw/events").count() == 2
