from pathlib import Path

import pytest
from helpers import dataset

from lakevault.plans.pipeline import load_dataset, raise_if_failed, run_all


def sellers(spark):
    return dataset(spark, "sellers", [{"seller_id": "s1"}, {"seller_id": "s2"}])


def test_a_failing_dataset_does_not_stop_the_others(spark, store):
    def broken():
        raise OSError("no route to source")

    sources = {
        "products": broken,
        "sellers": lambda: sellers(spark),
        "no_such_dataset": lambda: sellers(spark),
    }
    done = run_all(store, sources)
    rows = {(r["dataset"], r["table_name"]): r for r in done.collect()}
    assert rows["sellers", "hub_seller"]["appended_rows"] == 2
    assert "no route to source" in rows["products", None]["error"]
    with pytest.raises(RuntimeError, match="no_such_dataset, products"):
        raise_if_failed(done)


def test_a_good_run_raises_nothing(spark, store):
    raise_if_failed(run_all(store, {"sellers": lambda: sellers(spark)}))


def test_nothing_staged_is_left_behind(spark, store):
    load_dataset(store, "sellers", sellers(spark))
    assert spark.catalog.listTables(f"{store.database}_stage") == []
    staging = spark.sql(f"DESCRIBE DATABASE {store.database}_stage").where("info_name = 'Location'").first()[1]
    assert list(Path(staging.removeprefix("file:")).glob("*")) == []


def test_an_empty_source_still_makes_its_tables(spark, store):
    done = load_dataset(store, "sellers", sellers(spark).limit(0))
    assert [(w.table, w.staged_rows) for w in done] == [("hub_seller", 0), ("sat_seller_profile", 0)]
    assert store.read("hub_seller").isEmpty()
