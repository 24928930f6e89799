from helpers import LOADED, dataset

from lakevault.operators.model import first_row, vault_rows
from lakevault.operators.specs import HUBS, LINK_ORDER_CUSTOMER, MODEL, TABLES
from lakevault.operators.store import table_schema


def customer(account, person, **more):
    return {"customer_id": account, "customer_unique_id": person, **more}


def test_the_model_has_all_tables():
    kinds = [table.kind for table in TABLES.values()]
    assert {k: kinds.count(k) for k in set(kinds)} == {"hub": 7, "link": 7, "satellite": 11, "reference": 2}


def test_batch_and_events_feed_the_same_hubs():
    assert {"hub_order", "hub_customer"} <= {t.name for t in MODEL["events"]}
    assert HUBS["order"] in MODEL["orders"] and HUBS["order"] in MODEL["events"]
    assert HUBS["customer"] in MODEL["customers"] and HUBS["customer"] in MODEL["events"]


def test_rows_without_a_key_are_left_out(spark):
    rows = dataset(spark, "customers", [customer("c1", "u1"), customer(None, "u2")])
    assert vault_rows(rows, HUBS["customer_account"]).count() == 1


def test_hub_columns_and_key_length(spark):
    rows = vault_rows(dataset(spark, "customers", [customer("c1", "u1")] * 2), HUBS["customer"])
    assert rows.columns == ["customer_hk", "customer_unique_id", "load_dts", "record_source"]
    assert {len(r["customer_hk"]) for r in rows.collect()} == {64}
    assert first_row(rows, ["customer_hk"]).count() == 1


def test_link_carries_the_keys_of_its_hubs(spark):
    rows = dataset(spark, "orders", [{"order_id": " o1 ", "customer_id": "C1", "order_status": "x"}])
    link = vault_rows(rows, LINK_ORDER_CUSTOMER).first()
    accounts = vault_rows(dataset(spark, "customers", [customer("c1 ", "u1")]), HUBS["customer_account"]).first()
    orders = vault_rows(rows, HUBS["order"]).first()
    assert link["order_hk"] == orders["order_hk"]
    assert link["customer_account_hk"] == accounts["customer_account_hk"]
    assert link["link_order_customer_hk"] not in (link["order_hk"], link["customer_account_hk"])


def test_changed_attributes_change_the_hashdiff_only(spark):
    rows = dataset(spark, "customers", [customer("c1", "u1", customer_state="SP"), customer("c1", "u1", customer_state="RJ")])
    found = vault_rows(rows, TABLES["sat_customer_profile"]).collect()
    assert len({r["customer_account_hk"] for r in found}) == 1
    assert len({r["hashdiff"] for r in found}) == 2


def test_two_accounts_of_one_person(spark, store):
    from lakevault.plans.pipeline import load_dataset

    done = load_dataset(store, "customers", dataset(spark, "customers", [customer("acc1", "u1"), customer("acc2", "u1")]))
    assert {w.table: w.appended_rows for w in done} == {
        "hub_customer": 1, "hub_customer_account": 2, "link_customer_account": 2, "sat_customer_profile": 2,
    }


def test_zip_centroid(spark):
    def point(number, zip_code, lat, lng, city="b", state="SP"):
        return {
            "geolocation_id": number, "geolocation_zip_code_prefix": zip_code, "geolocation_lat": lat,
            "geolocation_lng": lng, "geolocation_city": city, "geolocation_state": state,
        }

    points = [point(1, "01310", 1.0, 10.0), point(1, "01310", 1.0, 10.0), point(2, "01310", 3.0, 30.0, "a"), point(3, None, 9.0, 9.0), point(4, "2", None, None)]
    found = {r["geolocation_zip_code_prefix"]: r for r in vault_rows(dataset(spark, "geolocation", points), TABLES["ref_geolocation"]).collect()}
    assert set(found) == {"01310", "2"}
    assert (found["01310"]["geolocation_lat"], found["01310"]["geolocation_lng"]) == (2.0, 20.0)
    assert found["01310"]["geolocation_city"] == "a"
    assert found["2"]["geolocation_lat"] is None


def test_first_row_is_the_smallest_by_all_columns(spark):
    rows = spark.createDataFrame([("k1", "b"), ("k1", "a"), ("k2", "c")], "chave string, atributo string")
    assert {tuple(r) for r in first_row(rows, ["chave"]).collect()} == {("k1", "a"), ("k2", "c")}


def test_first_row_drops_copies_before_the_shuffle(spark):
    from helpers import plan

    rows = spark.range(1000).selectExpr("id % 3 as k", "id as v")
    text = plan(first_row(rows, ["k"]))
    assert text.index("Final") < text.index("Exchange hashpartitioning") < text.index("Partial")


def test_one_load_time_per_batch(spark):
    rows = dataset(spark, "customers", [customer(str(i), "u") for i in range(20)])
    assert rows.select("load_dts").distinct().count() == 1
    assert vault_rows(rows, HUBS["customer"]).first()["load_dts"] == LOADED.replace(tzinfo=None)


def test_schema_of_every_table_is_known_before_any_load(spark):
    assert all(table_schema(spark, table).fieldNames()[-2:] == ["load_dts", "record_source"] for table in TABLES.values())
