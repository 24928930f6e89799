"""Named queries over a folder of test tables, one per operator or view.

Views and reports run over a vault that is loaded once per session and folder and then shared.
Queries about the effect of writing (second runs, merges, streams) build stores of their own.
"""
from __future__ import annotations

import dataclasses
import datetime as dt
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakevault.functions.hashing import digest, fingerprint, packed, unpacked
from lakevault.operators import quality
from lakevault.operators.contract import checked, checked_requests, parsed, quarantined, redrive
from lakevault.operators.merge import Written
from lakevault.operators.model import first_row
from lakevault.operators.specs import MODEL
from lakevault.operators.store import VaultStore
from lakevault.plans import gold, reports
from lakevault.plans.lasting import lasting_views
from lakevault.plans.pipeline import load_new_files, load_table, run_all
from lakevault.session import configure, release, run_folder
from lakevault.sources import benchtables
from lakevault.sources.extract import Marks, bootstrap, changed_rows, extract, page_after
from lakevault.sources.files import compressed
from lakevault.sources.landing import TIMESTAMP_FORMAT, day_folder, land_batch, once
from lakevault.sources.raw import flat_events, read_batches, read_events, read_unreadable
from lakevault.sources.schemas import RECORD_SOURCE, SOURCES
from lakevault.sources.tables import load_csv_tables, load_summary
from lakevault.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]

# Landing date of everything the queries land; any fixed day will do.
LANDED_ON = dt.date(2024, 2, 1)
LOADED_AT = dt.datetime(2024, 2, 1, 12, 0, 0, tzinfo=dt.timezone.utc)

_shared: dict[tuple[str, str], tuple[VaultStore, set[str]]] = {}


def new_store(spark: SparkSession, label: str, buckets: int | None = None) -> VaultStore:
    store = VaultStore(spark, run_folder(spark, label), f"vault_{uuid.uuid4().hex[:10]}", buckets)
    store.ensure_database()
    return store


def flat(spark: SparkSession, folder: str) -> DataFrame:
    """The test events as flat rows, as if landed in one file."""
    landed = benchtables.events(spark, folder).withColumns(
        {"raw_file": F.lit("events.json"), "raw_partition_date": F.lit(LANDED_ON)}
    )
    return flat_events(landed)


def load(store: VaultStore, folder: str, dataset: str, rows: DataFrame | None = None) -> list[Written]:
    """Load one dataset of the folder, or the given rows of it."""
    spark = store.spark
    if dataset == "events":
        given = flat(spark, folder) if rows is None else rows
        return load_table(store, dataset, given, f"{RECORD_SOURCE['events']}.events", LOADED_AT)
    given = benchtables.versioned(spark, folder, dataset) if rows is None else rows
    source = f"{RECORD_SOURCE['batch']}.{dataset}"
    return load_table(store, dataset, given, source, LOADED_AT)


def vault(spark: SparkSession, folder: str, *datasets: str) -> VaultStore:
    """The shared vault of a folder with at least the named datasets loaded.

    Events come after the two batch datasets they share hubs with, whichever query asks first.
    """
    configure(spark)
    if "events" in datasets:
        datasets = ("customers", "orders", *datasets)
    shared = (spark.sparkContext.applicationId, folder)
    if shared not in _shared:
        _shared[shared] = (new_store(spark, "vault"), set())
    store, loaded = _shared[shared]
    for dataset in datasets:
        if dataset not in loaded:
            load(store, folder, dataset)
            loaded.add(dataset)
    return store


# What each table and view needs.
HUB_SOURCES = {
    "hub_customer": ("events",),
    "hub_customer_account": ("customers",),
    "hub_seller": ("sellers",),
    "hub_product": ("products",),
    "hub_order": ("events",),
    "hub_review": ("order_reviews",),
    "hub_event": ("events",),
}
VIEW_SOURCES = {
    "dim_customer": ("customers", "geolocation"),
    "dim_product": ("products", "product_category_name_translation"),
    "dim_seller": ("sellers", "geolocation"),
    "fact_order": ("events",),
    "fact_order_item": ("order_items",),
    "fact_order_payment": ("order_payments",),
    "fact_order_review": ("order_reviews",),
    "fact_order_event": ("events",),
    "agg_order_event_hourly": ("events",),
}
REPORT_VIEWS = {
    "receita_por_categoria": ("fact_order_item", "dim_product"),
    "ticket_medio_por_estado": ("fact_order_item", "dim_customer", "fact_order"),
    "prazo_de_entrega_por_estado": ("dim_customer", "fact_order"),
    "funil_de_eventos": ("fact_order_event",),
}


def table_query(name: str, datasets: tuple[str, ...]) -> Query:
    """All rows of a vault table without the load time; ``seq`` as two columns."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        rows = vault(spark, folder, *datasets).read(name).drop("load_dts", "raw_file")
        if "seq" in rows.columns:
            rows = rows.select(*[c for c in rows.columns if c != "seq"], "seq.*")
            rows = rows.withColumnsRenamed({"at": "seq_at", "tie": "seq_tie"})
        return rows

    return query


def view_query(name: str) -> Query:
    return lambda spark, folder: gold.VIEWS[name](vault(spark, folder, *VIEW_SOURCES[name]), None)


def report_query(name: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        needed = dict.fromkeys(d for view in REPORT_VIEWS[name] for d in VIEW_SOURCES[view])
        store = vault(spark, folder, *needed)
        return reports.run_report(name, gold.reader(store))

    return query


def views_as_tables(spark: SparkSession, folder: str) -> DataFrame:
    """The views as SQL names, used from SQL."""
    store = vault(
        spark, folder, "customers", "sellers", "products", "product_category_name_translation", "orders",
        "order_items", "order_payments", "order_reviews", "geolocation", "events",
    )
    names = gold.create_views(store, "gold_")
    found = []
    for name in names:  # one after another, so that the disk holds the shuffles of one view at a time
        found.append((name.removeprefix("gold_"), spark.sql(f"select count(*) as row_count from {name}").first()["row_count"]))
        release(spark)
    return outcome(spark, found, "view_name string, row_count bigint")


def sides(one: DataFrame, other: DataFrame) -> tuple[int, int]:
    """Of two frames of the same columns the rows of the first, and the different rows that they do not hold equally often."""
    both = [rows.select(*fingerprint(rows), F.lit(side).alias("side")) for rows, side in ((one, 1), (other, -1))]
    rows = both[0].unionByName(both[1]).groupBy("_row_1", "_row_2").agg(F.sum("side").alias("sides"), F.count_if(F.col("side") > 0).alias("first"))
    counted = rows.agg(F.coalesce(F.sum("first"), F.lit(0)).alias("first"), F.count_if(F.col("sides") != 0).alias("differing")).first()
    return counted["first"], counted["differing"]


def lasting_views_query(spark: SparkSession, folder: str) -> DataFrame:
    """The views as another session of the catalog sees them: rows of each, and rows in which it differs from the DataFrame view."""
    store = vault(
        spark, folder, "customers", "sellers", "products", "product_category_name_translation", "orders",
        "order_items", "order_payments", "order_reviews", "geolocation", "events",
    )
    other = configure(spark.newSession())
    found = []
    for name, qualified in zip(gold.VIEWS, lasting_views(store, "lasting_")):
        view = gold.VIEWS[name](store.within(other), None)
        found.append((name, *sides(other.table(qualified).select(*view.columns), view)))
        del view
        release(spark)  # the disk holds the shuffles of one view at a time
    return outcome(spark, found, "view_name string, row_count bigint, differing_rows bigint")


def hash_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of clean and of untidy keys, of composite keys and of nulls."""
    configure(spark)
    rows = benchtables.dataset(spark, folder, "customers").withColumns(
        {
            "untidy": F.concat(F.lit("  "), F.lower("customer_id"), F.lit(" ")),
            "nothing": F.lit(None).cast("string"),
        }
    )
    return rows.select(
        "customer_id",
        digest(["customer_id"]).alias("clean_hk"),
        digest(["untidy"]).alias("untidy_hk"),
        digest(["customer_id", "customer_unique_id"]).alias("pair_hk"),
        digest(["customer_id", "nothing", "customer_state"]).alias("with_null_hk"),
    )


def outcome(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def second_run(spark: SparkSession, folder: str) -> DataFrame:
    """Rows appended by a first and by a repeated load of the same payments and events."""
    configure(spark)
    store = new_store(spark, "second-run")
    rows = []
    for dataset in ("order_payments", "events"):
        first, again = load(store, folder, dataset), load(store, folder, dataset)
        rows += [(a.table, a.appended_rows, b.appended_rows) for a, b in zip(first, again)]
    return outcome(spark, rows, "table_name string, first_run bigint, second_run bigint")


def insert_only_second_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Items shipped before 2000 first, then all items: the second batch adds what is missing."""
    configure(spark)
    store = new_store(spark, "second-batch")
    everything = benchtables.versioned(spark, folder, "order_items")
    early = everything.where("shipping_limit_date < timestamp'2000-01-01'")
    rows = []
    for number, batch in enumerate((early, everything), start=1):
        rows += [(number, w.table, w.staged_rows, w.appended_rows) for w in load(store, folder, "order_items", batch)]
    return outcome(spark, rows, "batch int, table_name string, staged_rows bigint, appended_rows bigint")


def upsert_reference(spark: SparkSession, folder: str) -> DataFrame:
    """Zip centroids from customers first, then from sellers: known zips are replaced, new ones added."""
    configure(spark)
    store = new_store(spark, "upsert")
    points = benchtables.versioned(spark, folder, "geolocation")
    of_sellers = F.col("geolocation_city") == "-"
    for day, batch in enumerate((points.where(~of_sellers), points.where(of_sellers)), start=1):
        at = LOADED_AT + dt.timedelta(days=day)
        load_table(store, "geolocation", batch, f"{RECORD_SOURCE['batch']}.geolocation", at)
    return store.read("ref_geolocation").drop("load_dts")


def dedup_deterministic(spark: SparkSession, folder: str) -> DataFrame:
    configure(spark)
    payments = benchtables.dataset(spark, folder, "order_payments")
    return first_row(payments, ["order_id", "payment_sequential"])


def current_payment(spark: SparkSession, folder: str) -> DataFrame:
    rows = vault(spark, folder, "order_payments").current("sat_order_payment")
    return rows.select(
        "link_order_payment_hk", "payment_type", "payment_installments", "payment_value", "hashdiff",
        F.col("seq.at").alias("seq_at"),
    )


def as_bytes(rows: DataFrame, *digests: str) -> DataFrame:
    """Digests of a vault table alone, packed to be joined by: half of what their text would shuffle."""
    return rows.select(*[packed(name).alias(name) for name in digests])


def as_text(rows: DataFrame, *digests: str) -> DataFrame:
    """Rows with packed digests as text again."""
    return rows.withColumns({name: unpacked(name) for name in digests})


def late_events(spark: SparkSession, folder: str) -> DataFrame:
    """Half of the events arrive after the other half, then everything is replayed: the full history."""
    configure(spark)
    store = new_store(spark, "late")
    rows = flat(spark, folder)
    on_time = F.col("event_type").isin("order_created", "order_invoiced", "order_delivered")
    for batch in (rows.where(on_time), rows.where(~on_time), rows):
        load(store, folder, "events", batch)
    history = store.read("sat_hot_order_snapshot").select("order_hk", "hashdiff", F.col("seq.at").alias("seq_at"))
    return history


def late_events_current(spark: SparkSession, folder: str) -> DataFrame:
    """The same late half without a replay: the current snapshots are right all the same."""
    configure(spark)
    store = new_store(spark, "late-current")
    rows = flat(spark, folder)
    on_time = F.col("event_type").isin("order_created", "order_invoiced", "order_delivered")
    for batch in (rows.where(on_time), rows.where(~on_time)):
        load(store, folder, "events", batch)
    snapshots = store.compact_current("sat_hot_order_snapshot").drop("load_dts", "record_source", "seq")
    profiles = store.compact_current("sat_hot_customer_profile").select("customer_hk", F.col("hashdiff").alias("profile_hashdiff"))
    orders = as_bytes(store.read("link_event_order"), "event_hk", "order_hk")
    owners = as_bytes(store.read("link_event_customer"), "event_hk", "customer_hk").join(orders, "event_hk")
    found = snapshots.join(owners.select("order_hk", "customer_hk").distinct(), "order_hk").join(profiles, "customer_hk")
    return as_text(found, "order_hk", "customer_hk", "hashdiff", "profile_hashdiff")


def raw_lines_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Items landed as JSON lines and read back."""
    configure(spark)
    root = run_folder(spark, "raw")
    land_batch(benchtables.dataset(spark, folder, "order_items"), root, "order_items", LANDED_ON)
    rows = read_batches(spark, root, "order_items", LOADED_AT, since=LANDED_ON)
    return rows.select(
        *SOURCES["order_items"].columns, "raw_year", "raw_month", "raw_day", "raw_partition_date", "record_source"
    )


def raw_batch_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Orders landed as files of one JSON array each and read back."""
    configure(spark)
    root = run_folder(spark, "raw")
    land_batch(benchtables.dataset(spark, folder, "orders"), root, "orders", LANDED_ON, rows_per_array=5000)
    rows = read_batches(spark, root, "orders", LOADED_AT)
    return rows.select(*SOURCES["orders"].columns, "raw_partition_date", "record_source")


def event_files(spark: SparkSession, folder: str, root: str, files: int | None = 4) -> None:
    """The test events as compressed JSON files, so many at least; with None as many as their size asks for."""
    target = f"{root}/events/year={LANDED_ON:%Y}/month={LANDED_ON:%m}/day={LANDED_ON:%d}"
    events = benchtables.events(spark, folder)
    events = events.repartition("event_id") if files is None else events.repartition(files, "event_id")
    compressed(events.write).option("timestampFormat", TIMESTAMP_FORMAT).json(target)


def raw_event_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    configure(spark)
    root = run_folder(spark, "raw")
    event_files(spark, folder, root, files=None)
    return flat_events(read_events(spark, root, LOADED_AT)).drop("raw_file", "load_dts", "seq")


def csv_load(spark: SparkSession, folder: str) -> DataFrame:
    """All nine tables through CSV files into tables, counted; reviews hold texts of many lines."""
    configure(spark)
    root, database = run_folder(spark, "csv"), f"csv_{uuid.uuid4().hex[:10]}"
    for name in SOURCES:
        csv = benchtables.dataset(spark, folder, name).write.option("header", True).option("escape", '"')
        csv.option("timestampFormat", TIMESTAMP_FORMAT).option("ignoreLeadingWhiteSpace", False).option(
            "ignoreTrailingWhiteSpace", False
        ).csv(f"{root}/{name}")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/tables'")
    load_csv_tables(spark, root, database)
    loaded = {name: spark.table(f"{database}.{name}") for name in SOURCES}
    texts = loaded["order_reviews"].select(
        F.lit("letters in review messages").alias("table_name"),
        F.length("review_comment_message").alias("n"),
    ).groupBy("table_name").agg(F.sum("n").alias("row_count"))
    return load_summary(loaded).unionByName(texts)


def load_summary_query(spark: SparkSession, folder: str) -> DataFrame:
    configure(spark)
    return load_summary({name: benchtables.dataset(spark, folder, name) for name in SOURCES})


def extract_pk_page(spark: SparkSession, folder: str) -> DataFrame:
    configure(spark)
    customers = benchtables.dataset(spark, folder, "customers")
    return page_after(customers, SOURCES["customers"], ("A1200",), 500)


def extract_ts_page(spark: SparkSession, folder: str) -> DataFrame:
    configure(spark)
    orders = benchtables.dataset(spark, folder, "orders")
    return page_after(orders, SOURCES["orders"], (dt.datetime(1996, 6, 30), "O5000"), 500)


def extract_resume(spark: SparkSession, folder: str) -> DataFrame:
    """Two limited extracts, one for the rest and one that finds nothing."""
    configure(spark)
    root = run_folder(spark, "extract")
    marks = Marks(spark, f"{root}/marks")
    orders = benchtables.dataset(spark, folder, "orders")
    rows = []
    for run, limit in enumerate((700, 300, None, None), start=1):
        done = extract(spark, orders, "orders", f"{root}/raw", marks, LANDED_ON, limit)
        rows.append((run, done.rows, done.mark[0], done.mark[1]))
    return outcome(spark, rows, "run int, landed_rows bigint, mark_at timestamp, mark_id string")


def extract_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Products whose photo count changed since they were landed."""
    configure(spark)
    root = run_folder(spark, "changes")
    products = benchtables.dataset(spark, folder, "products")
    land_batch(products, root, "products", LANDED_ON)
    landed = read_batches(spark, root, "products", LOADED_AT)
    photos = F.col("product_photos_qty")
    today = products.withColumn("product_photos_qty", F.when(photos == 0, F.lit(1)).otherwise(photos))
    return changed_rows(today, landed, SOURCES["products"])


def bootstrap_if_empty(spark: SparkSession, folder: str) -> DataFrame:
    """First extract of every table; a repetition finds all of them landed."""
    configure(spark)
    root = run_folder(spark, "bootstrap")
    marks = Marks(spark, f"{root}/marks")
    tables = {name: benchtables.dataset(spark, folder, name) for name in SOURCES}
    first = bootstrap(spark, tables, f"{root}/raw", marks, LANDED_ON)
    again = bootstrap(spark, tables, f"{root}/raw", marks, LANDED_ON)
    rows = [(name, first.get(name, 0), again.get(name, 0)) for name in SOURCES]
    return outcome(spark, rows, "dataset string, first_rows bigint, second_rows bigint")


def bent_events(spark: SparkSession, folder: str) -> DataFrame:
    """Test events with values that break the contract: cheap ones get a negative price, and so on."""
    k = F.get_json_object("props", "$.k").cast("int")
    raw = spark.read.parquet(f"{folder}/events.parquet").select(F.col("event_id").cast("string").alias("event_id"), k.alias("k"))
    events = benchtables.events(spark, folder).join(raw, "event_id")
    price, city = F.col("order.price"), F.col("customer.customer_city")
    return events.withColumns(
        {
            "customer": F.col("customer")
            .withField("customer_state", F.concat(F.lit("S"), (F.col("k") % 12).cast("string")))
            .withField("customer_name", F.when(city != "city 1", F.col("customer.customer_name"))),
            "order": F.col("order").withField("price", price - 5).withField("items_count", F.col("k") % 4),
            "payment": F.col("payment").withField("payment_installments", F.col("k") % 10),
        }
    ).drop("k")


def contract_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Broken rules and how many events break them."""
    configure(spark)
    judged = checked(bent_events(spark, folder))
    return judged.select(F.explode("violations").alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("events"))


def contract_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Requests of one type and day each: all their events pass or none.

    Orders shipped form one request, larger than allowed; on the first of a month nobody named a request.
    """
    configure(spark)
    events = benchtables.events(spark, folder)
    cheap = F.col("order.price") < 0.05
    planted = events.withColumns(
        {
            "order": F.col("order").withField("price", F.when(cheap, -F.col("order.price")).otherwise(F.col("order.price"))),
            "request": F.when(F.dayofmonth("event_timestamp") == 1, None)
            .when(F.col("event_type") == "order_shipped", F.col("event_type"))
            .otherwise(F.concat_ws("/", "event_type", F.to_date("event_timestamp").cast("string"))),
        }
    )
    return checked_requests(planted, "request").groupBy("request").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if("rejected").alias("rejected_events"),
        F.count_if(F.size("violations") > 0).alias("own_violations"),
    )


def message_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Events as messages; those of one type were cut off on the way."""
    body = F.to_json(F.struct(*benchtables.events(spark, folder).columns), {"timestampFormat": TIMESTAMP_FORMAT})
    events = benchtables.events(spark, folder).withColumn("body", body)
    cut = F.expr("substring(body, 1, length(body) - 2)")
    return events.select(
        F.col("event_id").alias("message_id"),
        F.when(F.col("event_type") == "order_delivered", cut).otherwise(F.col("body")).alias("body"),
        F.col("event_timestamp").alias("sent_at"),
    )


def message_files(spark: SparkSession, folder: str, root: str) -> None:
    """Every message delivered twice, in different files."""
    rows = message_rows(spark, folder).repartition(3, "message_id")
    for _ in range(2):
        rows.write.mode("append").option("timestampFormat", TIMESTAMP_FORMAT).json(root)


def quarantine_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Malformed messages go to quarantine, the others pass; three retries later they are given up."""
    configure(spark)
    judged = parsed(message_rows(spark, folder))
    waiting = quarantined(judged)
    stages = [waiting.select(F.lit("quarantined").alias("stage"), "attempt")]
    for _ in range(3):
        _, waiting, _ = redrive(waiting)
    _, retried, spent = redrive(waiting)
    stages.append(spent.select(F.lit("given up").alias("stage"), "attempt"))
    stages.append(retried.select(F.lit("tried too often").alias("stage"), "attempt"))
    passed = judged.where(F.size("violations") == 0)
    stages.append(passed.select(F.lit("accepted").alias("stage"), F.lit(0).alias("attempt")))
    return reduce(DataFrame.unionByName, stages).groupBy("stage", "attempt").agg(F.count(F.lit(1)).alias("messages"))


def landing_idempotent(spark: SparkSession, folder: str) -> DataFrame:
    """Messages delivered twice are landed once, cut-off ones not at all; a second run adds nothing."""
    configure(spark)
    root = run_folder(spark, "landing")
    message_files(spark, folder, f"{root}/inbox")
    for _ in range(2):
        jobs.landing_job(
            spark, f"{root}/inbox", f"{root}/raw", f"{root}/quarantine", f"{root}/checkpoint", LANDED_ON, files_per_batch=2
        )
    rows = flat_events(read_events(spark, f"{root}/raw", LOADED_AT))
    return rows.select("event_id", "event_type", "event_timestamp", "order_id", "price", "raw_partition_date")


def landing_restart(spark: SparkSession, folder: str) -> DataFrame:
    """Two inboxes that overlap, each with a checkpoint and a day of its own; the second one is run twice."""
    configure(spark)
    root = run_folder(spark, "restart")
    rows, number = message_rows(spark, folder), F.col("message_id").cast("bigint") % 10
    for name, part in (("first", rows.where(number < 6)), ("second", rows.where(number >= 4))):
        part.write.option("timestampFormat", TIMESTAMP_FORMAT).json(f"{root}/{name}")
    for inbox, checkpoint, days in (("first", "1", 0), ("second", "2", 1), ("second", "3", 2)):
        jobs.landing_job(
            spark, f"{root}/{inbox}", f"{root}/raw", f"{root}/quarantine", f"{root}/checkpoint-{checkpoint}", LANDED_ON + dt.timedelta(days=days)
        )
    return flat_events(read_events(spark, f"{root}/raw", LOADED_AT)).select("event_id", "raw_partition_date")


def extract_then_load(spark: SparkSession, folder: str) -> DataFrame:
    """Every table landed, read back and loaded, all with the options nobody names."""
    configure(spark)
    root = run_folder(spark, "extract-load")
    store = new_store(spark, "extract-load")
    tables = {name: benchtables.dataset(spark, folder, name) for name in SOURCES}
    landed = bootstrap(spark, tables, f"{root}/raw", Marks(spark, f"{root}/marks"), LANDED_ON)
    sources = {name: (lambda name=name: read_batches(spark, f"{root}/raw", name, LOADED_AT)) for name in SOURCES}
    done = run_all(store, sources).groupBy("dataset").agg(F.max("staged_rows").alias("loaded_rows"))
    return outcome(spark, list(landed.items()), "dataset string, landed_rows bigint").join(done, "dataset")


def late_events_any_cut(spark: SparkSession, folder: str) -> DataFrame:
    """Events in three batches cut through all orders, the newest event first, without a replay: the full history."""
    configure(spark)
    store = new_store(spark, "any-cut")
    rows = flat(spark, folder)
    part = (F.dayofyear("event_timestamp") + F.col("event_id").cast("bigint")) % 3
    for number in (2, 0, 1):
        load(store, folder, "events", rows.where(part == number))
    return store.read("sat_hot_order_snapshot").select("order_hk", "hashdiff", F.col("seq.at").alias("seq_at"))


# For each dataset a column, and the other value that an older landing has in it.
ONCE = {
    "product_category_name_translation": ("product_category_name_english", "concat(product_category_name_english, ' then')"),
    "customers": ("customer_city", "concat(customer_city, ' then')"),
    "sellers": ("seller_city", "concat(seller_city, ' then')"),
    "geolocation": ("geolocation_city", "concat(geolocation_city, ' then')"),
    "products": ("product_weight_g", "product_weight_g + 1"),
    "orders": ("order_status", "'created'"),
    "order_items": ("freight_value", "freight_value + 1"),
    "order_payments": ("payment_value", "payment_value + 1"),
    "order_reviews": ("review_score", "review_score + 1"),
}


def load_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Three landings of every table, each loaded as it comes: two thirds of the rows, older values of half of all rows
    under an earlier date, and everything once more. The keys of each vault table, and in how many rows it differs from
    one load of all files."""
    configure(spark)
    root = run_folder(spark, "incremental")
    piecemeal, whole = new_store(spark, "incremental"), new_store(spark, "whole")

    def take(name: str) -> None:
        rows = benchtables.dataset(spark, folder, name)
        number = F.crc32(F.concat_ws("/", *SOURCES[name].primary_key).cast("binary"))
        changed, value = ONCE[name]
        older = rows.where(number % 2 == 0).withColumn(changed, F.expr(value))
        for part, days in ((rows.where(number % 3 != 0), 0), (older, -3), (rows, 1)):
            land_batch(part, f"{root}/raw", name, LANDED_ON + dt.timedelta(days=days))
            load_new_files(piecemeal, f"{root}/raw", name)
        load_new_files(piecemeal, f"{root}/raw", name)
        run_all(whole, {name: lambda: read_batches(spark, f"{root}/raw", name, LOADED_AT)}).collect()

    # The datasets of the model share no table but the hubs of orders and customers, whose writers take turns.
    with ThreadPoolExecutor(len(SOURCES)) as pool:
        list(pool.map(inheritable_thread_target(spark)(take), SOURCES))
    found = []
    for table in (table for name in SOURCES for table in MODEL[name]):
        one, other = (store.read(table.name).drop("load_dts") for store in (piecemeal, whole))
        keys = other.select(*[packed(name).alias(name) if name in table.digests else name for name in table.key])
        found.append((table.name, keys.distinct().count(), sides(one.select(*other.columns), other)[1]))
        del one, other, keys
        release(spark)
    return outcome(spark, found, "table_name string, keys bigint, differing_rows bigint")


def centroid_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Zip centroids after four landings: all points, some that moved, some of another zip and new ones, and older places that came late."""
    configure(spark)
    root, store = run_folder(spark, "centroids"), new_store(spark, "centroids")
    points, number = benchtables.dataset(spark, folder, "geolocation"), F.col("geolocation_id")
    moved = points.where(number % 3 == 0).withColumn("geolocation_lat", F.col("geolocation_lat") + 1)
    rezoned = points.where(number % 5 == 0).withColumns(
        {"geolocation_zip_code_prefix": F.concat("geolocation_zip_code_prefix", F.lit("-B")), "geolocation_city": F.lit("new")}
    )
    added = points.where(number % 7 == 0).withColumn("geolocation_id", number + 10_000_000)
    late = points.where(number % 2 == 0).withColumn("geolocation_lat", F.lit(0.0))
    for rows, days in ((points, 0), (moved, 1), (rezoned.unionByName(added), 2), (late, -1)):
        land_batch(rows, root, "geolocation", LANDED_ON + dt.timedelta(days=days))
        load_new_files(store, root, "geolocation")
    return store.read("ref_geolocation").drop("load_dts", "record_source")


def leave_behind(spark: SparkSession, path: str, text: str = "{") -> None:
    """What a write that died leaves in a folder: a half-written file and no mark of success."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{path}/_temporary/0/task")


def bootstrap_after_dead_write(spark: SparkSession, folder: str) -> DataFrame:
    """First extracts where an earlier one of every table died while it wrote: all tables are landed and loaded."""
    configure(spark)
    root, store = run_folder(spark, "dead-bootstrap"), new_store(spark, "dead-bootstrap")
    tables = {name: benchtables.dataset(spark, folder, name) for name in SOURCES}
    for name in tables:
        leave_behind(spark, f"{day_folder(f'{root}/raw', name, LANDED_ON)}/run-dead")
        leave_behind(spark, f"{root}/marks/{name}")
    landed = bootstrap(spark, tables, f"{root}/raw", Marks(spark, f"{root}/marks"), LANDED_ON)
    again = bootstrap(spark, tables, f"{root}/raw", Marks(spark, f"{root}/marks"), LANDED_ON)
    loaded = {name: load_new_files(store, f"{root}/raw", name)[0].staged_rows for name in ("customers", "orders", "sellers")}
    rows = [(name, landed.get(name, 0), again.get(name, 0), loaded.get(name)) for name in SOURCES]
    return outcome(spark, rows, "dataset string, landed_rows bigint, second_rows bigint, loaded_rows bigint")


def landing_after_dead_write(spark: SparkSession, folder: str) -> DataFrame:
    """Messages landed by a job whose earlier attempts died while they wrote run id, landing date, ledger and events."""
    configure(spark)
    root = run_folder(spark, "dead-landing")
    message_files(spark, folder, f"{root}/inbox")
    run = "0123456789abcdef"
    for path in (f"{root}/raw/landing_dates/run={run}/batch={0:010d}", f"{root}/raw/landed_message_ids/run={run}/batch={0:010d}",
                 f"{day_folder(f'{root}/raw', 'events', LANDED_ON)}/run-{run}-batch-{0:010d}", f"{root}/quarantine/run={run}/batch=0"):
        leave_behind(spark, path)
    leave_behind(spark, f"{root}/checkpoint/run_id")
    once(spark, f"{root}/checkpoint/run_id", run)
    for days in (0, 1):
        jobs.landing_job(
            spark, f"{root}/inbox", f"{root}/raw", f"{root}/quarantine", f"{root}/checkpoint", LANDED_ON + dt.timedelta(days=days)
        )
    return flat_events(read_events(spark, f"{root}/raw", LOADED_AT)).select("event_id", "raw_partition_date")


def hubs_two_writers(spark: SparkSession, folder: str) -> DataFrame:
    """All rows of the order hub after orders and events were loaded side by side, twice."""
    configure(spark)
    store = new_store(spark, "two-writers")
    for _ in range(2):
        with ThreadPoolExecutor(2) as pool:
            list(pool.map(inheritable_thread_target(spark)(lambda dataset: load(store, folder, dataset)), ("orders", "events")))
    return store.rows("hub_order").select("order_id")


def lost_amounts(spark: SparkSession, folder: str) -> DataFrame:
    """Events of which the cheap ones got a price beyond all bounds: amounts that views count as null."""
    configure(spark)
    price = F.when(F.col("price") < 0.05, 1e20).otherwise(F.col("price"))
    return quality.lost_amounts(flat(spark, folder).withColumn("price", price), ["price", "freight_value"])


def raw_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Cut-off events among the landed lines: readers skip them and report each one."""
    configure(spark)
    root = run_folder(spark, "unreadable")
    lines = message_rows(spark, folder).select("body")
    lines.write.text(f"{root}/events/year={LANDED_ON:%Y}/month={LANDED_ON:%m}/day={LANDED_ON:%d}")
    good = read_events(spark, root, LOADED_AT).select(F.lit("read").alias("outcome"))
    bad = read_unreadable(spark, root, "events").select(F.lit("unreadable").alias("outcome"))
    return good.unionByName(bad).groupBy("outcome").agg(F.count(F.lit(1)).alias("events"))


def stream_vault(spark: SparkSession, folder: str) -> DataFrame:
    """Events streamed into a vault in several micro-batches, then a run that finds nothing new."""
    configure(spark)
    root = run_folder(spark, "stream")
    store = new_store(spark, "stream-vault")
    event_files(spark, folder, root)
    half = -(-len(spark.read.text(f"{root}/events").inputFiles()) // 2)  # two micro-batches, however many files there are
    for _ in range(2):
        jobs.vault_job(store, f"{root}/events", f"{root}/checkpoint", files_per_batch=half)
    context = store.compact_versions("sat_event_context").select("event_hk", "event_type", "event_timestamp", "raw_partition_date")
    links = as_bytes(store.read("link_event_order"), "event_hk", "link_event_order_hk", "order_hk")
    payment = store.compact_versions("sat_hot_payment_snapshot").select("link_event_order_hk", "payment_type", "payment_installments")
    found = (
        store.read("hub_event").select(packed("event_hk").alias("event_hk"), "event_id")
        .join(context, "event_hk").join(links, "event_hk").join(payment, "link_event_order_hk")
    )
    return as_text(found, "event_hk", "link_event_order_hk", "order_hk")


def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Messages delivered twice pass the stream once."""
    configure(spark)
    root = run_folder(spark, "dedup")
    message_files(spark, folder, f"{root}/inbox")
    unique = jobs.distinct_messages(jobs.message_stream(spark, f"{root}/inbox"), "60 days")
    jobs.drain(unique.writeStream.format("parquet").option("path", f"{root}/unique"), f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/unique").select("message_id", "sent_at")


def stream_hourly(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly figures by a stream, half of the files under one checkpoint, then all under a new one; counts of different
    orders and customers within 5 % (one at least) of those of the batch view."""
    configure(spark)
    root = run_folder(spark, "hourly")
    event_files(spark, folder, f"{root}/first", files=2)
    jobs.hourly_job(spark, f"{root}/first/events", f"{root}/hours", f"{root}/checkpoint-1", files_per_batch=1)
    # More events land beside the first ones; a new checkpoint sees all files.
    more = benchtables.events(spark, folder).withColumn("event_type", F.concat("event_type", F.lit("_again")))
    target = f"{root}/first/events/year={LANDED_ON:%Y}/month={LANDED_ON:%m}/day={LANDED_ON:%d}"
    more.repartition(2, "event_id").write.mode("append").option("timestampFormat", TIMESTAMP_FORMAT).json(target)
    for checkpoint in ("2", "2", "3"):
        jobs.hourly_job(spark, f"{root}/first/events", f"{root}/hours", f"{root}/checkpoint-{checkpoint}")
    exact = benchtables.events(spark, folder).unionByName(more).groupBy(
        F.date_trunc("hour", "event_timestamp").alias("hora"), "event_type", F.col("order.product_category_name").alias("product_category_name")
    ).agg(F.countDistinct("order.order_id").alias("orders"), F.countDistinct("customer.customer_unique_id").alias("customers"))
    hours = jobs.latest_hours(spark, f"{root}/hours")
    same = [hours[name].eqNullSafe(exact[name]) for name in jobs.HOUR]

    def near(found: str, truth: str) -> Column:
        return F.abs(F.col(found) - F.col(truth)) <= F.greatest(F.lit(1), F.col(truth) * 0.05)

    return hours.join(exact, same).select(
        *[hours[name] for name in jobs.HOUR], "eventos", "valor_total",
        near("pedidos_aproximados", "orders").alias("orders_near"), near("clientes_aproximados", "customers").alias("customers_near"),
    )


def stream_lost_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Events of which one type was cut off and one lost its id, streamed into a vault under two checkpoints: each row that
    the vault cannot take in, once."""
    configure(spark)
    root, store = run_folder(spark, "lost"), new_store(spark, "lost")
    body = F.to_json(F.struct(*benchtables.events(spark, folder).columns), {"timestampFormat": TIMESTAMP_FORMAT})
    kind = F.col("event_type")
    events = benchtables.events(spark, folder).withColumn("event_id", F.when(kind != "order_invoiced", F.col("event_id")))
    lines = events.withColumn("body", body).withColumn("body", F.when(kind == "order_delivered", F.expr("substring(body, 1, length(body) - 2)")).otherwise(F.col("body")))
    target = f"{root}/events/year={LANDED_ON:%Y}/month={LANDED_ON:%m}/day={LANDED_ON:%d}"
    compressed(lines.select("body").write).text(target)
    for checkpoint in ("1", "1", "2"):
        jobs.vault_job(store, f"{root}/events", f"{root}/checkpoint-{checkpoint}")
    lost = jobs.rejected_events(store).groupBy("reason").agg(F.count(F.lit(1)).alias("events"))
    taken = store.read("hub_event").select(F.lit("taken in").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("events"))
    return lost.unionByName(taken)


def pk_violations(spark: SparkSession, folder: str) -> DataFrame:
    configure(spark)
    items = benchtables.dataset(spark, folder, "order_items")
    return quality.duplicate_keys(items, list(SOURCES["order_items"].primary_key))


def fk_orphans(spark: SparkSession, folder: str) -> DataFrame:
    """Of the tables that others refer to, rows whose key ends in 7 were lost."""
    configure(spark)
    tables = {name: benchtables.dataset(spark, folder, name) for name in SOURCES}
    for name in ("customers", "sellers", "products", "orders"):
        tables[name] = tables[name].where(~F.col(SOURCES[name].primary_key[0]).endswith("7"))
    return quality.orphan_report(tables)


def event_order_orphans(spark: SparkSession, folder: str) -> DataFrame:
    """Orders that events mention and the order table does not have."""
    configure(spark)
    orders = benchtables.dataset(spark, folder, "orders")
    return quality.orphans(flat(spark, folder), "order_id", orders, "order_id")


def not_null_report(spark: SparkSession, folder: str) -> DataFrame:
    """Nulls in required columns; for orders the two delivery dates are asked for as well."""
    configure(spark)
    parts = []
    for name, source in SOURCES.items():
        if name == "orders":
            dates = ("order_delivered_carrier_date", "order_delivered_customer_date")
            source = dataclasses.replace(source, required=(*source.required, *dates))
        parts.append(quality.null_report(benchtables.dataset(spark, folder, name), source))
    return reduce(DataFrame.unionByName, parts)


def pipeline_health(spark: SparkSession, folder: str) -> DataFrame:
    """Events handled k * 20 seconds after they happened; cheap ones count as rejected."""
    configure(spark)
    k = F.get_json_object("props", "$.k").cast("int")
    events = spark.read.parquet(f"{folder}/events.parquet").select(
        F.col("ts").cast("timestamp").alias("happened"),
        (F.col("ts").cast("timestamp") + F.make_dt_interval(secs=(k * 20).cast("decimal(18,6)"))).alias("handled"),
        "value",
    )
    return quality.pipeline_health(events, "happened", "handled", F.col("value") < 5)


def run_isolated(spark: SparkSession, folder: str) -> DataFrame:
    """Three datasets, one of which has no source: the others are loaded all the same."""
    configure(spark)
    store = new_store(spark, "isolated")
    sources = {
        "sellers": lambda: benchtables.versioned(spark, folder, "sellers"),
        "products": lambda: spark.read.parquet(f"{folder}/no_such_table.parquet"),
        "order_items": lambda: benchtables.versioned(spark, folder, "order_items"),
    }
    done = run_all(store, sources, lambda s, dataset, rows: load(s, folder, dataset, rows))
    return done.drop("error")


QUERIES: dict[str, Query] = {
    "hash_keys": hash_keys,
    **{name: table_query(name, datasets) for name, datasets in HUB_SOURCES.items()},
    "link_customer_account": table_query("link_customer_account", ("customers",)),
    "link_order_customer": table_query("link_order_customer", ("orders",)),
    "link_order_item": table_query("link_order_item", ("order_items",)),
    "link_order_payment": table_query("link_order_payment", ("order_payments",)),
    "link_order_review": table_query("link_order_review", ("order_reviews",)),
    "link_event_order": table_query("link_event_order", ("events",)),
    "link_event_customer": table_query("link_event_customer", ("events",)),
    "sat_customer_profile": table_query("sat_customer_profile", ("customers",)),
    "sat_seller_profile": table_query("sat_seller_profile", ("sellers",)),
    "sat_product_details": table_query("sat_product_details", ("products",)),
    "sat_order_status": table_query("sat_order_status", ("orders",)),
    "sat_order_item_pricing": table_query("sat_order_item_pricing", ("order_items",)),
    "sat_order_payment_history": table_query("sat_order_payment", ("order_payments",)),
    "sat_order_review": table_query("sat_order_review", ("order_reviews",)),
    "sat_event_context": table_query("sat_event_context", ("events",)),
    "sat_hot_customer_profile_history": table_query("sat_hot_customer_profile", ("events",)),
    "sat_hot_order_snapshot_history": table_query("sat_hot_order_snapshot", ("events",)),
    "sat_hot_payment_snapshot": table_query("sat_hot_payment_snapshot", ("events",)),
    "ref_geolocation": table_query("ref_geolocation", ("geolocation",)),
    "ref_product_category": table_query("ref_product_category", ("product_category_name_translation",)),
    "sat_current_payment": current_payment,
    "sat_second_run": second_run,
    "insert_only_second_batch": insert_only_second_batch,
    "upsert_reference": upsert_reference,
    "dedup_deterministic": dedup_deterministic,
    "late_events": late_events,
    "late_events_current": late_events_current,
    **{name: view_query(name) for name in gold.VIEWS},
    "views_as_tables": views_as_tables,
    "lasting_views": lasting_views_query,
    **{name: report_query(name) for name in reports.REPORTS},
    "raw_batch_roundtrip": raw_batch_roundtrip,
    "raw_lines_roundtrip": raw_lines_roundtrip,
    "raw_event_roundtrip": raw_event_roundtrip,
    "raw_quarantine": raw_quarantine,
    "csv_load": csv_load,
    "load_summary": load_summary_query,
    "extract_pk_page": extract_pk_page,
    "extract_ts_page": extract_ts_page,
    "extract_resume": extract_resume,
    "extract_changes": extract_changes,
    "bootstrap_if_empty": bootstrap_if_empty,
    "landing_idempotent": landing_idempotent,
    "landing_restart": landing_restart,
    "extract_then_load": extract_then_load,
    "late_events_any_cut": late_events_any_cut,
    "load_incremental": load_incremental,
    "centroid_incremental": centroid_incremental,
    "bootstrap_after_dead_write": bootstrap_after_dead_write,
    "landing_after_dead_write": landing_after_dead_write,
    "hubs_two_writers": hubs_two_writers,
    "lost_amounts": lost_amounts,
    "contract_violations": contract_violations,
    "contract_requests": contract_requests,
    "quarantine_counts": quarantine_counts,
    "stream_vault": stream_vault,
    "stream_dedup": stream_dedup,
    "stream_hourly": stream_hourly,
    "stream_lost_rows": stream_lost_rows,
    "pk_violations": pk_violations,
    "fk_orphans": fk_orphans,
    "event_order_orphans": event_order_orphans,
    "not_null_report": not_null_report,
    "pipeline_health": pipeline_health,
    "run_isolated": run_isolated,
}
