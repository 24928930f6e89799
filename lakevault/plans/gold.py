"""Dimensional views over the current vault. Nothing is copied; every view is one lazy plan.

Join strategies are left to Catalyst and AQE: lookups and dimensions below the broadcast limit are
broadcast by their measured size, larger ones are merged and split where a key is skewed.

Keys meet as bytes, half as long as their text and most of what a view shuffles; they become text where a view ends.
"""
from __future__ import annotations

from collections.abc import Callable, Collection
from functools import wraps

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakevault.functions.hashing import brief, packed, unpacked
from lakevault.functions.measures import complete_days, money, money_avg, money_sum
from lakevault.operators.history import current
from lakevault.operators.specs import TABLES
from lakevault.operators.store import VaultStore

Columns = Collection[str] | None  # names a caller needs; None for all


def read(store: VaultStore, name: str) -> DataFrame:
    """A table with its keys as bytes; as text where tables are bucketed by it and not shuffled at all."""
    rows = store.read(name)
    if store.buckets:
        return rows
    return rows.withColumns({key: brief(packed(key)) if store.brief else packed(key) for key in rows.columns if key.endswith("_hk")})


def newest(store: VaultStore, name: str) -> DataFrame:
    """The newest version per key of a satellite."""
    if store.buckets:
        return store.current(name)
    if not store.brief:
        return store.compact_current(name)
    key = TABLES[name].key[0]
    return current(store.compact_versions(name).withColumns({digest: brief(digest) for digest in (key, "hashdiff")}), key)


def published(view: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The view with its keys as text; ``inner`` is the one to build on, whose keys are as they meet."""

    @wraps(view)
    def readable(store: VaultStore, columns: Columns = None) -> DataFrame:
        rows = view(store, columns)
        return rows.withColumns({name: unpacked(name) for name, kind in rows.dtypes if name.endswith("_hk") and kind == "binary"})

    readable.inner = view
    return readable


PLACE = {"customer_lat", "customer_lng"}


def describe(rows: DataFrame, part: DataFrame, key: str, columns: Columns) -> DataFrame:
    """Left join a part that has at most one row per key, unless nothing it adds is asked for.

    Spark cannot know that the key is unique and would have to keep the join; leaving it out saves
    the scan, the ranking and the shuffle of a whole satellite.
    """
    adds = [name for name in part.columns if name != key]
    if columns is not None and not set(adds) & set(columns):
        return rows
    return rows.join(part, key, "left")


def narrowed(rows: DataFrame, columns: Columns, *names: str) -> DataFrame:
    """The view's columns in their order, or those of them that are asked for."""
    return rows.select(*(name for name in names if columns is None or name in columns))


def with_place(rows: DataFrame, store: VaultStore, role: str, columns: Columns) -> DataFrame:
    """Add ``<role>_lat`` and ``<role>_lng`` of the row's zip prefix, null when it is unknown."""
    places = store.read("ref_geolocation").select(
        F.col("geolocation_zip_code_prefix").alias(f"{role}_zip_code_prefix"),
        F.col("geolocation_lat").alias(f"{role}_lat"),
        F.col("geolocation_lng").alias(f"{role}_lng"),
    )
    return describe(rows, places, f"{role}_zip_code_prefix", columns)


@published
def dim_customer(store: VaultStore, columns: Columns = None) -> DataFrame:
    """One row per customer account; people are told apart by ``customer_unique_id``."""
    # The link carries both keys and is loaded with both hubs; a hub is read for its business key only.
    accounts = read(store, "link_customer_account").select("customer_account_hk", "customer_hk")
    if columns is None or "customer_id" in columns:
        accounts = accounts.join(read(store, "hub_customer_account").select("customer_account_hk", "customer_id"), "customer_account_hk")
    if columns is None or "customer_unique_id" in columns:
        accounts = accounts.join(read(store, "hub_customer").select("customer_hk", "customer_unique_id"), "customer_hk")
    profile = newest(store, "sat_customer_profile").select(
        "customer_account_hk", "customer_zip_code_prefix", "customer_city", "customer_state"
    )
    # The place is looked up by the profile's zip prefix.
    needed = columns if columns is None else {*columns, "customer_zip_code_prefix"} if PLACE & set(columns) else columns
    described = describe(accounts, profile, "customer_account_hk", needed)
    if "customer_zip_code_prefix" in described.columns:
        described = with_place(described, store, "customer", columns)
    return narrowed(
        described, columns,
        "customer_account_hk", "customer_id", "customer_hk", "customer_unique_id",
        "customer_zip_code_prefix", "customer_city", "customer_state", "customer_lat", "customer_lng",
    )


@published
def dim_product(store: VaultStore, columns: Columns = None) -> DataFrame:
    """One row per product; the English category falls back to the original name."""
    details = newest(store, "sat_product_details").select(
        "product_hk", "product_category_name", "product_weight_g", "product_photos_qty",
        (
            F.col("product_length_cm").cast("bigint") * F.col("product_height_cm") * F.col("product_width_cm")
        ).alias("product_volume_cm3"),
    )
    english = store.read("ref_product_category").select("product_category_name", "product_category_name_english")
    products = read(store, "hub_product").select("product_hk", "product_id").join(details, "product_hk", "left")
    named = products.join(english, "product_category_name", "left").withColumn(
        "product_category_name_english", F.coalesce("product_category_name_english", "product_category_name")
    )
    return narrowed(
        named, columns,
        "product_hk", "product_id", "product_category_name", "product_category_name_english",
        "product_weight_g", "product_photos_qty", "product_volume_cm3",
    )


@published
def dim_seller(store: VaultStore, columns: Columns = None) -> DataFrame:
    """One row per seller."""
    profile = newest(store, "sat_seller_profile").select(
        "seller_hk", "seller_zip_code_prefix", "seller_city", "seller_state"
    )
    sellers = read(store, "hub_seller").select("seller_hk", "seller_id")
    described = with_place(sellers.join(profile, "seller_hk", "left"), store, "seller", columns)
    return narrowed(
        described, columns,
        "seller_hk", "seller_id", "seller_zip_code_prefix", "seller_city", "seller_state", "seller_lat", "seller_lng"
    )


def order_rows(store: VaultStore, orders: DataFrame, columns: Columns) -> DataFrame:
    purchase, delivered = "order_purchase_timestamp", "order_delivered_customer_date"
    status = newest(store, "sat_order_status").select(
        "order_hk", "order_status", purchase, "order_approved_at", "order_delivered_carrier_date", delivered,
        "order_estimated_delivery_date",
        F.to_date(purchase).alias("order_purchase_date"),
        complete_days(purchase, delivered).alias("dias_ate_entrega"),
        complete_days("order_estimated_delivery_date", delivered).alias("dias_de_atraso"),
    )
    return narrowed(
        describe(orders, status, "order_hk", columns), columns,
        "order_hk", *(["order_id"] if "order_id" in orders.columns else []), "customer_account_hk", "order_status", purchase,
        "order_approved_at", "order_delivered_carrier_date", delivered, "order_estimated_delivery_date", "order_purchase_date",
        "dias_ate_entrega", "dias_de_atraso",
    )


@published
def fact_order(store: VaultStore, columns: Columns = None) -> DataFrame:
    """One row per order and account link; orders known from events only have no status."""
    placed = (
        read(store, "hub_order").select("order_hk", "order_id")
        .join(read(store, "link_order_customer").select("order_hk", "customer_account_hk"), "order_hk", "left")
    )
    return order_rows(store, placed, columns)


@published
def account_orders(store: VaultStore, columns: Columns = None) -> DataFrame:
    """The rows of ``fact_order`` that belong to an account, without the order's own key: the hub is not read."""
    return order_rows(store, read(store, "link_order_customer").select("order_hk", "customer_account_hk"), columns)


@published
def fact_order_item(store: VaultStore, columns: Columns = None) -> DataFrame:
    """One row per order item; price and freight live here and not on the order."""
    pricing = newest(store, "sat_order_item_pricing").select(
        "link_order_item_hk", "shipping_limit_date", "price", "freight_value",
        (money("price") + money("freight_value")).cast("double").alias("valor_total_item"),
    )
    items = read(store, "link_order_item").select(
        "link_order_item_hk", "order_hk", "product_hk", "seller_hk", "order_item_id"
    )
    return narrowed(
        describe(items, pricing, "link_order_item_hk", columns), columns,
        "link_order_item_hk", "order_hk", "product_hk", "seller_hk", "order_item_id",
        "shipping_limit_date", "price", "freight_value", "valor_total_item",
    )


@published
def fact_order_payment(store: VaultStore, columns: Columns = None) -> DataFrame:
    """One row per payment of an order."""
    payment = newest(store, "sat_order_payment").select(
        "link_order_payment_hk", "payment_type", "payment_installments", "payment_value"
    )
    payments = read(store, "link_order_payment").select("link_order_payment_hk", "order_hk", "payment_sequential")
    return narrowed(
        describe(payments, payment, "link_order_payment_hk", columns), columns,
        "link_order_payment_hk", "order_hk", "payment_sequential",
        "payment_type", "payment_installments", "payment_value",
    )


@published
def fact_order_review(store: VaultStore, columns: Columns = None) -> DataFrame:
    """One row per review and reviewed order."""
    review = newest(store, "sat_order_review").select(
        "review_hk", "review_score", "review_comment_title", "review_creation_date", "review_answer_timestamp",
        complete_days("review_creation_date", "review_answer_timestamp").alias("dias_ate_resposta"),
    )
    reviews = (
        read(store, "hub_review").select("review_hk", "review_id")
        .join(read(store, "link_order_review").select("review_hk", "order_hk"), "review_hk", "left")
    )
    return narrowed(
        describe(reviews, review, "review_hk", columns), columns,
        "review_hk", "review_id", "order_hk", "review_score", "review_comment_title",
        "review_creation_date", "review_answer_timestamp", "dias_ate_resposta",
    )


@published
def fact_order_event(store: VaultStore, columns: Columns = None) -> DataFrame:
    """One row per event. Order columns show the order's newest snapshot, not the state at the event."""
    context = newest(store, "sat_event_context").select(
        "event_hk", "event_type", "event_timestamp", "raw_partition_date"
    )
    snapshot = newest(store, "sat_hot_order_snapshot").select(
        "order_hk", "product_category_name", "items_count", "price", "freight_value",
        (money("price") + money("freight_value")).cast("double").alias("valor_total_evento"),
    )
    payment = newest(store, "sat_hot_payment_snapshot").select(
        "link_event_order_hk", "payment_type", "payment_installments"
    )
    events = (
        read(store, "hub_event").select("event_hk", "event_id")
        .join(read(store, "link_event_order").select("event_hk", "link_event_order_hk", "order_hk"), "event_hk", "left")
        .join(read(store, "link_event_customer").select("event_hk", "customer_hk"), "event_hk", "left")
    )
    events = describe(events, context, "event_hk", columns)
    events = describe(events, snapshot, "order_hk", columns)
    events = describe(events, payment, "link_event_order_hk", columns)
    return narrowed(
        events, columns,
        "event_hk", "event_id", "event_type", "event_timestamp", "raw_partition_date", "order_hk",
        "customer_hk", "product_category_name", "items_count", "price", "freight_value", "valor_total_evento",
        "payment_type", "payment_installments",
    )


@published
def order_events(store: VaultStore, columns: Columns = None) -> DataFrame:
    """Event type and time of every event that names an order; neither the hub nor the customer link is read."""
    context = newest(store, "sat_event_context").select("event_hk", "event_type", "event_timestamp")
    events = read(store, "link_event_order").select("event_hk", "order_hk")
    return narrowed(describe(events, context, "event_hk", columns), columns, "event_hk", "order_hk", "event_type", "event_timestamp")


@published
def agg_order_event_hourly(store: VaultStore, columns: Columns = None) -> DataFrame:
    """Events per hour, type and category."""
    events = fact_order_event.inner(
        store,
        ("event_type", "event_timestamp", "order_hk", "customer_hk", "product_category_name", "valor_total_evento"),
    )
    hours = (
        events.where(F.col("event_timestamp").isNotNull())
        .groupBy(F.date_trunc("hour", "event_timestamp").alias("hora"), "event_type", "product_category_name")
        .agg(
            F.count(F.lit(1)).alias("eventos"),
            F.count_distinct("order_hk").alias("pedidos_distintos"),
            F.count_distinct("customer_hk").alias("clientes_distintos"),
            money_sum("valor_total_evento").alias("valor_total"),
            money_avg("valor_total_evento").alias("ticket_medio"),
        )
    )
    return narrowed(hours, columns, *hours.columns)


# In order of dependency.
VIEWS: dict[str, Callable[[VaultStore, Columns], DataFrame]] = {
    "dim_customer": dim_customer,
    "dim_product": dim_product,
    "dim_seller": dim_seller,
    "fact_order": fact_order,
    "fact_order_item": fact_order_item,
    "fact_order_payment": fact_order_payment,
    "fact_order_review": fact_order_review,
    "fact_order_event": fact_order_event,
    "agg_order_event_hourly": agg_order_event_hourly,
}


# Parts of views for reports that need no more; they are not published.
PARTS: dict[str, Callable[[VaultStore, Columns], DataFrame]] = {"account_orders": account_orders, "order_events": order_events}


def reader(store: VaultStore) -> Callable[..., DataFrame]:
    """``view(name, *columns)`` over a store, the way reports read: they join and count keys, but show none, so 128 bits of each do."""
    store = store.within(store.spark)
    store.brief = True
    return lambda name, *columns: (VIEWS | PARTS)[name].inner(store, columns or None)


def create_views(store: VaultStore, prefix: str = "") -> list[str]:
    """Create or replace every view as ``<prefix><name>``; the names created, in order."""
    created = []
    for name, view in VIEWS.items():
        view(store, None).createOrReplaceTempView(f"{prefix}{name}")
        created.append(f"{prefix}{name}")
    return created
