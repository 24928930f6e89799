"""The nine source tables and the events, expressed over the generated star-schema test tables.

The mapping gives every dataset the traits the vault has to cope with: accounts that share a
customer, payments and order snapshots with many versions, reviews whose id is not unique, orders
that only events know, categories without a translation.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakevault.functions.measures import MONEY
from lakevault.operators.model import SEQ_SCHEMA
from lakevault.sources.schemas import SOURCES

EVENT_TYPES = {
    "signup": "order_created",
    "view": "order_approved",
    "click": "order_invoiced",
    "purchase": "order_shipped",
    "error": "order_delivered",
}
PAYMENT_TYPES = ["credit_card", "boleto", "voucher", "debit_card", "not_defined"]
EVENT_CATEGORIES = ["beleza", "esporte", "livros", "casa", "moda", "brinquedos"]
STATES = ["SP", "RJ", "MG", "RS", "PR"]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _prefixed(letter: str, number) -> Column:
    return F.concat(F.lit(letter), number.cast("string"))


def _pick(values: list[str], index) -> Column:
    return F.element_at(F.array(*(F.lit(v) for v in values)), index.cast("int") + 1)


def _padded(*names: str) -> Column:
    """Numbers as text that sorts like the numbers."""
    return F.concat_ws("/", *(F.lpad(F.col(n).cast("string"), 12, "0") for n in names))


def customers(spark: SparkSession, folder: str) -> DataFrame:
    nation = _table(spark, folder, "nation").select("n_nationkey", "n_name")
    rows = _table(spark, folder, "customer")
    return rows.join(nation, rows.c_nationkey == nation.n_nationkey).select(
        _prefixed("A", F.col("c_custkey")).alias("customer_id"),
        _prefixed("U", F.expr("c_custkey div 2")).alias("customer_unique_id"),
        F.col("c_nationkey").cast("string").alias("customer_zip_code_prefix"),
        F.col("c_mktsegment").alias("customer_city"),
        F.col("n_name").alias("customer_state"),
    )


def sellers(spark: SparkSession, folder: str) -> DataFrame:
    nation = _table(spark, folder, "nation").select("n_nationkey", "n_name")
    rows = _table(spark, folder, "supplier")
    return rows.join(nation, rows.s_nationkey == nation.n_nationkey).select(
        _prefixed("S", F.col("s_suppkey")).alias("seller_id"),
        F.col("s_nationkey").cast("string").alias("seller_zip_code_prefix"),
        F.lit("-").alias("seller_city"),
        F.col("n_name").alias("seller_state"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    size = F.col("p_size").cast("int")
    return _table(spark, folder, "part").select(
        _prefixed("P", F.col("p_partkey")).alias("product_id"),
        F.col("p_type").alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        F.length("p_brand").alias("product_description_lenght"),
        (size % 6).alias("product_photos_qty"),
        (size * 100).alias("product_weight_g"),
        size.alias("product_length_cm"),
        (size + 1).alias("product_height_cm"),
        (size + 2).alias("product_width_cm"),
    )


def product_category_name_translation(spark: SparkSession, folder: str) -> DataFrame:
    types = _table(spark, folder, "part").select("p_type").where("p_type <> 'ECONOMY'").distinct()
    return types.select(
        F.col("p_type").alias("product_category_name"),
        F.lower("p_type").alias("product_category_name_english"),
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    placed = F.col("o_orderdate").cast("timestamp")
    shipped = _table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.min(F.col("l_shipdate").cast("timestamp")).alias("first_ship"),
        F.max(F.col("l_shipdate").cast("timestamp")).alias("last_ship"),
    )
    rows = _table(spark, folder, "orders")
    status = F.col("o_orderstatus")
    return rows.join(shipped, rows.o_orderkey == shipped.l_orderkey, "left").select(
        _prefixed("O", F.col("o_orderkey")).alias("order_id"),
        _prefixed("A", F.col("o_custkey")).alias("customer_id"),
        F.when(status == "F", "delivered").when(status == "O", "shipped").otherwise("approved").alias("order_status"),
        placed.alias("order_purchase_timestamp"),
        (placed + F.expr("interval 1 day")).alias("order_approved_at"),
        F.when(status != "P", F.col("first_ship")).alias("order_delivered_carrier_date"),
        F.when(status == "F", F.col("last_ship")).alias("order_delivered_customer_date"),
        (placed + F.expr("interval 30 days")).alias("order_estimated_delivery_date"),
    )


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    freight = (F.col("l_extendedprice").cast(MONEY) * F.col("l_tax").cast("decimal(4,2)")).cast(MONEY)
    return _table(spark, folder, "lineitem").select(
        _prefixed("O", F.col("l_orderkey")).alias("order_id"),
        F.col("l_linenumber").cast("int").alias("order_item_id"),
        _prefixed("P", F.col("l_partkey")).alias("product_id"),
        _prefixed("S", F.col("l_suppkey")).alias("seller_id"),
        F.col("l_shipdate").cast("timestamp").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        freight.cast("double").alias("freight_value"),
        F.struct(
            F.col("l_shipdate").cast("timestamp").alias("at"),
            F.lpad(F.col("l_extendedprice").cast(MONEY).cast("string"), 12, "0").alias("tie"),
        ).alias("seq"),
    )


def order_payments(spark: SparkSession, folder: str) -> DataFrame:
    quantity = F.col("l_quantity").cast("int")
    return _table(spark, folder, "lineitem").select(
        _prefixed("O", F.col("l_orderkey")).alias("order_id"),
        F.col("l_linenumber").cast("int").alias("payment_sequential"),
        F.col("l_returnflag").alias("payment_type"),
        (F.lit(1) + quantity % 2).alias("payment_installments"),
        ((quantity % 3) * F.lit(10.0)).cast("double").alias("payment_value"),
        F.struct(
            F.col("l_shipdate").cast("timestamp").alias("at"), _padded("l_partkey", "l_suppkey").alias("tie")
        ).alias("seq"),
    )


def order_reviews(spark: SparkSession, folder: str) -> DataFrame:
    placed = _table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("doc_id"), F.col("o_orderdate").cast("timestamp").alias("created")
    )
    rows = _table(spark, folder, "labels").join(
        _table(spark, folder, "documents").select("doc_id", "source", "text"), "doc_id"
    ).join(placed, "doc_id")
    hours = F.make_dt_interval(hours=(F.col("doc_id") % 72).cast("int"))
    return rows.select(
        _prefixed("R", F.expr("doc_id div 2")).alias("review_id"),
        _prefixed("O", F.col("doc_id")).alias("order_id"),
        (F.lit(1) + 2 * F.col("quality") + F.col("toxic")).cast("int").alias("review_score"),
        F.col("source").alias("review_comment_title"),
        F.col("text").alias("review_comment_message"),
        F.col("created").alias("review_creation_date"),
        (F.col("created") + hours).alias("review_answer_timestamp"),
        F.struct(F.col("created").alias("at"), _padded("doc_id").alias("tie")).alias("seq"),
    )


def geolocation(spark: SparkSession, folder: str) -> DataFrame:
    nation = _table(spark, folder, "nation").select("n_nationkey", "n_name")
    of_customers = _table(spark, folder, "customer").select(
        (2 * F.col("c_custkey")).alias("id"),
        F.col("c_nationkey").alias("zip"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("city"),
    )
    of_sellers = _table(spark, folder, "supplier").select(
        (2 * F.col("s_suppkey") + 1).alias("id"),
        F.col("s_nationkey").alias("zip"),
        F.col("s_acctbal").alias("balance"),
        F.lit("-").alias("city"),
    )
    points = of_customers.unionByName(of_sellers)
    return points.join(nation, points.zip == nation.n_nationkey).select(
        F.col("id").alias("geolocation_id"),
        F.col("zip").cast("string").alias("geolocation_zip_code_prefix"),
        F.col("balance").alias("geolocation_lat"),
        (2 * F.col("balance")).alias("geolocation_lng"),
        F.col("city").alias("geolocation_city"),
        F.col("n_name").alias("geolocation_state"),
    )


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Nested order events; the top user's orders exist in the events only."""
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.create_map(*(F.lit(part) for pair in EVENT_TYPES.items() for part in pair))
    user, amount = F.col("user_id"), F.col("value")
    category = _pick(EVENT_CATEGORIES, k % 6)
    return _table(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.try_element_at(kind, F.col("event_type")).alias("event_type"),
        F.col("ts").cast("timestamp").alias("event_timestamp"),
        F.struct(
            _prefixed("U", F.expr("user_id div 2")).alias("customer_unique_id"),
            _prefixed("Customer ", F.expr("user_id div 2")).alias("customer_name"),
            _prefixed("city ", k % 3).alias("customer_city"),
            _pick(STATES, user % 5).alias("customer_state"),
            F.lpad((user % 100).cast("string"), 5, "0").alias("customer_zip_code_prefix"),
        ).alias("customer"),
        F.struct(
            _prefixed("O", user * 100 + k + 50).alias("order_id"),
            category.alias("product_category_name"),
            F.concat(category, F.lit(" "), (k % 10).cast("string")).alias("product_name"),
            (F.lit(1) + k % 4).alias("items_count"),
            amount.alias("price"),
            (amount.cast(MONEY) * F.lit("0.10").cast("decimal(2,2)")).cast(MONEY).cast("double").alias("freight_value"),
        ).alias("order"),
        F.struct(
            _pick(PAYMENT_TYPES, k % 5).alias("payment_type"),
            (F.lit(1) + k % 10).alias("payment_installments"),
        ).alias("payment"),
    )


BUILDERS = {
    "customers": customers,
    "sellers": sellers,
    "products": products,
    "product_category_name_translation": product_category_name_translation,
    "orders": orders,
    "order_items": order_items,
    "order_payments": order_payments,
    "order_reviews": order_reviews,
    "geolocation": geolocation,
}


def dataset(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A source table with exactly its declared columns."""
    return BUILDERS[name](spark, folder).select(*SOURCES[name].columns)


def versioned(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A source table with ``seq``; tables without versions of their own get one fixed position."""
    rows = BUILDERS[name](spark, folder)
    if "seq" not in rows.columns:
        rows = rows.withColumn("seq", F.lit(None).cast(SEQ_SCHEMA))
    return rows
