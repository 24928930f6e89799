"""Schemas, keys and cursors of the source tables and of the order event."""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Source:
    """One relational source table."""

    name: str
    ddl: str
    primary_key: tuple[str, ...]
    required: tuple[str, ...] = ()
    foreign_keys: dict[str, str] = field(default_factory=dict)  # column -> referenced table
    cursor: tuple[str, ...] = ()  # defaults to the primary key

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def cursor_columns(self) -> tuple[str, ...]:
        return self.cursor or self.primary_key


# Table and column names (spelling included), types, keys and references of the source.
_SOURCES = (
    Source(
        "product_category_name_translation",
        "product_category_name string, product_category_name_english string",
        primary_key=("product_category_name",),
    ),
    Source(
        "customers",
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
        "customer_city string, customer_state string",
        primary_key=("customer_id",),
        required=("customer_unique_id",),
    ),
    Source(
        "sellers",
        "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string",
        primary_key=("seller_id",),
    ),
    Source(
        "geolocation",
        "geolocation_id bigint, geolocation_zip_code_prefix string, geolocation_lat double, "
        "geolocation_lng double, geolocation_city string, geolocation_state string",
        primary_key=("geolocation_id",),
    ),
    Source(
        "products",
        "product_id string, product_category_name string, product_name_lenght int, "
        "product_description_lenght int, product_photos_qty int, product_weight_g int, "
        "product_length_cm int, product_height_cm int, product_width_cm int",
        primary_key=("product_id",),
    ),
    Source(
        "orders",
        "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp, "
        "order_approved_at timestamp, order_delivered_carrier_date timestamp, "
        "order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp",
        primary_key=("order_id",),
        required=("customer_id", "order_status"),
        foreign_keys={"customer_id": "customers"},
        cursor=("order_purchase_timestamp", "order_id"),
    ),
    Source(
        "order_items",
        "order_id string, order_item_id int, product_id string, seller_id string, "
        "shipping_limit_date timestamp, price double, freight_value double",
        primary_key=("order_id", "order_item_id"),
        required=("order_id", "order_item_id", "product_id", "seller_id"),
        foreign_keys={"order_id": "orders", "product_id": "products", "seller_id": "sellers"},
    ),
    Source(
        "order_payments",
        "order_id string, payment_sequential int, payment_type string, payment_installments int, "
        "payment_value double",
        primary_key=("order_id", "payment_sequential"),
        required=("order_id", "payment_sequential"),
        foreign_keys={"order_id": "orders"},
    ),
    Source(
        "order_reviews",
        "review_id string, order_id string, review_score int, review_comment_title string, "
        "review_comment_message string, review_creation_date timestamp, review_answer_timestamp timestamp",
        primary_key=("review_id", "order_id"),
        required=("review_id", "order_id"),
        foreign_keys={"order_id": "orders"},
    ),
)

# Referenced tables come before the tables that refer to them.
SOURCES: dict[str, Source] = {source.name: source for source in _SOURCES}

EVENTS = "events"

# The order event.
EVENT_SCHEMA = (
    StructType()
    .add("event_id", "string")
    .add("event_type", "string")
    .add("event_timestamp", "timestamp")
    .add(
        "customer",
        StructType()
        .add("customer_unique_id", "string")
        .add("customer_name", "string")
        .add("customer_city", "string")
        .add("customer_state", "string")
        .add("customer_zip_code_prefix", "string"),
    )
    .add(
        "order",
        StructType()
        .add("order_id", "string")
        .add("product_category_name", "string")
        .add("product_name", "string")
        .add("items_count", "integer")
        .add("price", "double")
        .add("freight_value", "double"),
    )
    .add("payment", StructType().add("payment_type", "string").add("payment_installments", "integer"))
)

# Start of every timestamp cursor, prefixes of record_source.
CURSOR_START = "1900-01-01 00:00:00"
RECORD_SOURCE = {"batch": "raw.olist", "events": "raw.hot"}


def choose(selection: str) -> list[str]:
    """Dataset names from ``all`` or a comma list; an unknown name is an error, not an empty run."""
    if selection.strip().lower() == "all":
        return list(SOURCES)
    names = [part.strip() for part in selection.split(",") if part.strip()]
    unknown = sorted(set(names) - SOURCES.keys())
    if unknown:
        raise ValueError(f"unknown datasets {unknown}; known: {list(SOURCES)}")
    return names
