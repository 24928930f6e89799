"""The vault model: 7 hubs, 7 links, 11 satellites and 2 references as data.

The model is written in terms of entities. An entity has one business key; its hub, the links that
connect it and the satellites that describe it all derive their hash columns from that one entry, so
a link can never disagree with its hubs.
"""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from lakevault.operators.batchlog import NewestRows
from lakevault.operators.centroid import KeptPoints, zip_centroids

# Entity -> business key.
ENTITIES = {
    "customer": "customer_unique_id",
    "customer_account": "customer_id",
    "seller": "seller_id",
    "product": "product_id",
    "order": "order_id",
    "review": "review_id",
    "event": "event_id",
}


@dataclass(frozen=True)
class VaultTable:
    """One table of the vault and how its rows derive from a dataset row.

    ``digests`` maps every hash column to the business columns it digests; the first one is the
    table's own key. References have none and are keyed by ``natural_key``.
    """

    name: str
    kind: str  # "hub", "link", "satellite" or "reference"
    digests: dict[str, tuple[str, ...]]
    payload: tuple[str, ...]
    natural_key: tuple[str, ...] = ()
    compared: tuple[str, ...] | None = None  # satellite columns that count as a change; None = payload
    prepare: Callable[[DataFrame], DataFrame] | None = None
    upkeep: type | None = None  # keeps a reference up to date from batches that are parts; see ``batchlog``

    @property
    def key(self) -> list[str]:
        return list(self.natural_key) or [next(iter(self.digests))]

    @property
    def compared_columns(self) -> tuple[str, ...]:
        return self.payload if self.compared is None else self.compared

    @property
    def identity(self) -> tuple[str, ...]:
        """Source columns that must all be filled for a row to enter the table."""
        return self.natural_key or next(iter(self.digests.values()))


def hub(entity: str) -> VaultTable:
    business_key = ENTITIES[entity]
    return VaultTable(f"hub_{entity}", "hub", {f"{entity}_hk": (business_key,)}, (business_key,))


def link(
    name: str, identity: tuple[str, ...], connects: tuple[str, ...], child_keys: tuple[str, ...] = ()
) -> VaultTable:
    digests = {f"{name}_hk": identity}
    digests.update({f"{entity}_hk": (ENTITIES[entity],) for entity in connects})
    return VaultTable(name, "link", digests, child_keys)


def satellite(
    name: str,
    parent: VaultTable,
    payload: tuple[str, ...],
    compared: tuple[str, ...] | None = None,
) -> VaultTable:
    parent_key = parent.key[0]
    digests = {parent_key: parent.digests[parent_key]}
    return VaultTable(name, "satellite", digests, payload, compared=compared)


def reference(
    name: str,
    natural_key: tuple[str, ...],
    payload: tuple[str, ...],
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    upkeep: type | None = None,
) -> VaultTable:
    return VaultTable(name, "reference", {}, payload, natural_key=natural_key, prepare=prepare, upkeep=upkeep)


HUBS = {entity: hub(entity) for entity in ENTITIES}

# Link names, the order of their key parts, dependent child keys.
LINK_CUSTOMER_ACCOUNT = link(
    "link_customer_account", ("customer_id", "customer_unique_id"), ("customer_account", "customer")
)
LINK_ORDER_CUSTOMER = link("link_order_customer", ("order_id", "customer_id"), ("order", "customer_account"))
LINK_ORDER_ITEM = link(
    "link_order_item",
    ("order_id", "order_item_id", "product_id", "seller_id"),
    ("order", "product", "seller"),
    ("order_item_id",),
)
LINK_ORDER_PAYMENT = link(
    "link_order_payment", ("order_id", "payment_sequential"), ("order",), ("payment_sequential",)
)
LINK_ORDER_REVIEW = link("link_order_review", ("review_id", "order_id"), ("review", "order"))
LINK_EVENT_ORDER = link("link_event_order", ("event_id", "order_id"), ("event", "order"))
LINK_EVENT_CUSTOMER = link("link_event_customer", ("event_id", "customer_unique_id"), ("event", "customer"))

# Which tables each dataset feeds, and the satellites' attributes. Two people-facing
# hubs, order and customer, are fed by the batch datasets and by the events alike.
MODEL: dict[str, tuple[VaultTable, ...]] = {
    "customers": (
        HUBS["customer"],
        HUBS["customer_account"],
        LINK_CUSTOMER_ACCOUNT,
        satellite(
            "sat_customer_profile",
            HUBS["customer_account"],
            ("customer_zip_code_prefix", "customer_city", "customer_state"),
        ),
    ),
    "sellers": (
        HUBS["seller"],
        satellite(
            "sat_seller_profile", HUBS["seller"], ("seller_zip_code_prefix", "seller_city", "seller_state")
        ),
    ),
    "products": (
        HUBS["product"],
        satellite(
            "sat_product_details",
            HUBS["product"],
            (
                "product_category_name",
                "product_name_lenght",
                "product_description_lenght",
                "product_photos_qty",
                "product_weight_g",
                "product_length_cm",
                "product_height_cm",
                "product_width_cm",
            ),
        ),
    ),
    "orders": (
        HUBS["order"],
        LINK_ORDER_CUSTOMER,
        satellite(
            "sat_order_status",
            HUBS["order"],
            (
                "order_status",
                "order_purchase_timestamp",
                "order_approved_at",
                "order_delivered_carrier_date",
                "order_delivered_customer_date",
                "order_estimated_delivery_date",
            ),
        ),
    ),
    "order_items": (
        LINK_ORDER_ITEM,
        satellite(
            "sat_order_item_pricing", LINK_ORDER_ITEM, ("shipping_limit_date", "price", "freight_value")
        ),
    ),
    "order_payments": (
        LINK_ORDER_PAYMENT,
        satellite(
            "sat_order_payment",
            LINK_ORDER_PAYMENT,
            ("payment_type", "payment_installments", "payment_value"),
        ),
    ),
    "order_reviews": (
        HUBS["review"],
        LINK_ORDER_REVIEW,
        satellite(
            "sat_order_review",
            HUBS["review"],
            (
                "order_id",
                "review_score",
                "review_comment_title",
                "review_comment_message",
                "review_creation_date",
                "review_answer_timestamp",
            ),
        ),
    ),
    "geolocation": (
        reference(
            "ref_geolocation",
            ("geolocation_zip_code_prefix",),
            ("geolocation_lat", "geolocation_lng", "geolocation_city", "geolocation_state"),
            prepare=zip_centroids,
            upkeep=KeptPoints,
        ),
    ),
    "product_category_name_translation": (
        reference("ref_product_category", ("product_category_name",), ("product_category_name_english",), upkeep=NewestRows),
    ),
    "events": (
        HUBS["event"],
        HUBS["order"],
        HUBS["customer"],
        LINK_EVENT_ORDER,
        LINK_EVENT_CUSTOMER,
        # The file an event arrived in is kept, but a re-delivery in another file is no change.
        satellite(
            "sat_event_context",
            HUBS["event"],
            ("event_type", "event_timestamp", "raw_file", "raw_partition_date"),
            compared=("event_type", "event_timestamp"),
        ),
        satellite(
            "sat_hot_customer_profile",
            HUBS["customer"],
            ("customer_name", "customer_city", "customer_state", "customer_zip_code_prefix"),
        ),
        satellite(
            "sat_hot_order_snapshot",
            HUBS["order"],
            ("product_category_name", "product_name", "items_count", "price", "freight_value"),
        ),
        # A payment belongs to the order as seen in that event, hence to the link.
        satellite("sat_hot_payment_snapshot", LINK_EVENT_ORDER, ("payment_type", "payment_installments")),
    ),
}

TABLES: dict[str, VaultTable] = {table.name: table for tables in MODEL.values() for table in tables}
