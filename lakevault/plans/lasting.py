"""The nine views as SQL views in the catalog: they outlast the session, and any SQL user can query them.

Each is CREATE OR REPLACE over the vault's tables, in order of dependency, with the names of store and views filled in.
They say the same as the DataFrame views in ``gold``, which reports use because those leave out what is not asked for.
Inside a view digests are bytes, half as long as their text and most of what it shuffles.
"""
from __future__ import annotations

from lakevault.operators.specs import TABLES
from lakevault.operators.store import RETIRED_TABLE, VaultStore
from lakevault.plans.gold import VIEWS

# Per view its SELECT; <name> is a vault table's rows that count, and of a satellite its current versions.
SELECTS = {
    "dim_customer": """
        select l.customer_account_hk, a.customer_id, l.customer_hk, c.customer_unique_id, p.customer_zip_code_prefix,
               p.customer_city, p.customer_state, g.geolocation_lat as customer_lat, g.geolocation_lng as customer_lng
        from <link_customer_account> l
        join <hub_customer_account> a on a.customer_account_hk = l.customer_account_hk
        join <hub_customer> c on c.customer_hk = l.customer_hk
        left join <sat_customer_profile> p on p.customer_account_hk = l.customer_account_hk
        left join <ref_geolocation> g on g.geolocation_zip_code_prefix = p.customer_zip_code_prefix""",
    "dim_product": """
        select h.product_hk, h.product_id, d.product_category_name,
               coalesce(c.product_category_name_english, d.product_category_name) as product_category_name_english,
               d.product_weight_g, d.product_photos_qty,
               cast(d.product_length_cm as bigint) * d.product_height_cm * d.product_width_cm as product_volume_cm3
        from <hub_product> h
        left join <sat_product_details> d on d.product_hk = h.product_hk
        left join <ref_product_category> c on c.product_category_name = d.product_category_name""",
    "dim_seller": """
        select h.seller_hk, h.seller_id, p.seller_zip_code_prefix, p.seller_city, p.seller_state,
               g.geolocation_lat as seller_lat, g.geolocation_lng as seller_lng
        from <hub_seller> h
        left join <sat_seller_profile> p on p.seller_hk = h.seller_hk
        left join <ref_geolocation> g on g.geolocation_zip_code_prefix = p.seller_zip_code_prefix""",
    "fact_order": """
        select h.order_hk, h.order_id, l.customer_account_hk, s.order_status, s.order_purchase_timestamp, s.order_approved_at,
               s.order_delivered_carrier_date, s.order_delivered_customer_date, s.order_estimated_delivery_date,
               to_date(s.order_purchase_timestamp) as order_purchase_date,
               timestampdiff(DAY, s.order_purchase_timestamp, s.order_delivered_customer_date) as dias_ate_entrega,
               timestampdiff(DAY, s.order_estimated_delivery_date, s.order_delivered_customer_date) as dias_de_atraso
        from <hub_order> h
        left join <link_order_customer> l on l.order_hk = h.order_hk
        left join <sat_order_status> s on s.order_hk = h.order_hk""",
    "fact_order_item": """
        select l.link_order_item_hk, l.order_hk, l.product_hk, l.seller_hk, l.order_item_id, p.shipping_limit_date, p.price, p.freight_value,
               cast(try_cast(p.price as decimal(18,2)) + try_cast(p.freight_value as decimal(18,2)) as double) as valor_total_item
        from <link_order_item> l left join <sat_order_item_pricing> p on p.link_order_item_hk = l.link_order_item_hk""",
    "fact_order_payment": """
        select l.link_order_payment_hk, l.order_hk, l.payment_sequential, p.payment_type, p.payment_installments, p.payment_value
        from <link_order_payment> l left join <sat_order_payment> p on p.link_order_payment_hk = l.link_order_payment_hk""",
    "fact_order_review": """
        select h.review_hk, h.review_id, l.order_hk, r.review_score, r.review_comment_title, r.review_creation_date, r.review_answer_timestamp,
               timestampdiff(DAY, r.review_creation_date, r.review_answer_timestamp) as dias_ate_resposta
        from <hub_review> h
        left join <link_order_review> l on l.review_hk = h.review_hk
        left join <sat_order_review> r on r.review_hk = h.review_hk""",
    "fact_order_event": """
        select h.event_hk, h.event_id, c.event_type, c.event_timestamp, c.raw_partition_date, o.order_hk, u.customer_hk,
               s.product_category_name, s.items_count, s.price, s.freight_value,
               cast(try_cast(s.price as decimal(18,2)) + try_cast(s.freight_value as decimal(18,2)) as double) as valor_total_evento,
               p.payment_type, p.payment_installments
        from <hub_event> h
        left join <link_event_order> o on o.event_hk = h.event_hk
        left join <link_event_customer> u on u.event_hk = h.event_hk
        left join <sat_event_context> c on c.event_hk = h.event_hk
        left join <sat_hot_order_snapshot> s on s.order_hk = o.order_hk
        left join <sat_hot_payment_snapshot> p on p.link_event_order_hk = o.link_event_order_hk""",
    "agg_order_event_hourly": """
        select date_trunc('hour', event_timestamp) as hora, event_type, product_category_name, count(*) as eventos,
               count(distinct unhex(order_hk)) as pedidos_distintos, count(distinct unhex(customer_hk)) as clientes_distintos,
               cast(sum(try_cast(valor_total_evento as decimal(18,2))) as double) as valor_total,
               cast(sum(try_cast(valor_total_evento as decimal(18,2))) as double) / count(try_cast(valor_total_evento as decimal(18,2))) as ticket_medio
        from {prefix}fact_order_event where event_timestamp is not null group by 1, 2, 3""",
}


def _compact(store: VaultStore, name: str) -> str:
    """SQL for all rows of a stored table with its digests as bytes."""
    source = store.qualified(name)
    columns = (f"unhex(`{c}`) as `{c}`" if c.endswith("_hk") or c == "hashdiff" else f"`{c}`" for c in store.spark.table(source).columns)
    return f"(select {', '.join(columns)} from {source})"


def _rows_that_count(store: VaultStore, name: str) -> str:
    """SQL for a table's rows as ``store.read`` and ``store.current`` give them, digests as bytes."""
    table, source = TABLES[name], _compact(store, name)
    key = ", ".join(f"`{column}`" for column in table.key)
    if table.kind == "satellite":
        place, notes = f"{key}, seq, hashdiff", _compact(store, f"{name}_{RETIRED_TABLE}")
        retired = f"select {place} from (select *, row_number() over (partition by {place} order by turn desc) as place_ from {notes}) where place_ = 1 and dead"
        same = " and ".join(f"v.{column} <=> r.{column}" for column in (*table.key, "seq", "hashdiff"))
        versions = f"select v.* from {source} v left anti join ({retired}) r on {same}"
        return f"(select * from (select *, row_number() over (partition by {key} order by seq desc, hashdiff desc, load_dts desc) as place_ from ({versions})) where place_ = 1)"
    if table.kind == "reference":
        others = ", ".join(f"`{column}` asc" for column in table.payload)
        gone = " and record_source is not null" if table.upkeep else ""
        return f"(select * from (select *, row_number() over (partition by {key} order by load_dts desc, {others}) as place_ from {source}) where place_ = 1{gone})"
    return source


def lasting_views(store: VaultStore, prefix: str = "") -> list[str]:
    """Create or replace every view as ``<prefix><name>`` in the vault's database; the qualified names, in order.

    Tables that no load has made yet are registered first, so that every view can be queried from the start.
    """
    store.ensure_all()
    for table in TABLES.values():
        if table.kind == "satellite":
            store.ensure_note(table, RETIRED_TABLE)
    created = []
    for name in VIEWS:
        select = SELECTS[name].replace("{prefix}", f"{store.database}.{prefix}")
        for table in TABLES:
            if f"<{table}>" in select:
                select = select.replace(f"<{table}>", _rows_that_count(store, table))
        columns = (f"lower(hex({c})) as {c}" if c.endswith("_hk") else c for c in VIEWS[name](store, None).columns)
        store.spark.sql(f"CREATE OR REPLACE VIEW {store.database}.{prefix}{name} AS select {', '.join(columns)} from ({select})")
        created.append(f"{store.database}.{prefix}{name}")
    return created
