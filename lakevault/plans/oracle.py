"""The same results as plain SQL over the test tables, without vault, hashing of rows or history tables.

Each statement goes from the base tables straight to the result, so agreement checks the whole way
through landing, modelling, merging and views.
"""
from __future__ import annotations

# Source tables of the domain, expressed over the test tables.
DATASETS = {
    "customers": """
        select concat('A', c_custkey) as customer_id, concat('U', c_custkey // 2) as customer_unique_id,
               cast(c_nationkey as varchar) as customer_zip_code_prefix, c_mktsegment as customer_city,
               n_name as customer_state
        from customer join nation on n_nationkey = c_nationkey""",
    "sellers": """
        select concat('S', s_suppkey) as seller_id, cast(s_nationkey as varchar) as seller_zip_code_prefix,
               '-' as seller_city, n_name as seller_state
        from supplier join nation on n_nationkey = s_nationkey""",
    "products": """
        select concat('P', p_partkey) as product_id, p_type as product_category_name,
               cast(length(p_name) as integer) as product_name_lenght,
               cast(length(p_brand) as integer) as product_description_lenght,
               cast(p_size % 6 as integer) as product_photos_qty,
               cast(p_size * 100 as integer) as product_weight_g, cast(p_size as integer) as product_length_cm,
               cast(p_size + 1 as integer) as product_height_cm, cast(p_size + 2 as integer) as product_width_cm
        from part""",
    "translation": """
        select distinct p_type as product_category_name, lower(p_type) as product_category_name_english
        from part where p_type <> 'ECONOMY'""",
    "purchases": """
        select concat('O', o_orderkey) as order_id, concat('A', o_custkey) as customer_id,
               case o_orderstatus when 'F' then 'delivered' when 'O' then 'shipped' else 'approved' end as order_status,
               cast(o_orderdate as timestamp) as order_purchase_timestamp,
               cast(o_orderdate + interval 1 day as timestamp) as order_approved_at,
               case when o_orderstatus <> 'P' then cast(first_ship as timestamp) end as order_delivered_carrier_date,
               case when o_orderstatus = 'F' then cast(last_ship as timestamp) end as order_delivered_customer_date,
               cast(o_orderdate + interval 30 day as timestamp) as order_estimated_delivery_date
        from orders left join (
            select l_orderkey, min(l_shipdate) as first_ship, max(l_shipdate) as last_ship
            from lineitem group by l_orderkey) as shipped on l_orderkey = o_orderkey""",
    "items": """
        select concat('O', l_orderkey) as order_id, cast(l_linenumber as integer) as order_item_id,
               concat('P', l_partkey) as product_id, concat('S', l_suppkey) as seller_id,
               cast(l_shipdate as timestamp) as shipping_limit_date, l_extendedprice as price,
               cast(cast(cast(l_extendedprice as decimal(18,2)) * cast(l_tax as decimal(4,2)) as decimal(18,2)) as double)
                   as freight_value,
               cast(l_shipdate as timestamp) as seq_at,
               lpad(cast(cast(l_extendedprice as decimal(18,2)) as varchar), 12, '0') as seq_tie
        from lineitem""",
    # The newest version of each item.
    "sold": """
        select * from (
            select *, row_number() over (
                partition by order_id, order_item_id, product_id, seller_id
                order by seq_at desc, seq_tie desc,
                         sha256(concat_ws('||', cast(shipping_limit_date as varchar), cast(price as varchar),
                                          cast(freight_value as varchar))) desc) as place
            from items) where place = 1""",
    "payments": """
        select concat('O', l_orderkey) as order_id, cast(l_linenumber as integer) as payment_sequential,
               l_returnflag as payment_type, cast(1 + cast(l_quantity as integer) % 2 as integer) as payment_installments,
               10.0::double * (cast(l_quantity as integer) % 3) as payment_value,
               cast(l_shipdate as timestamp) as seq_at,
               concat(lpad(cast(l_partkey as varchar), 12, '0'), '/', lpad(cast(l_suppkey as varchar), 12, '0')) as seq_tie
        from lineitem""",
    "reviews": """
        select concat('R', doc_id // 2) as review_id, concat('O', doc_id) as order_id,
               cast(1 + 2 * quality + toxic as integer) as review_score, source as review_comment_title,
               text as review_comment_message, cast(o_orderdate as timestamp) as review_creation_date,
               cast(o_orderdate as timestamp) + to_hours(cast(doc_id % 72 as integer)) as review_answer_timestamp,
               cast(o_orderdate as timestamp) as seq_at, lpad(cast(doc_id as varchar), 12, '0') as seq_tie
        from labels join documents using (doc_id) join orders on o_orderkey = doc_id""",
    "points": """
        select 2 * c_custkey as geolocation_id, cast(c_nationkey as varchar) as zip, c_acctbal as lat,
               2 * c_acctbal as lng, c_mktsegment as city, n_name as state
        from customer join nation on n_nationkey = c_nationkey
        union all
        select 2 * s_suppkey + 1, cast(s_nationkey as varchar), s_acctbal, 2 * s_acctbal, '-', n_name
        from supplier join nation on n_nationkey = s_nationkey""",
    "keyed_events": """
        select *, cast(regexp_extract(props, '([0-9]+)', 1) as integer) as k from events""",
    "happenings": """
        select cast(event_id as varchar) as event_id,
               case event_type when 'signup' then 'order_created' when 'view' then 'order_approved'
                    when 'click' then 'order_invoiced' when 'purchase' then 'order_shipped'
                    when 'error' then 'order_delivered' end as event_type,
               cast(ts as timestamp) as event_timestamp,
               concat('U', user_id // 2) as customer_unique_id, concat('Customer ', user_id // 2) as customer_name,
               concat('city ', k % 3) as customer_city,
               ['SP', 'RJ', 'MG', 'RS', 'PR'][user_id % 5 + 1] as customer_state,
               lpad(cast(user_id % 100 as varchar), 5, '0') as customer_zip_code_prefix,
               concat('O', user_id * 100 + k + 50) as order_id,
               ['beleza', 'esporte', 'livros', 'casa', 'moda', 'brinquedos'][k % 6 + 1] as product_category_name,
               concat(['beleza', 'esporte', 'livros', 'casa', 'moda', 'brinquedos'][k % 6 + 1], ' ', k % 10) as product_name,
               cast(1 + k % 4 as integer) as items_count, value as price,
               cast(cast(cast(value as decimal(18,2)) * cast('0.10' as decimal(2,2)) as decimal(18,2)) as double) as freight_value,
               ['credit_card', 'boleto', 'voucher', 'debit_card', 'not_defined'][k % 5 + 1] as payment_type,
               cast(1 + k % 10 as integer) as payment_installments, k, user_id
        from keyed_events""",
}
NEEDS = {"happenings": ("keyed_events",), "sold": ("items",)}


def sha(*columns: str) -> str:
    """Hash key of columns, as SQL."""
    # The upper case of a sharp s is "SS" in Spark and a capital sharp s in DuckDB.
    parts = ", ".join(f"coalesce(replace(upper(trim(cast({c} as varchar))), 'ẞ', 'SS'), '')" for c in columns)
    return f"sha256(concat_ws('||', {parts}))"


def query(body: str, *datasets: str, **extra: str) -> str:
    """A statement over the named datasets; ``extra`` adds further named subqueries in order."""
    names = list(dict.fromkeys(n for d in datasets for n in (*NEEDS.get(d, ()), d)))
    parts = [f"{n} as ({DATASETS[n]})" for n in names] + [f"{n} as ({sql})" for n, sql in extra.items()]
    return f"with {', '.join(parts)} {body}" if parts else body


def hub(key: str, column: str, *sources: tuple[str, str]) -> str:
    """A hub fed by sources (dataset, record source) in order: each key keeps its first source."""
    union = " union all ".join(
        f"select {column}, '{record}' as record_source, {place} as place from {dataset}"
        for place, (dataset, record) in enumerate(sources)
    )
    body = f"select {sha(column)} as {key}, {column}, arg_min(record_source, place) as record_source from u group by {column}"
    return query(body, *(dataset for dataset, _ in sources), u=union)


def link(name: str, dataset: str, identity: list[str], hubs: dict[str, str], record: str, children: list[str]) -> str:
    columns = [f"{sha(*identity)} as {name}_hk"]
    columns += [f"{sha(column)} as {key}" for key, column in hubs.items()]
    columns += [*children, f"'{record}' as record_source"]
    return query(f"select distinct {', '.join(columns)} from {dataset}", dataset)


def history(
    dataset: str, key: str, identity: list[str], payload: list[str], record: str,
    seq: tuple[str, str] = ("seq_at", "seq_tie"), keep: list[str] | None = None,
) -> str:
    """A satellite: rows that differ from the row before them in time."""
    hashdiff = sha(*payload)
    versions = (
        f"select {sha(*identity)} as {key}, {', '.join(payload)}, {hashdiff} as hashdiff, {seq[0]} as seq_at, "
        f"{seq[1]} as seq_tie, '{record}' as record_source from {dataset}"
    )
    marked = f"select *, lag(hashdiff) over (partition by {key} order by seq_at, seq_tie, hashdiff) as before from versions"
    columns = keep or [key, *payload, "hashdiff", "record_source", "seq_at", "seq_tie"]
    body = f"select {', '.join(columns)} from marked where before is distinct from hashdiff"
    return query(body, dataset, versions=versions, marked=marked)


def plain_satellite(dataset: str, key: str, identity: list[str], payload: list[str], record: str) -> str:
    """A satellite of a dataset that has one row per key."""
    body = (
        f"select {sha(*identity)} as {key}, {', '.join(payload)}, {sha(*payload)} as hashdiff, "
        f"'{record}' as record_source, cast(null as timestamp) as seq_at, cast(null as varchar) as seq_tie from {dataset}"
    )
    return query(body, dataset)


def batch(name: str) -> str:
    return f"raw.olist.{name}"


EVENTS = "raw.hot.events"
PROFILE = ["customer_zip_code_prefix", "customer_city", "customer_state"]
SELLER = ["seller_zip_code_prefix", "seller_city", "seller_state"]
DETAILS = [
    "product_category_name", "product_name_lenght", "product_description_lenght", "product_photos_qty",
    "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
]
STATUS = [
    "order_status", "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date",
]
ITEM = ["order_id", "order_item_id", "product_id", "seller_id"]
PRICING = ["shipping_limit_date", "price", "freight_value"]
PAYMENT = ["payment_type", "payment_installments", "payment_value"]
REVIEW = [
    "order_id", "review_score", "review_comment_title", "review_comment_message", "review_creation_date",
    "review_answer_timestamp",
]
SNAPSHOT = ["product_category_name", "product_name", "items_count", "price", "freight_value"]
HOT_PROFILE = ["customer_name", "customer_city", "customer_state", "customer_zip_code_prefix"]
EVENT_SEQ = ("event_timestamp", "event_id")

CENTROID = """
    select zip as geolocation_zip_code_prefix,
           cast(sum(cast(lat as decimal(18,2))) as double) / count(lat) as geolocation_lat,
           cast(sum(cast(lng as decimal(18,2))) as double) / count(lng) as geolocation_lng,
           min(city) as geolocation_city, min(state) as geolocation_state
    from {points} group by zip"""
GEO = CENTROID.format(points="points")

LATEST_PAYMENT = """
    select *, row_number() over (partition by order_id, payment_sequential
                                 order by seq_at desc, seq_tie desc) as place from payments"""
LATEST_REVIEW = """
    select *, row_number() over (partition by review_id order by seq_at desc, seq_tie desc) as place from reviews"""
LATEST_SNAPSHOT = """
    select *, row_number() over (partition by order_id order by event_timestamp desc, event_id desc) as place
    from happenings"""
EVENT_FACT = f"""
    select {sha('h.event_id')} as event_hk, h.event_id, h.event_type, h.event_timestamp,
           date '2024-02-01' as raw_partition_date, {sha('h.order_id')} as order_hk,
           {sha('h.customer_unique_id')} as customer_hk, s.product_category_name, s.items_count, s.price,
           s.freight_value,
           cast(cast(s.price as decimal(18,2)) + cast(s.freight_value as decimal(18,2)) as double) as valor_total_evento,
           h.payment_type, h.payment_installments
    from happenings as h join latest as s on s.order_id = h.order_id and s.place = 1"""
ALL_ORDERS = "select order_id from purchases union select order_id from happenings"
ITEM_VALUE = """
    select order_id, cast(sum(cast(price as decimal(18,2)) + cast(freight_value as decimal(18,2))) as decimal(18,2)) as valor
    from sold group by order_id"""
HISTORY_COUNT = """
    select count(*) from (select {key} as key, {diff} as hashdiff,
        lag({diff}) over (partition by {key} order by {order}) as before from {dataset}) where before is distinct from hashdiff"""


def history_count(dataset: str, key: list[str], payload: list[str], order: str) -> str:
    diff = sha(*payload)
    return HISTORY_COUNT.format(key=sha(*key), diff=diff, order=f"{order}, {diff}", dataset=dataset)


DISTINCT_ITEMS = "select count(distinct (order_id, order_item_id, product_id, seller_id)) from {}"


def count_rows(pairs: dict[str, str], label: str = "table_name", value: str = "row_count") -> str:
    return " union all ".join(f"select '{n}' as {label}, cast(({sql}) as bigint) as {value}" for n, sql in pairs.items())


COUNTED = {
    "product_category_name_translation": "translation", "customers": "customers", "sellers": "sellers",
    "geolocation": "points", "products": "products", "orders": "purchases", "order_items": "items",
    "order_payments": "payments", "order_reviews": "reviews",
}
ROW_COUNTS = {name: f"select count(*) from {cte}" for name, cte in COUNTED.items()}

# Rows of every view.
VIEW_COUNTS = {
    "dim_customer": "select count(*) from customers", "dim_product": "select count(*) from products",
    "dim_seller": "select count(*) from sellers", "fact_order": "select count(*) from all_orders",
    "fact_order_item": "select count(*) from sold",
    "fact_order_payment": "select count(distinct order_id || '/' || payment_sequential) from payments",
    "fact_order_review": "select count(*) from reviews", "fact_order_event": "select count(*) from happenings",
    "agg_order_event_hourly": "select count(distinct (date_trunc('hour', event_timestamp), event_type, "
    "product_category_name)) from fact",
}
VIEW_NEEDS = (*COUNTED.values(), "sold", "happenings")
VIEW_PARTS = {"all_orders": ALL_ORDERS, "latest": LATEST_SNAPSHOT, "fact": EVENT_FACT}

# Different keys of every table of the batch datasets.
_KEYS = {
    "hub_customer": ("customers", "customer_unique_id"), "hub_customer_account": ("customers", "customer_id"),
    "link_customer_account": ("customers", "customer_id, customer_unique_id"), "sat_customer_profile": ("customers", "customer_id"),
    "hub_seller": ("sellers", "seller_id"), "sat_seller_profile": ("sellers", "seller_id"),
    "hub_product": ("products", "product_id"), "sat_product_details": ("products", "product_id"),
    "hub_order": ("purchases", "order_id"), "link_order_customer": ("purchases", "order_id, customer_id"), "sat_order_status": ("purchases", "order_id"),
    "link_order_item": ("items", "order_id, order_item_id, product_id, seller_id"),
    "sat_order_item_pricing": ("items", "order_id, order_item_id, product_id, seller_id"),
    "link_order_payment": ("payments", "order_id, payment_sequential"), "sat_order_payment": ("payments", "order_id, payment_sequential"),
    "hub_review": ("reviews", "review_id"), "link_order_review": ("reviews", "review_id, order_id"), "sat_order_review": ("reviews", "review_id"),
    "ref_geolocation": ("points", "zip"), "ref_product_category": ("translation", "product_category_name"),
}
KEY_COUNTS = {table: f"select count(*) from (select distinct {key} from {cte})" for table, (cte, key) in _KEYS.items()}

BENT = """
    select *, concat('S', k % 12) as bent_state, case when k % 3 = 1 then null else customer_name end as bent_name,
           price - 5 as bent_price, k % 4 as bent_items, k % 10 as bent_installments from happenings"""
RULES = {
    "customer.customer_name:required": "bent_name is null",
    "customer.customer_state:length": "length(bent_state) <> 2",
    "order.items_count:minimum": "bent_items < 1",
    "order.price:minimum": "bent_price < 0",
    "payment.payment_installments:minimum": "bent_installments < 1",
}


def contract_sql() -> str:
    counts = " union all ".join(f"select '{rule}' as rule, count(*) as events from bent where {broken}" for rule, broken in RULES.items())
    return query(f"select * from ({counts}) where events > 0", "happenings", bent=BENT)


def orphan_sql() -> str:
    references = [
        ("orders", "purchases", "customer_id", "customers", "customers", "customer_id"),
        ("order_items", "items", "order_id", "orders", "purchases", "order_id"),
        ("order_items", "items", "product_id", "products", "products", "product_id"),
        ("order_items", "items", "seller_id", "sellers", "sellers", "seller_id"),
        ("order_payments", "payments", "order_id", "orders", "purchases", "order_id"),
        ("order_reviews", "reviews", "order_id", "orders", "purchases", "order_id"),
    ]
    # Rows of parents whose key ends in 7 were lost; orders are parents and children.
    parts = [
        f"select '{name}' as table_name, '{column}' as column_name, '{parent}' as parent_table, "
        f"count(distinct {column}) as missing_keys, count(*) as child_rows from {child} "
        f"where {column} not in (select {key} from {parent_cte} where {key} not like '%7')"
        + (" and order_id not like '%7'" if name == "orders" else "")
        for name, child, column, parent, parent_cte, key in references
    ]
    return query(" union all ".join(parts), *COUNTED.values())


def null_sql() -> str:
    asked = {
        "product_category_name_translation": ["product_category_name"],
        "customers": ["customer_id", "customer_unique_id"],
        "sellers": ["seller_id"],
        "geolocation": ["geolocation_id"],
        "products": ["product_id"],
        "orders": ["order_id", "customer_id", "order_status", "order_delivered_carrier_date", "order_delivered_customer_date"],
        "order_items": ["order_id", "order_item_id", "product_id", "seller_id"],
        "order_payments": ["order_id", "payment_sequential"],
        "order_reviews": ["review_id", "order_id"],
    }
    parts = [
        f"select '{name}' as table_name, '{column}' as column_name, count(*) - count({column}) as null_rows, "
        f"count(*) as total_rows from {COUNTED[name]}"
        for name, columns in asked.items()
        for column in columns
    ]
    return query(" union all ".join(parts), *COUNTED.values())


ORACLE: dict[str, str] = {
    "hash_keys": query(
        "select customer_id, sha256(customer_id) as clean_hk, sha256(customer_id) as untidy_hk, "
        "sha256(customer_id || '||' || customer_unique_id) as pair_hk, "
        "sha256(customer_id || '||||' || customer_state) as with_null_hk from customers",
        "customers",
    ),
    "hub_customer": hub("customer_hk", "customer_unique_id", ("customers", batch("customers")), ("happenings", EVENTS)),
    "hub_customer_account": hub("customer_account_hk", "customer_id", ("customers", batch("customers"))),
    "hub_seller": hub("seller_hk", "seller_id", ("sellers", batch("sellers"))),
    "hub_product": hub("product_hk", "product_id", ("products", batch("products"))),
    "hub_order": hub("order_hk", "order_id", ("purchases", batch("orders")), ("happenings", EVENTS)),
    "hub_review": hub("review_hk", "review_id", ("reviews", batch("order_reviews"))),
    "hub_event": hub("event_hk", "event_id", ("happenings", EVENTS)),
    "link_customer_account": link(
        "link_customer_account", "customers", ["customer_id", "customer_unique_id"],
        {"customer_account_hk": "customer_id", "customer_hk": "customer_unique_id"}, batch("customers"), [],
    ),
    "link_order_customer": link(
        "link_order_customer", "purchases", ["order_id", "customer_id"],
        {"order_hk": "order_id", "customer_account_hk": "customer_id"}, batch("orders"), [],
    ),
    "link_order_item": link(
        "link_order_item", "items", ITEM,
        {"order_hk": "order_id", "product_hk": "product_id", "seller_hk": "seller_id"}, batch("order_items"), ["order_item_id"],
    ),
    "link_order_payment": link(
        "link_order_payment", "payments", ["order_id", "payment_sequential"], {"order_hk": "order_id"},
        batch("order_payments"), ["payment_sequential"],
    ),
    "link_order_review": link(
        "link_order_review", "reviews", ["review_id", "order_id"], {"review_hk": "review_id", "order_hk": "order_id"},
        batch("order_reviews"), [],
    ),
    "link_event_order": link(
        "link_event_order", "happenings", ["event_id", "order_id"], {"event_hk": "event_id", "order_hk": "order_id"}, EVENTS, []
    ),
    "link_event_customer": link(
        "link_event_customer", "happenings", ["event_id", "customer_unique_id"],
        {"event_hk": "event_id", "customer_hk": "customer_unique_id"}, EVENTS, [],
    ),
    "sat_customer_profile": plain_satellite("customers", "customer_account_hk", ["customer_id"], PROFILE, batch("customers")),
    "sat_seller_profile": plain_satellite("sellers", "seller_hk", ["seller_id"], SELLER, batch("sellers")),
    "sat_product_details": plain_satellite("products", "product_hk", ["product_id"], DETAILS, batch("products")),
    "sat_order_status": plain_satellite("purchases", "order_hk", ["order_id"], STATUS, batch("orders")),
    "sat_order_item_pricing": history("items", "link_order_item_hk", ITEM, PRICING, batch("order_items")),
    "sat_order_payment_history": history(
        "payments", "link_order_payment_hk", ["order_id", "payment_sequential"], PAYMENT, batch("order_payments")
    ),
    "sat_order_review": history("reviews", "review_hk", ["review_id"], REVIEW, batch("order_reviews")),
    "sat_event_context": history(
        "happenings", "event_hk", ["event_id"], ["event_type", "event_timestamp"], EVENTS, EVENT_SEQ,
        keep=["event_hk", "event_type", "event_timestamp", "date '2024-02-01' as raw_partition_date", "hashdiff",
              "record_source", "seq_at", "seq_tie"],
    ),
    "sat_hot_customer_profile_history": history(
        "happenings", "customer_hk", ["customer_unique_id"], HOT_PROFILE, EVENTS, EVENT_SEQ
    ),
    "sat_hot_order_snapshot_history": history("happenings", "order_hk", ["order_id"], SNAPSHOT, EVENTS, EVENT_SEQ),
    "sat_hot_payment_snapshot": history(
        "happenings", "link_event_order_hk", ["event_id", "order_id"], ["payment_type", "payment_installments"], EVENTS, EVENT_SEQ
    ),
    "ref_geolocation": query(f"select *, '{batch('geolocation')}' as record_source from ({GEO})", "points"),
    "ref_product_category": query(
        f"select *, '{batch('product_category_name_translation')}' as record_source from translation", "translation"
    ),
    "sat_current_payment": query(
        f"select {sha('order_id', 'payment_sequential')} as link_order_payment_hk, {', '.join(PAYMENT)}, hashdiff, seq_at "
        "from (select *, row_number() over (partition by order_id, payment_sequential order by seq_at desc, seq_tie desc) as place "
        "from changed where before is distinct from hashdiff) where place = 1",
        "payments",
        changed=f"select *, {sha(*PAYMENT)} as hashdiff, lag({sha(*PAYMENT)}) over "
        "(partition by order_id, payment_sequential order by seq_at, seq_tie) as before from payments",
    ),
    "sat_second_run": query(
        "select *, cast(0 as bigint) as second_run from (" + count_rows(
            {
                "link_order_payment": "select count(distinct order_id || '/' || payment_sequential) from payments",
                "sat_order_payment": history_count(
                    "payments", ["order_id", "payment_sequential"], PAYMENT, "seq_at, seq_tie"),
                "hub_event": "select count(*) from happenings",
                "hub_order": "select count(distinct order_id) from happenings",
                "hub_customer": "select count(distinct customer_unique_id) from happenings",
                "link_event_order": "select count(*) from happenings",
                "link_event_customer": "select count(*) from happenings",
                "sat_event_context": "select count(*) from happenings",
                "sat_hot_customer_profile": history_count(
                    "happenings", ["customer_unique_id"], HOT_PROFILE, "event_timestamp, event_id"),
                "sat_hot_order_snapshot": history_count(
                    "happenings", ["order_id"], SNAPSHOT, "event_timestamp, event_id"),
                "sat_hot_payment_snapshot": "select count(*) from happenings",
            }, value="first_run") + ")",
        "payments", "happenings",
    ),
    "insert_only_second_batch": query(
        " union all ".join(
            f"select 1 as batch, '{table}' as table_name, (select count(*) from early) as staged_rows, "
            f"({early}) as appended_rows union all "
            f"select 2, '{table}', (select count(*) from items), ({everything}) - ({early})"
            for table, early, everything in (
                ("link_order_item", DISTINCT_ITEMS.format("early"), DISTINCT_ITEMS.format("items")),
                ("sat_order_item_pricing", history_count("early", ITEM, PRICING, "seq_at, seq_tie"),
                 history_count("items", ITEM, PRICING, "seq_at, seq_tie")),
            )
        ),
        "items", early="select * from items where shipping_limit_date < timestamp '2000-01-01'",
    ),
    "upsert_reference": query(
        f"select *, '{batch('geolocation')}' as record_source from second union all "
        f"select *, '{batch('geolocation')}' from first where geolocation_zip_code_prefix not in "
        "(select geolocation_zip_code_prefix from second)",
        "points",
        first=CENTROID.format(points="(select * from points where city <> '-')"),
        second=CENTROID.format(points="(select * from points where city = '-')"),
    ),
    "dedup_deterministic": query(
        "select order_id, payment_sequential, payment_type, payment_installments, payment_value from ("
        "select *, row_number() over (partition by order_id, payment_sequential order by payment_type, "
        "payment_installments, payment_value) as place from payments) where place = 1",
        "payments",
    ),
    "late_events": history(
        "happenings", "order_hk", ["order_id"], SNAPSHOT, EVENTS, EVENT_SEQ, keep=["order_hk", "hashdiff", "seq_at"]
    ),
    "late_events_current": query(
        f"select {sha('o.customer_unique_id')} as customer_hk, {sha('s.order_id')} as order_hk, "
        f"s.product_category_name, s.product_name, s.items_count, s.price, s.freight_value, s.hashdiff, p.hashdiff as profile_hashdiff "
        "from (select distinct order_id, customer_unique_id from happenings) as o "
        "join latest as s on s.order_id = o.order_id and s.place = 1 "
        "join people as p on p.customer_unique_id = o.customer_unique_id and p.place = 1",
        "happenings",
        latest=f"select *, {sha(*SNAPSHOT)} as hashdiff, row_number() over (partition by order_id "
        "order by event_timestamp desc, event_id desc) as place from happenings",
        people=f"select customer_unique_id, {sha(*HOT_PROFILE)} as hashdiff, row_number() over (partition by customer_unique_id "
        "order by event_timestamp desc, event_id desc) as place from happenings",
    ),
    "dim_customer": query(
        f"select {sha('customer_id')} as customer_account_hk, customer_id, {sha('customer_unique_id')} as customer_hk, "
        "customer_unique_id, customer_zip_code_prefix, customer_city, customer_state, geolocation_lat as customer_lat, "
        "geolocation_lng as customer_lng from customers left join geo on geolocation_zip_code_prefix = customer_zip_code_prefix",
        "customers", "points", geo=GEO,
    ),
    "dim_product": query(
        f"select {sha('product_id')} as product_hk, product_id, p.product_category_name, "
        "coalesce(product_category_name_english, p.product_category_name) as product_category_name_english, "
        "product_weight_g, product_photos_qty, "
        "cast(product_length_cm as bigint) * product_height_cm * product_width_cm as product_volume_cm3 "
        "from products as p left join translation as t on t.product_category_name = p.product_category_name",
        "products", "translation",
    ),
    "dim_seller": query(
        f"select {sha('seller_id')} as seller_hk, seller_id, seller_zip_code_prefix, seller_city, seller_state, "
        "geolocation_lat as seller_lat, geolocation_lng as seller_lng "
        "from sellers left join geo on geolocation_zip_code_prefix = seller_zip_code_prefix",
        "sellers", "points", geo=GEO,
    ),
    "fact_order": query(
        f"select {sha('a.order_id')} as order_hk, a.order_id, case when customer_id is not null then {sha('customer_id')} end "
        f"as customer_account_hk, {', '.join(STATUS)}, cast(order_purchase_timestamp as date) as order_purchase_date, "
        "date_sub('day', order_purchase_timestamp, order_delivered_customer_date) as dias_ate_entrega, "
        "date_sub('day', order_estimated_delivery_date, order_delivered_customer_date) as dias_de_atraso "
        "from all_orders as a left join purchases as p on p.order_id = a.order_id",
        "purchases", "happenings", all_orders=ALL_ORDERS,
    ),
    "fact_order_item": query(
        f"select {sha(*ITEM)} as link_order_item_hk, {sha('order_id')} as order_hk, {sha('product_id')} as product_hk, "
        f"{sha('seller_id')} as seller_hk, order_item_id, shipping_limit_date, price, freight_value, "
        "cast(cast(price as decimal(18,2)) + cast(freight_value as decimal(18,2)) as double) as valor_total_item from sold",
        "sold",
    ),
    "fact_order_payment": query(
        f"select {sha('order_id', 'payment_sequential')} as link_order_payment_hk, {sha('order_id')} as order_hk, "
        "payment_sequential, payment_type, payment_installments, payment_value from latest where place = 1",
        "payments", latest=LATEST_PAYMENT,
    ),
    "fact_order_review": query(
        f"select {sha('r.review_id')} as review_hk, r.review_id, {sha('r.order_id')} as order_hk, l.review_score, "
        "l.review_comment_title, l.review_creation_date, l.review_answer_timestamp, "
        "date_sub('day', l.review_creation_date, l.review_answer_timestamp) as dias_ate_resposta "
        "from reviews as r join latest as l on l.review_id = r.review_id and l.place = 1",
        "reviews", latest=LATEST_REVIEW,
    ),
    "fact_order_event": query(EVENT_FACT, "happenings", latest=LATEST_SNAPSHOT),
    "agg_order_event_hourly": query(
        "select date_trunc('hour', event_timestamp) as hora, event_type, product_category_name, count(*) as eventos, "
        "count(distinct order_hk) as pedidos_distintos, count(distinct customer_hk) as clientes_distintos, "
        "cast(sum(cast(valor_total_evento as decimal(18,2))) as double) as valor_total, "
        "cast(sum(cast(valor_total_evento as decimal(18,2))) as double) / count(valor_total_evento) as ticket_medio "
        "from fact where event_timestamp is not null group by 1, 2, 3",
        "happenings", latest=LATEST_SNAPSHOT, fact=EVENT_FACT,
    ),
    "views_as_tables": query(count_rows(VIEW_COUNTS, label="view_name"), *VIEW_NEEDS, **VIEW_PARTS),
    "lasting_views": query(
        f"select *, cast(0 as bigint) as differing_rows from ({count_rows(VIEW_COUNTS, label='view_name')})", *VIEW_NEEDS, **VIEW_PARTS
    ),
    "receita_por_categoria": query(
        "select coalesce(product_category_name_english, p.product_category_name) as categoria, "
        "count(distinct order_id) as pedidos, count(*) as itens, cast(sum(cast(price as decimal(18,2))) as double) as receita, "
        "cast(sum(cast(freight_value as decimal(18,2))) as double) as frete, "
        "cast(sum(cast(price as decimal(18,2))) as double) / count(price) as preco_medio_item "
        "from sold join products as p using (product_id) "
        "left join translation as t on t.product_category_name = p.product_category_name "
        "group by 1 order by receita desc, categoria limit 20",
        "sold", "products", "translation",
    ),
    "ticket_medio_por_estado": query(
        "select customer_state as estado, count(*) as pedidos, cast(sum(valor) as double) as receita, "
        "cast(sum(valor) as double) / count(valor) as ticket_medio, cast(quantile_disc(valor, 0.5) as double) as ticket_mediano "
        "from purchases join order_value using (order_id) join customers using (customer_id) "
        "where customer_state is not null group by 1",
        "purchases", "sold", "customers", order_value=ITEM_VALUE,
    ),
    "prazo_de_entrega_por_estado": query(
        "select customer_state as estado, count(*) as pedidos_entregues, "
        "cast(sum(entrega) as double) / count(entrega) as dias_medios_ate_entrega, "
        "cast(sum(atraso) as double) / count(atraso) as dias_medios_de_atraso, "
        "cast(sum(case when atraso > 0 then 1 else 0 end) as bigint) as entregas_atrasadas, "
        "cast(sum(case when atraso > 0 then 1 else 0 end) as double) / count(*) as taxa_de_atraso "
        "from delivered join customers using (customer_id) group by 1",
        "purchases", "customers",
        delivered="select customer_id, date_sub('day', order_purchase_timestamp, order_delivered_customer_date) as entrega, "
        "date_sub('day', order_estimated_delivery_date, order_delivered_customer_date) as atraso from purchases "
        "where order_status = 'delivered' and order_delivered_customer_date is not null",
    ),
    "funil_de_eventos": query(
        "select event_type as estagio, count(distinct order_id) as pedidos, "
        "cast(count(distinct order_id) as double) / max(count(distinct order_id)) over () as conversao_do_topo "
        "from happenings group by 1",
        "happenings",
    ),
    "raw_batch_roundtrip": query(
        f"select order_id, customer_id, {', '.join(STATUS)}, date '2024-02-01' as raw_partition_date, "
        f"'{batch('orders')}' as record_source from purchases",
        "purchases",
    ),
    "raw_lines_roundtrip": query(
        f"select {', '.join(ITEM)}, {', '.join(PRICING)}, '2024' as raw_year, '02' as raw_month, '01' as raw_day, date '2024-02-01' as raw_partition_date, "
        f"'{batch('order_items')}' as record_source from items",
        "items",
    ),
    "raw_event_roundtrip": query(
        f"select event_id, event_type, event_timestamp, customer_unique_id, {', '.join(HOT_PROFILE)}, order_id, "
        f"{', '.join(SNAPSHOT)}, payment_type, payment_installments, date '2024-02-01' as raw_partition_date, "
        f"'{EVENTS}' as record_source from happenings",
        "happenings",
    ),
    "raw_quarantine": query(
        "select case when event_type = 'order_delivered' then 'unreadable' else 'read' end as outcome, count(*) as events "
        "from happenings group by 1",
        "happenings",
    ),
    "csv_load": query(
        count_rows(ROW_COUNTS | {"letters in review messages": "select sum(length(review_comment_message)) from reviews"}),
        *COUNTED.values(),
    ),
    "load_summary": query(count_rows(ROW_COUNTS), *COUNTED.values()),
    "extract_pk_page": query(
        "select * from customers where customer_id > 'A1200' order by customer_id limit 500", "customers"
    ),
    "extract_ts_page": query(
        "select * from purchases where (order_purchase_timestamp, order_id) > (timestamp '1996-06-30', 'O5000') "
        "order by order_purchase_timestamp, order_id limit 500",
        "purchases",
    ),
    "extract_resume": query(
        "select 1 as run, 700 as landed_rows, order_purchase_timestamp as mark_at, order_id as mark_id from placed where place = 700 "
        "union all select 2, 300, order_purchase_timestamp, order_id from placed where place = 1000 "
        "union all select 3, (select count(*) from placed) - 1000, order_purchase_timestamp, order_id from placed "
        "where place = (select count(*) from placed) "
        "union all select 4, 0, order_purchase_timestamp, order_id from placed where place = (select count(*) from placed)",
        "purchases",
        placed="select *, row_number() over (order by order_purchase_timestamp, order_id) as place from purchases",
    ),
    "extract_changes": query(
        "select * replace (1 as product_photos_qty) from products where product_photos_qty = 0", "products"
    ),
    "bootstrap_if_empty": query(
        "select *, cast(0 as bigint) as second_rows from (" + count_rows(ROW_COUNTS, "dataset", "first_rows") + ")",
        *COUNTED.values(),
    ),
    "landing_idempotent": query(
        "select event_id, event_type, event_timestamp, order_id, price, date '2024-02-01' as raw_partition_date "
        "from happenings where event_type <> 'order_delivered'",
        "happenings",
    ),
    "landing_restart": query(
        "select event_id, case when cast(event_id as bigint) % 10 < 6 then date '2024-02-01' else date '2024-02-02' end "
        "as raw_partition_date from happenings where event_type <> 'order_delivered'",
        "happenings",
    ),
    "extract_then_load": query(
        "select dataset, landed_rows, landed_rows as loaded_rows from (" + count_rows(ROW_COUNTS, "dataset", "landed_rows") + ")",
        *COUNTED.values(),
    ),
    "late_events_any_cut": history(
        "happenings", "order_hk", ["order_id"], SNAPSHOT, EVENTS, EVENT_SEQ, keep=["order_hk", "hashdiff", "seq_at"]
    ),
    "load_incremental": query(
        "select table_name, row_count as keys, cast(0 as bigint) as differing_rows from (" + count_rows(KEY_COUNTS) + ")", *COUNTED.values()
    ),
    "centroid_incremental": query(
        CENTROID.format(points="moved"),
        "points",
        moved="select geolocation_id, case when geolocation_id % 5 = 0 then concat(zip, '-B') else zip end as zip, "
        "case when geolocation_id % 3 = 0 and geolocation_id % 5 <> 0 then lat + 1 else lat end as lat, lng, "
        "case when geolocation_id % 5 = 0 then 'new' else city end as city, state from points "
        "union all select geolocation_id + 10000000, zip, lat, lng, city, state from points where geolocation_id % 7 = 0",
    ),
    "bootstrap_after_dead_write": query(
        "select dataset, landed_rows, cast(0 as bigint) as second_rows, "
        "case when dataset in ('customers', 'orders', 'sellers') then landed_rows end as loaded_rows from ("
        + count_rows(ROW_COUNTS, "dataset", "landed_rows") + ")",
        *COUNTED.values(),
    ),
    "landing_after_dead_write": query(
        "select event_id, date '2024-02-01' as raw_partition_date from happenings where event_type <> 'order_delivered'", "happenings"
    ),
    "hubs_two_writers": query("select order_id from purchases union select order_id from happenings", "purchases", "happenings"),
    "lost_amounts": query(
        "select 'price' as column_name, count(*) filter (where price < 0.05) as lost_rows from happenings "
        "union all select 'freight_value', cast(0 as bigint)",
        "happenings",
    ),
    "contract_violations": contract_sql(),
    "contract_requests": query(
        "select request, count(*) as events, case when bool_or(cheap) or count(*) > 500 then count(*) else 0 end "
        "as rejected_events, case when count(*) > 500 then count(*) else count(*) filter (where cheap) end as own_violations "
        "from asked group by request",
        "happenings",
        asked="select case when day(event_timestamp) = 1 then null when event_type = 'order_shipped' then event_type "
        "else concat(event_type, '/', cast(cast(event_timestamp as date) as varchar)) end as request, price < 0.05 as cheap "
        "from happenings",
    ),
    "quarantine_counts": query(
        "select 'quarantined' as stage, 1 as attempt, count(*) as messages from happenings where event_type = 'order_delivered' "
        "union all select 'given up', 4, count(*) from happenings where event_type = 'order_delivered' "
        "union all select 'accepted', 0, count(*) from happenings where event_type <> 'order_delivered'",
        "happenings",
    ),
    "stream_vault": query(
        f"select {sha('event_id')} as event_hk, event_id, event_type, event_timestamp, date '2024-02-01' as raw_partition_date, "
        f"{sha('event_id', 'order_id')} as link_event_order_hk, {sha('order_id')} as order_hk, payment_type, payment_installments "
        "from happenings",
        "happenings",
    ),
    "stream_dedup": query("select event_id as message_id, event_timestamp as sent_at from happenings", "happenings"),
    "stream_hourly": query(
        "select date_trunc('hour', event_timestamp) as hora, kind as event_type, product_category_name, count(*) as eventos, "
        "cast(sum(cast(price as decimal(18,2)) + cast(freight_value as decimal(18,2))) as double) as valor_total, "
        "true as orders_near, true as customers_near "
        "from (select *, event_type as kind from happenings union all select *, concat(event_type, '_again') from happenings) group by 1, 2, 3",
        "happenings",
    ),
    "stream_lost_rows": query(
        "select case event_type when 'order_delivered' then 'unreadable' when 'order_invoiced' then 'no event id' else 'taken in' end as reason, "
        "count(*) as events from happenings group by 1",
        "happenings",
    ),
    "pk_violations": query(
        "select order_id, order_item_id, count(*) as copies from items group by 1, 2 having count(*) > 1", "items"
    ),
    "fk_orphans": orphan_sql(),
    "event_order_orphans": query(
        "select order_id as missing_key, count(*) as child_rows from happenings "
        "where order_id not in (select order_id from purchases) group by 1",
        "happenings", "purchases",
    ),
    "not_null_report": null_sql(),
    "pipeline_health": query(
        "select date_trunc('hour', handled) as hora, count(*) as eventos, count(*) filter (where bad) as rejeitados, "
        "max(delay) as maior_atraso_segundos, max(delay) > 900 or count(*) filter (where bad) > 0 as alarme from handled_events group by 1",
        "keyed_events",
        handled_events="select ts + to_seconds(k * 20) as handled, value < 5 as bad, cast(k * 20 as bigint) as delay from keyed_events",
    ),
    "run_isolated": query(
        "select 'sellers' as dataset, 'hub_seller' as table_name, n as staged_rows, n as appended_rows, 'ok' as status "
        "from (select count(*) as n from sellers) "
        "union all select 'sellers', 'sat_seller_profile', n, n, 'ok' from (select count(*) as n from sellers) "
        "union all select 'products', null, 0, 0, 'failed' "
        "union all select 'order_items', 'link_order_item', n, "
        f"({DISTINCT_ITEMS.format('items')}), 'ok' from (select count(*) as n from items) "
        "union all select 'order_items', 'sat_order_item_pricing', n, "
        f"({history_count('items', ITEM, PRICING, 'seq_at, seq_tie')}), 'ok' from (select count(*) as n from items)",
        "sellers", "items",
    ),
}
