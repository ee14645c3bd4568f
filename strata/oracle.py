"""Equivalent DuckDB SQL for every registered query (the correctness oracle).

The SQL restates the original semantics directly (joins before grouping,
the marts' own dedupes kept), so it checks the Spark plans without repeating
them. Money is rounded from the decimal text of each double, not by the chain
that Spark runs. One choice is shared: rows are filtered before they are
deduplicated, where the original dedupes first and keeps an arbitrary row; for
a key with a valid row both may keep a valid one, but row counts can differ. Pinned parameters (load timestamp, as-of
date) are the ones the registered queries use.

Both engines are given the same total order for "keep one row per key":
every business column ascending, NULLS LAST spelled out (Spark sorts nulls
first by default, DuckDB last).
"""

from __future__ import annotations

from strata.config import CURATED_PREFIX, PINNED, PROCESSED_PREFIX, RAW_RECORD_SOURCE
from strata.plans.process import ORDER_TIMESTAMPS
from strata.sources import star_views as sv
from strata.specs import ENTITIES, LINEAGE_COLUMNS

LOAD_TS = f"TIMESTAMP '{PINNED.load_ts:%Y-%m-%d %H:%M:%S}'"
AS_OF = f"DATE '{PINNED.as_of:%Y-%m-%d}'"


def _lineage(source: str) -> str:
    return f"'{source}' AS record_source, {LOAD_TS} AS load_timestamp"


def _first_per_key(src: str, keys, cols) -> str:
    order = ", ".join(f"{c} ASC NULLS LAST" for c in cols
                      if c not in keys and c not in LINEAGE_COLUMNS)
    return (f"SELECT * FROM {src} QUALIFY row_number() OVER "
            f"(PARTITION BY {', '.join(keys)} ORDER BY {order}) = 1")


def _txt(expr: str) -> str:
    return f"CAST({expr} AS VARCHAR)"


def sql_money(expr: str) -> str:
    """Half-up to cents from the shortest decimal text; what has no such decimal (NaN, infinite, huge) stays."""
    return (f"COALESCE(CAST(round(TRY_CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,17)), 2) AS DOUBLE), {expr})")


def sql_money_sum(expr: str) -> str:
    """Exact where all values are finite; NaN and infinities show as in a plain sum."""
    return (f"CASE WHEN count(*) FILTER (WHERE NOT isfinite({expr})) > 0 THEN sum({expr}) "
            f"ELSE CAST(sum(TRY_CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,2))) AS DOUBLE) END")


def sql_money_avg(expr: str) -> str:
    return f"({sql_money_sum(expr)}) / NULLIF(CAST(count({expr}) AS DOUBLE), 0)"


def sql_int_avg(expr: str) -> str:
    return (f"CAST(sum(CAST({expr} AS BIGINT)) AS DOUBLE) / "
            f"NULLIF(CAST(count({expr}) AS DOUBLE), 0)")


def _date_parts(ts: str, prefix: str) -> str:
    return (f"CAST({ts} AS DATE) AS {prefix}_date, "
            f"CAST(year({ts}) AS INTEGER) AS {prefix}_year, "
            f"CAST(month({ts}) AS INTEGER) AS {prefix}_month")


# --------------------------------------------------------------------------
# Raw views (same derivation and dirt rules as strata.sources.star_views)
# --------------------------------------------------------------------------
_GEO = ("(SELECT n_nationkey, n_name, r_name FROM nation "
        "LEFT JOIN region ON n_regionkey = r_regionkey)")


def _shift(days: int) -> str:
    return _txt(f"o_orderdate + INTERVAL {days} DAY")


RAW = {
    "orders": f"""
SELECT {_txt('o_orderkey')} AS order_id,
       {_txt('o_custkey')} AS customer_id,
       CASE WHEN o_orderkey % {sv.DIRT_BLANK_STATUS_MOD} = 0 THEN '  ' ELSE o_orderstatus END AS order_status,
       CASE WHEN o_orderkey % {sv.DIRT_BAD_TS_MOD} = 0 THEN 'not-a-date' ELSE {_txt('o_orderdate')} END
           AS order_purchase_timestamp,
       {_shift(sv.APPROVED_DAYS)} AS order_approved_at,
       {_shift(sv.CARRIER_DAYS)} AS order_delivered_carrier_date,
       {_shift(sv.DELIVERED_DAYS)} AS order_delivered_customer_date,
       {_shift(sv.ESTIMATED_DAYS)} AS order_estimated_delivery_date
FROM orders""",
    "order_items": f"""
SELECT {_txt('l_orderkey')} AS order_id,
       {_txt('l_linenumber')} AS order_item_id,
       CASE WHEN l_partkey % {sv.DIRT_NULL_PRODUCT_MOD} = 0 THEN NULL ELSE {_txt('l_partkey')} END AS product_id,
       {_txt('l_suppkey')} AS seller_id,
       {_txt('l_shipdate')} AS shipping_limit_date,
       CASE WHEN l_partkey % {sv.DIRT_NEGATIVE_PRICE_MOD} = 0
            THEN {_txt('-CAST(l_extendedprice AS DECIMAL(18,2))')}
            WHEN l_partkey % {sv.DIRT_NAN_PRICE_MOD} = 0 THEN 'NaN'
            WHEN l_partkey % {sv.DIRT_INFINITE_PRICE_MOD} = 0 THEN 'Infinity'
            WHEN l_partkey % {sv.DIRT_LARGE_PRICE_MOD} = 0 THEN '{sv.LARGE_PRICE}'
            WHEN l_partkey % {sv.DIRT_SUB_CENT_MOD} = 0
            THEN {_txt('CAST(l_extendedprice AS DECIMAL(18,2))')} || '{sv.SUB_CENT}'
            ELSE {_txt('CAST(l_extendedprice AS DECIMAL(18,2))')} END AS price,
       {_txt('CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(8,2))')} AS freight_value
FROM lineitem""",
    "customers": f"""
SELECT {_txt('c_custkey')} AS customer_id,
       CASE WHEN c_custkey % {sv.DIRT_NULL_UNIQUE_ID_MOD} = 0 THEN NULL ELSE c_name END AS customer_unique_id,
       lpad({_txt('c_nationkey')}, 5, '0') AS customer_zip_code_prefix,
       CASE WHEN c_custkey % {sv.DIRT_PADDED_CITY_MOD} = 0 THEN ' ' || n_name || ' ' ELSE n_name END
           AS customer_city,
       r_name AS customer_state
FROM customer LEFT JOIN {_GEO} g ON c_nationkey = g.n_nationkey""",
    "products": f"""
SELECT {_txt('p_partkey')} AS product_id,
       p_type AS product_category_name,
       {_txt('length(p_name)')} AS product_name_lenght,
       {_txt('length(p_brand)')} AS product_description_lenght,
       {_txt('p_size % 5')} AS product_photos_qty,
       {_txt('p_size * 10')} AS product_weight_g,
       {_txt('p_size + 1')} AS product_length_cm,
       {_txt('p_size + 2')} AS product_height_cm,
       {_txt('p_size + 3')} AS product_width_cm
FROM part""",
    "sellers": f"""
SELECT * FROM (
  SELECT {_txt('s_suppkey')} AS seller_id, lpad({_txt('s_nationkey')}, 5, '0') AS seller_zip_code_prefix,
         n_name AS seller_city, r_name AS seller_state
  FROM supplier LEFT JOIN {_GEO} g ON s_nationkey = g.n_nationkey)
UNION ALL
SELECT {_txt('s_suppkey')}, lpad({_txt('s_nationkey')}, 5, '0'), 'DUP', r_name
FROM supplier LEFT JOIN {_GEO} g ON s_nationkey = g.n_nationkey
WHERE s_suppkey % {sv.DIRT_DUP_SELLER_MOD} = 0""",
    "payments": f"""
SELECT {_txt('event_id // 2')} AS order_id,
       {_txt('event_id % 2 + 1')} AS payment_sequential,
       CASE WHEN event_id % {sv.DIRT_NULL_PAYMENT_TYPE_MOD} = 0 THEN NULL ELSE event_type END AS payment_type,
       {_txt('event_id % 12 + 1')} AS payment_installments,
       CASE WHEN event_id % {sv.DIRT_NAN_PRICE_MOD} = 0 THEN 'NaN'
            WHEN event_id % {sv.DIRT_SUB_CENT_MOD} = 0 THEN {_txt('CAST(value AS DECIMAL(18,2))')} || '{sv.SUB_CENT}'
            ELSE {_txt('CAST(value AS DECIMAL(18,2))')} END AS payment_value
FROM events""",
    "reviews": f"""
SELECT {_txt('event_id')} AS review_id,
       {_txt('event_id // 2')} AS order_id,
       CASE WHEN event_id % {sv.DIRT_BAD_SCORE_MOD} = 0 THEN 'x'
            ELSE {_txt('CAST(floor(value) AS BIGINT) % 7')} END AS review_score,
       event_type AS review_comment_title,
       CASE WHEN event_id % {sv.DIRT_MULTILINE_MOD} = 0
            THEN props || chr(10) || 'second line, with "quotes"' || chr(10) || chr(10) || '"end"'
            ELSE props END AS review_comment_message,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS review_creation_date,
       strftime(ts + INTERVAL {sv.REVIEW_ANSWER_DAYS} DAY, '%Y-%m-%d %H:%M:%S') AS review_answer_timestamp
FROM events""",
    "category_translation": """
SELECT p_type AS product_category_name, lower(p_type) AS product_category_name_english
FROM part""",
    "geolocation": f"""
SELECT lpad({_txt('c_nationkey')}, 5, '0') AS geolocation_zip_code_prefix,
       {_txt('c_nationkey - 12')} AS geolocation_lat,
       {_txt('c_nationkey * 5 - 60')} AS geolocation_lng,
       n_name AS geolocation_city,
       r_name AS geolocation_state
FROM customer LEFT JOIN {_GEO} g ON c_nationkey = g.n_nationkey""",
}

# --------------------------------------------------------------------------
# Process layer
# --------------------------------------------------------------------------
ORDERS_PROCESSED_COLS = (*ENTITIES["orders"].columns, "order_purchase_date",
                         "order_purchase_year", "order_purchase_month")
PROCESSED_COLS = {
    "orders": ORDERS_PROCESSED_COLS,
    **{n: ENTITIES[n].columns for n in ENTITIES if n != "orders"},
}
CURATED_COLS = dict(PROCESSED_COLS)

_SRC = _lineage(RAW_RECORD_SOURCE)

_PROC_BODY = {
    "orders": (
        "SELECT *, " + _date_parts("order_purchase_timestamp", "order_purchase") + f", {_SRC} FROM ("
        "SELECT order_id, customer_id, order_status, "
        + ", ".join(f"TRY_CAST({c} AS TIMESTAMP) AS {c}" for c in ORDER_TIMESTAMPS)
        + " FROM raw_orders) "
        "WHERE order_id IS NOT NULL AND customer_id IS NOT NULL "
        "AND order_purchase_timestamp IS NOT NULL"),
    "order_items": (
        "SELECT order_id, TRY_CAST(order_item_id AS INTEGER) AS order_item_id, product_id, seller_id, "
        "TRY_CAST(shipping_limit_date AS TIMESTAMP) AS shipping_limit_date, "
        "TRY_CAST(price AS DOUBLE) AS price, TRY_CAST(freight_value AS DOUBLE) AS freight_value, "
        f"{_SRC} FROM raw_order_items "
        "WHERE order_id IS NOT NULL AND TRY_CAST(order_item_id AS INTEGER) IS NOT NULL "
        "AND product_id IS NOT NULL AND seller_id IS NOT NULL "
        "AND TRY_CAST(price AS DOUBLE) >= 0 AND TRY_CAST(freight_value AS DOUBLE) >= 0"),
    "customers": (f"SELECT *, {_SRC} FROM raw_customers "
                  "WHERE customer_id IS NOT NULL AND customer_unique_id IS NOT NULL"),
    "products": f"SELECT *, {_SRC} FROM raw_products WHERE product_id IS NOT NULL",
    "sellers": f"SELECT *, {_SRC} FROM raw_sellers WHERE seller_id IS NOT NULL",
    "payments": (
        "SELECT order_id, payment_sequential, payment_type, payment_installments, "
        f"TRY_CAST(payment_value AS DOUBLE) AS payment_value, {_SRC} "
        "FROM raw_payments WHERE order_id IS NOT NULL"),
    "reviews": (
        "SELECT review_id, order_id, TRY_CAST(review_score AS INTEGER) AS review_score, "
        "review_comment_title, review_comment_message, review_creation_date, review_answer_timestamp, "
        f"{_SRC} FROM raw_reviews WHERE TRY_CAST(review_score AS INTEGER) BETWEEN 1 AND 5"),
    "category_translation": "SELECT * FROM raw_category_translation",
    "geolocation": "SELECT * FROM raw_geolocation",
}


def _proc(name: str) -> str:
    return _first_per_key(f"({_PROC_BODY[name]})", ENTITIES[name].key, PROCESSED_COLS[name])


# --------------------------------------------------------------------------
# Curated layer
# --------------------------------------------------------------------------
def _trims(*cols: str) -> str:
    return ", ".join(f"trim({_txt(c)}) AS {c}" for c in cols)


def _cur_lineage(table: str) -> str:
    return _lineage(f"{PROCESSED_PREFIX}.{table}")


_CUR_BODY = {
    "orders": (
        f"SELECT {_trims('order_id', 'customer_id', 'order_status')}, "
        + ", ".join(ORDER_TIMESTAMPS) + ", "
        + _date_parts("order_purchase_timestamp", "order_purchase") + ", "
        + _cur_lineage("orders") + " FROM proc_orders"),
    "order_items": (
        f"SELECT {_trims('order_id', 'order_item_id', 'product_id', 'seller_id')}, shipping_limit_date, "
        f"{sql_money('price')} AS price, {sql_money('freight_value')} AS freight_value, "
        + _cur_lineage("order_items") + " FROM proc_order_items"),
    "customers": (f"SELECT {_trims(*ENTITIES['customers'].columns)}, {_cur_lineage('customers')} "
                  "FROM proc_customers"),
    "products": (
        f"SELECT {_trims('product_id', 'product_category_name')}, "
        + ", ".join(ENTITIES["products"].columns[2:]) + f", {_cur_lineage('products')} FROM proc_products"),
    "sellers": f"SELECT {_trims(*ENTITIES['sellers'].columns)}, {_cur_lineage('sellers')} FROM proc_sellers",
    "payments": (
        f"SELECT {_trims('order_id', 'payment_sequential', 'payment_type', 'payment_installments')}, "
        f"{sql_money('payment_value')} AS payment_value, {_cur_lineage('payments')} FROM proc_payments"),
    "reviews": (
        f"SELECT {_trims('review_id', 'order_id')}, review_score, review_comment_title, "
        "review_comment_message, TRY_CAST(review_creation_date AS TIMESTAMP) AS review_creation_date, "
        "TRY_CAST(review_answer_timestamp AS TIMESTAMP) AS review_answer_timestamp, "
        f"{_cur_lineage('reviews')} FROM proc_reviews"),
    "category_translation": (
        f"SELECT {_trims(*ENTITIES['category_translation'].columns)}, "
        f"{_cur_lineage('category_translation')} FROM proc_category_translation"),
    "geolocation": (
        f"SELECT {_trims('geolocation_zip_code_prefix')}, geolocation_lat, geolocation_lng, "
        f"{_trims('geolocation_city', 'geolocation_state')}, {_cur_lineage('geolocation')} "
        "FROM proc_geolocation"),
}
_CUR_FILTER = {
    "orders": ("order_id IS NOT NULL AND customer_id IS NOT NULL AND order_purchase_timestamp IS NOT NULL "
               "AND order_status IS NOT NULL AND order_status <> ''"),
    "order_items": ("order_id IS NOT NULL AND order_item_id IS NOT NULL AND product_id IS NOT NULL "
                    "AND seller_id IS NOT NULL"),
    "customers": "customer_id IS NOT NULL",
    "products": "product_id IS NOT NULL",
    "sellers": "seller_id IS NOT NULL",
    "payments": "order_id IS NOT NULL AND payment_type IS NOT NULL",
    "reviews": "review_id IS NOT NULL AND order_id IS NOT NULL AND review_score IS NOT NULL",
    "category_translation": "product_category_name IS NOT NULL",
    "geolocation": "geolocation_zip_code_prefix IS NOT NULL",
}


def _cur(name: str) -> str:
    body = f"(SELECT * FROM ({_CUR_BODY[name]}) WHERE {_CUR_FILTER[name]})"
    return _first_per_key(body, ENTITIES[name].key, CURATED_COLS[name])


# --------------------------------------------------------------------------
# Common table expressions, in dependency order
# --------------------------------------------------------------------------
CTES: dict[str, str] = {}
for _n in ENTITIES:
    CTES[f"raw_{_n}"] = RAW[_n]
for _n in ENTITIES:
    CTES[f"proc_{_n}"] = _proc(_n)
for _n in ENTITIES:
    CTES[f"cur_{_n}"] = _cur(_n)


def _mart_lineage(mart: str) -> str:
    return _lineage(f"{CURATED_PREFIX}.{mart}")


CTES["mart_seller_performance"] = f"""
WITH o AS (SELECT * FROM (SELECT trim(order_id) AS order_id, order_purchase_timestamp FROM cur_orders)
           QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY order_purchase_timestamp) = 1),
     i AS (SELECT * FROM (SELECT trim(order_id) AS order_id, trim(order_item_id) AS order_item_id,
                                 trim(seller_id) AS seller_id, price, freight_value FROM cur_order_items)
           QUALIFY row_number() OVER (PARTITION BY order_id, order_item_id
                                      ORDER BY seller_id, price, freight_value) = 1),
     s AS (SELECT * FROM (SELECT trim(seller_id) AS seller_id, trim(seller_city) AS seller_city,
                                 trim(seller_state) AS seller_state FROM cur_sellers)
           QUALIFY row_number() OVER (PARTITION BY seller_id ORDER BY seller_city, seller_state) = 1),
     r AS (SELECT order_id, review_score FROM (
             SELECT trim(order_id) AS order_id, review_score, review_answer_timestamp,
                    trim(review_id) AS review_id FROM cur_reviews)
           QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY review_answer_timestamp DESC NULLS LAST,
                                      review_id DESC NULLS LAST, review_score ASC NULLS LAST) = 1)
SELECT seller_id, seller_city, seller_state,
       count(DISTINCT order_id) AS total_orders,
       count(DISTINCT order_item_id) AS total_order_items,
       {sql_money_sum('price')} AS total_revenue,
       {sql_money_avg('price')} AS avg_item_price,
       {sql_money_avg('freight_value')} AS avg_freight_value,
       {sql_int_avg('review_score')} AS avg_review_score,
       min(CAST(order_purchase_timestamp AS DATE)) AS min_order_date,
       max(CAST(order_purchase_timestamp AS DATE)) AS max_order_date,
       {_mart_lineage('seller_performance')}
FROM i LEFT JOIN o USING (order_id) LEFT JOIN s USING (seller_id) LEFT JOIN r USING (order_id)
GROUP BY seller_id, seller_city, seller_state"""

CTES["mart_customer_rfm"] = f"""
WITH o AS (SELECT * FROM (SELECT trim(order_id) AS order_id, trim(customer_id) AS customer_id,
                                 order_purchase_date FROM cur_orders)
           WHERE order_id IS NOT NULL AND customer_id IS NOT NULL
           QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY customer_id, order_purchase_date) = 1),
     t AS (SELECT order_id, {sql_money_sum('price')} AS order_value FROM (
             SELECT trim(order_id) AS order_id, trim(order_item_id) AS order_item_id, price FROM cur_order_items)
           WHERE order_id IS NOT NULL AND order_item_id IS NOT NULL GROUP BY order_id),
     c AS (SELECT * FROM (SELECT trim(customer_id) AS customer_id, trim(customer_unique_id) AS customer_unique_id,
                                 trim(customer_city) AS customer_city, trim(customer_state) AS customer_state
                          FROM cur_customers)
           WHERE customer_id IS NOT NULL
           QUALIFY row_number() OVER (PARTITION BY customer_id
                                      ORDER BY customer_unique_id, customer_city, customer_state) = 1)
SELECT customer_id, customer_unique_id, customer_city, customer_state,
       count(DISTINCT order_id) AS frequency_orders,
       {sql_money_sum('order_value')} AS monetary_value,
       {sql_money_avg('order_value')} AS avg_order_value,
       min(CAST(order_purchase_date AS DATE)) AS first_order_date,
       max(CAST(order_purchase_date AS DATE)) AS last_order_date,
       CAST(date_diff('day', max(CAST(order_purchase_date AS DATE)), {AS_OF}) AS INTEGER) AS recency_days,
       {_mart_lineage('customer_rfm')}
FROM o LEFT JOIN t USING (order_id) LEFT JOIN c USING (customer_id)
GROUP BY customer_id, customer_unique_id, customer_city, customer_state"""

CTES["mart_daily_sales"] = f"""
WITH o AS (SELECT * FROM (SELECT trim(order_id) AS order_id, CAST(order_purchase_date AS DATE) AS order_date,
                                 trim(customer_id) AS customer_id FROM cur_orders)
           WHERE order_id IS NOT NULL
           QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY order_date, customer_id) = 1),
     i AS (SELECT * FROM (SELECT trim(order_id) AS order_id, trim(order_item_id) AS order_item_id, price
                          FROM cur_order_items) WHERE order_id IS NOT NULL)
SELECT order_date,
       count(DISTINCT order_id) AS total_orders,
       count(DISTINCT customer_id) AS total_customers,
       count(DISTINCT order_item_id) AS total_items,
       {sql_money_sum('price')} AS total_revenue,
       {sql_money_avg('price')} AS avg_item_price,
       {_mart_lineage('daily_sales_mart')}
FROM o JOIN i USING (order_id)
GROUP BY order_date"""


def with_ctes(select: str) -> str:
    """Prefix a final SELECT with every layer CTE (DuckDB inlines the unused ones)."""
    body = ",\n".join(f"{name} AS ({sql})" for name, sql in CTES.items())
    return f"WITH {body}\n{select}"
