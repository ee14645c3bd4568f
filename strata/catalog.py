"""Registered queries: one per inventory row of the survey, each with its
DuckDB oracle SQL.

Every query reads the given star tables through the raw views (so its work
grows with the data) and runs over whole tables. Column names are aliased
identically on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.config import PINNED, RunConfig
from strata.functions.scalars import (date_parts, lineage, money_avg, money_merge, money_parts, money_sum,
                                      money_total, recency_days, round_money, safe_cast, trim_text)
from strata.operators import distinct, quality
from strata.operators.dedupe import keep_first
from strata.operators.joins import split_join
from strata.operators.filters import in_range, non_negative, not_blank, not_null
from strata.oracle import AS_OF, LOAD_TS, sql_money, sql_money_avg, sql_money_sum, with_ctes
from strata.plans.curate import CURATE
from strata.plans.marts import (build_marts, customer_rfm, daily_sales, latest_review_per_order,
                                seller_performance)
from strata.plans.layered import RAW_CHECKS, write_layer
from strata.plans.process import PROCESS
from strata.session import scratch_folder, use_utc
from strata.sources.csv import read_raw_csv, write_raw_csv
from strata.sources.layers import ANALYTICS, CURATED, PROCESSED, LayerStore
from strata.sources.star_views import raw_view
from strata.specs import ENTITIES

Query = Callable[[SparkSession, str], DataFrame]
CFG: RunConfig = PINNED

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_ctes(sql)
        return fn
    return deco


# -- layer helpers ----------------------------------------------------------
def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    use_utc(spark)
    return raw_view(spark, sf_dir, name)


def processed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return PROCESS[name](raw(spark, sf_dir, name), CFG)


def curated(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return CURATE[name](processed(spark, sf_dir, name), CFG)


def _store(spark: SparkSession) -> LayerStore:
    """A fresh layer store in the shared folder (one per query call)."""
    return LayerStore(scratch_folder(spark, "layers", uuid.uuid4().hex))


def curated_tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """Curated tables written once to the shared folder and read back, as the
    marts read them in a pipeline run (a table feeding several consumers is
    computed once, and lineage is cut before the mart)."""
    return write_layer(spark, _store(spark).begin(spark), CURATED, {n: curated(spark, sf_dir, n) for n in names})


# -- I/O ---------------------------------------------------------------------
def _csv_roundtrip(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    entity = ENTITIES[name]
    path = scratch_folder(spark, "raw_drop", f"{name}-{uuid.uuid4().hex}")
    write_raw_csv(raw(spark, sf_dir, name), path, entity)
    return read_raw_csv(spark, path, entity)


register("src_csv_header", "SELECT * FROM raw_orders")(
    lambda spark, d: _csv_roundtrip(spark, d, "orders"))
register("src_csv_multiline", "SELECT * FROM raw_reviews")(
    lambda spark, d: _csv_roundtrip(spark, d, "reviews"))


@register("layer_roundtrip", "SELECT * FROM cur_orders")
def layer_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark)
    store.write(curated(spark, sf_dir, "orders"), CURATED, "orders")
    return store.read(spark, CURATED, "orders")


@register("sink_processed_order_items", "SELECT * FROM proc_order_items")
def sink_processed_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark)
    store.write(processed(spark, sf_dir, "order_items"), PROCESSED, "order_items")
    return store.read(spark, PROCESSED, "order_items")


@register("sink_mart_daily_sales", "SELECT * FROM mart_daily_sales")
def sink_mart_daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written twice: the second version replaces the first."""
    store, c = _store(spark), curated_tables(spark, sf_dir, "orders", "order_items")
    mart = daily_sales(c["orders"], c["order_items"], CFG)
    for df in (mart.where("total_orders > 1"), mart):
        store.write(df, ANALYTICS, "daily_sales_mart")
    return store.read(spark, ANALYTICS, "daily_sales_mart")


# -- process / curate ------------------------------------------------------------
for _name in ENTITIES:
    register(f"process_{_name}", f"SELECT * FROM proc_{_name}")(
        lambda spark, d, n=_name: processed(spark, d, n))
    register(f"curate_{_name}", f"SELECT * FROM cur_{_name}")(
        lambda spark, d, n=_name: curated(spark, d, n))


# -- marts -------------------------------------------------------------------
@register("mart_seller_performance", "SELECT * FROM mart_seller_performance")
def mart_seller_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = curated_tables(spark, sf_dir, "orders", "order_items", "sellers", "reviews")
    return seller_performance(c["orders"], c["order_items"], c["sellers"], c["reviews"], CFG)


@register("mart_customer_rfm", "SELECT * FROM mart_customer_rfm")
def mart_customer_rfm(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = curated_tables(spark, sf_dir, "orders", "order_items", "customers")
    return customer_rfm(c["orders"], c["order_items"], c["customers"], CFG)


@register("mart_daily_sales", "SELECT * FROM mart_daily_sales")
def mart_daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = curated_tables(spark, sf_dir, "orders", "order_items")
    return daily_sales(c["orders"], c["order_items"], CFG)


# -- data quality --------------------------------------------------------------
DQ_SPECS = RAW_CHECKS


def _dq_sql(table: str) -> str:
    spec = DQ_SPECS[table]
    key = spec["key"]
    parts = [f"SELECT '{table}' AS table_name, 'raw_rows' AS metric, count(*) AS value FROM raw_{table}"]
    for c in spec["nulls"]:
        parts.append(f"SELECT '{table}', 'null_{c}', count(*) FILTER (WHERE {c} IS NULL) FROM raw_{table}")
    for c in spec.get("negatives", ()):
        parts.append(f"SELECT '{table}', 'negative_{c}', "
                     f"count(*) FILTER (WHERE TRY_CAST({c} AS DOUBLE) < 0) FROM raw_{table}")
    if key:
        k = ", ".join(key)
        parts.append(f"SELECT '{table}', 'duplicate_key_groups', count(*) FROM "
                     f"(SELECT {k} FROM raw_{table} GROUP BY {k} HAVING count(*) > 1)")
    parts.append(f"SELECT '{table}', 'processed_rows', count(*) FROM proc_{table}")
    return "\nUNION ALL ".join(parts)


def _dq(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Raw profile (one grouped pass) plus the processed row count."""
    spec = DQ_SPECS[table]
    r = raw(spark, sf_dir, table)
    return quality.raw_profile(r, table, spec["key"], spec["nulls"], spec.get("negatives", ()),
                               processed=PROCESS[table](r, CFG))


for _t in DQ_SPECS:
    register(f"dq_{_t}", _dq_sql(_t))(lambda spark, d, t=_t: _dq(spark, d, t))


@register("dq_layer_counts", "\nUNION ALL ".join(
    f"SELECT '{n}' AS table_name, 'curated_input_rows' AS metric, count(*) AS value FROM proc_{n} "
    f"UNION ALL SELECT '{n}', 'curated_output_rows', count(*) FROM cur_{n}" for n in ENTITIES))
def dq_layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input and output rows of the curate step: the processed layer is
    written (it is the curate input), and the curated tables are counted
    straight from their plans over it (a count needs no second write)."""
    proc = write_layer(spark, _store(spark).begin(spark), PROCESSED,
                       {n: processed(spark, sf_dir, n) for n in ENTITIES})
    return quality.layer_counts({n: (proc[n], CURATE[n](proc[n], CFG)) for n in ENTITIES})


@register("dq_mart_counts", "\nUNION ALL ".join(
    f"SELECT '{m}' AS table_name, 'row_count' AS metric, count(*) AS value FROM {cte}"
    for m, cte in (("seller_performance", "mart_seller_performance"),
                   ("customer_rfm", "mart_customer_rfm"),
                   ("daily_sales_mart", "mart_daily_sales"))))
def dq_mart_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = curated_tables(spark, sf_dir, "orders", "order_items", "sellers", "reviews", "customers")
    return quality.row_counts(build_marts(c, CFG))


# -- dedupe ------------------------------------------------------------------
@register("dedupe_single_key",
          "SELECT * FROM raw_sellers QUALIFY row_number() OVER (PARTITION BY seller_id ORDER BY "
          "seller_zip_code_prefix ASC NULLS LAST, seller_city ASC NULLS LAST, "
          "seller_state ASC NULLS LAST) = 1")
def dedupe_single_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_first(raw(spark, sf_dir, "sellers"), ["seller_id"])


@register("dedupe_composite_key",
          "SELECT * FROM raw_order_items QUALIFY row_number() OVER (PARTITION BY order_id, order_item_id "
          "ORDER BY product_id ASC NULLS LAST, seller_id ASC NULLS LAST, shipping_limit_date ASC NULLS LAST, "
          "price ASC NULLS LAST, freight_value ASC NULLS LAST) = 1")
def dedupe_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_first(raw(spark, sf_dir, "order_items"), ["order_id", "order_item_id"])


@register("dedupe_before_join", """
SELECT o.order_id, o.customer_id, r.review_score
FROM cur_orders o LEFT JOIN (
  SELECT order_id, review_score FROM (
    SELECT trim(order_id) AS order_id, review_score, review_answer_timestamp, trim(review_id) AS review_id
    FROM cur_reviews)
  QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY review_answer_timestamp DESC NULLS LAST,
                             review_id DESC NULLS LAST, review_score ASC NULLS LAST) = 1) r
ON o.order_id = r.order_id""")
def dedupe_before_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = curated(spark, sf_dir, "orders").select("order_id", "customer_id")
    r = latest_review_per_order(curated(spark, sf_dir, "reviews"))
    return o.join(r, "order_id", "left").select("order_id", "customer_id", "review_score")


# -- joins -------------------------------------------------------------------
@register("join_left_chain", """
SELECT i.order_id, i.order_item_id, i.seller_id, i.price, o.order_purchase_timestamp,
       s.seller_city, s.seller_state, r.review_score
FROM cur_order_items i
LEFT JOIN cur_orders o ON i.order_id = o.order_id
LEFT JOIN cur_sellers s ON i.seller_id = s.seller_id
LEFT JOIN (SELECT order_id, review_score FROM cur_reviews
           QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY review_answer_timestamp DESC NULLS LAST,
                                      review_id DESC NULLS LAST, review_score ASC NULLS LAST) = 1) r
  ON i.order_id = r.order_id""")
def join_left_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = curated_tables(spark, sf_dir, "order_items", "orders", "sellers", "reviews")
    items = t["order_items"].select("order_id", "order_item_id", "seller_id", "price")
    o = t["orders"].select("order_id", "order_purchase_timestamp")
    s = t["sellers"].select("seller_id", "seller_city", "seller_state")
    # order attributes meet at order grain; items then join once per key, and a hot order or seller may be split
    o = o.join(latest_review_per_order(t["reviews"]), "order_id", "full_outer")
    return (split_join(split_join(items, o, "order_id", "left"), s, "seller_id", "left")
            .select("order_id", "order_item_id", "seller_id", "price", "order_purchase_timestamp",
                    "seller_city", "seller_state", "review_score"))


@register("join_left_preagg", f"""
SELECT o.order_id, o.customer_id, t.order_value,
       c.customer_unique_id, c.customer_city
FROM cur_orders o
LEFT JOIN (SELECT order_id, {sql_money_sum('price')} AS order_value
           FROM cur_order_items GROUP BY order_id) t ON o.order_id = t.order_id
LEFT JOIN cur_customers c ON o.customer_id = c.customer_id""")
def join_left_preagg(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = curated_tables(spark, sf_dir, "orders", "order_items", "customers")
    o = tables["orders"].select("order_id", "customer_id")
    t = tables["order_items"].groupBy("order_id").agg(money_sum("price").alias("order_value"))
    c = tables["customers"].select("customer_id", "customer_unique_id", "customer_city")
    return (split_join(o.join(t, "order_id", "left"), c, "customer_id", "left")
            .select("order_id", "customer_id", "order_value", "customer_unique_id", "customer_city"))


@register("join_inner", """
SELECT o.order_id, o.order_purchase_date AS order_date, o.customer_id, i.order_item_id, i.price
FROM cur_orders o JOIN cur_order_items i ON o.order_id = i.order_id""")
def join_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = curated_tables(spark, sf_dir, "orders", "order_items")
    o = t["orders"].select("order_id", F.col("order_purchase_date").alias("order_date"), "customer_id")
    i = t["order_items"].select("order_id", "order_item_id", "price")
    return split_join(o, i, "order_id")


# -- aggregates ----------------------------------------------------------------
@register("agg_having_duplicates", """
SELECT order_id, order_item_id, count(*) AS n_rows FROM raw_order_items
GROUP BY order_id, order_item_id HAVING count(*) > 1""")
def agg_having_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(raw(spark, sf_dir, "order_items"), ["order_id", "order_item_id"])


@register("agg_sum_avg", f"""
SELECT seller_id, {sql_money_sum('price')} AS total_revenue, {sql_money_avg('price')} AS avg_item_price,
       {sql_money_avg('freight_value')} AS avg_freight_value
FROM cur_order_items GROUP BY seller_id""")
def agg_sum_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curated(spark, sf_dir, "order_items").groupBy("seller_id").agg(
        money_sum("price").alias("total_revenue"),
        money_avg("price").alias("avg_item_price"),
        money_avg("freight_value").alias("avg_freight_value"))


@register("agg_min_max_date", """
SELECT customer_id, min(order_purchase_date) AS first_order_date, max(order_purchase_date) AS last_order_date
FROM cur_orders GROUP BY customer_id""")
def agg_min_max_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curated(spark, sf_dir, "orders").groupBy("customer_id").agg(
        F.min("order_purchase_date").alias("first_order_date"),
        F.max("order_purchase_date").alias("last_order_date"))


@register("agg_count_distinct", """
SELECT order_status, count(DISTINCT customer_id) AS n_customers, count(*) AS n_orders,
       min(order_purchase_date) AS first_order_date
FROM cur_orders GROUP BY order_status""")
def agg_count_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curated(spark, sf_dir, "orders").groupBy("order_status").agg(
        F.countDistinct("customer_id").alias("n_customers"),
        F.count(F.lit(1)).alias("n_orders"),
        F.min("order_purchase_date").alias("first_order_date"))


@register("agg_multi_distinct", f"""
SELECT seller_id, count(DISTINCT order_id) AS n_orders, count(DISTINCT order_item_id) AS n_line_positions,
       count(DISTINCT product_id) AS n_products, {sql_money_sum('price')} AS total_revenue
FROM cur_order_items GROUP BY seller_id""")
def agg_multi_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line positions merge as masks beside the sums, orders are the main rows of (seller, order); products
    are a two-column aggregate of their own. No Expand: items are not multiplied by the distinct counts."""
    items = curated_tables(spark, sf_dir, "order_items")["order_items"]
    per_order = distinct.with_slots(items, "order_item_id").groupBy("seller_id", "order_id", *distinct.KEYS).agg(
        *money_parts(distinct.measure("price"), "price"), distinct.merged())
    per_slot = per_order.groupBy("seller_id", *distinct.KEYS).agg(
        F.count(distinct.measure("order_id")).alias("n_orders"), *money_merge("price"), distinct.merged())
    per_seller = per_slot.groupBy("seller_id").agg(
        F.sum("n_orders").alias("n_orders"), distinct.total().alias("n_line_positions"),
        money_total("price").alias("total_revenue"))
    products = (items.groupBy("seller_id").agg(F.countDistinct("product_id").alias("n_products"))
                .withColumnRenamed("seller_id", "_seller"))
    return (per_seller.join(products, F.col("seller_id").eqNullSafe(F.col("_seller")))
            .select("seller_id", "n_orders", "n_line_positions", "n_products", "total_revenue"))


@register("agg_nullable_keys", """
SELECT product_id, seller_id, count(*) AS n_rows, count(DISTINCT order_id) AS n_orders
FROM raw_order_items GROUP BY product_id, seller_id""")
def agg_nullable_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir, "order_items").groupBy("product_id", "seller_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("order_id").alias("n_orders"))


# -- filters -------------------------------------------------------------------
@register("filter_not_null",
          "SELECT * FROM raw_customers WHERE customer_id IS NOT NULL AND customer_unique_id IS NOT NULL")
def filter_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir, "customers").filter(not_null("customer_id", "customer_unique_id"))


@register("filter_conjunction", """
SELECT order_id, TRY_CAST(order_item_id AS INTEGER) AS order_item_id, product_id, seller_id,
       TRY_CAST(price AS DOUBLE) AS price, TRY_CAST(freight_value AS DOUBLE) AS freight_value
FROM raw_order_items
WHERE order_id IS NOT NULL AND TRY_CAST(order_item_id AS INTEGER) IS NOT NULL AND product_id IS NOT NULL
  AND seller_id IS NOT NULL AND TRY_CAST(price AS DOUBLE) >= 0 AND TRY_CAST(freight_value AS DOUBLE) >= 0""")
def filter_conjunction(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = raw(spark, sf_dir, "order_items").select(
        "order_id", safe_cast("order_item_id", "int").alias("order_item_id"), "product_id", "seller_id",
        safe_cast("price", "double").alias("price"),
        safe_cast("freight_value", "double").alias("freight_value"))
    return df.filter(not_null("order_id", "order_item_id", "product_id", "seller_id")
                     & non_negative("price", "freight_value"))


@register("filter_between", """
SELECT review_id, order_id, TRY_CAST(review_score AS INTEGER) AS review_score FROM raw_reviews
WHERE TRY_CAST(review_score AS INTEGER) BETWEEN 1 AND 5""")
def filter_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = raw(spark, sf_dir, "reviews").select(
        "review_id", "order_id", safe_cast("review_score", "int").alias("review_score"))
    return df.filter(in_range("review_score", 1, 5))


@register("filter_not_blank", """
SELECT order_id, trim(order_status) AS order_status FROM raw_orders
WHERE trim(order_status) IS NOT NULL AND trim(order_status) <> ''""")
def filter_not_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = raw(spark, sf_dir, "orders").select("order_id", trim_text("order_status").alias("order_status"))
    return df.filter(not_blank("order_status"))


# -- scalars -------------------------------------------------------------------
@register("scalar_try_cast", """
SELECT review_id, TRY_CAST(review_score AS INTEGER) AS review_score,
       TRY_CAST(review_creation_date AS TIMESTAMP) AS review_creation_date,
       TRY_CAST(order_id AS BIGINT) AS order_key
FROM raw_reviews""")
def scalar_try_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir, "reviews").select(
        "review_id",
        safe_cast("review_score", "int").alias("review_score"),
        safe_cast("review_creation_date", "timestamp").alias("review_creation_date"),
        safe_cast("order_id", "bigint").alias("order_key"))


_PURCHASE_TS = "TRY_CAST(order_purchase_timestamp AS TIMESTAMP)"


@register("scalar_date_parts", f"""
SELECT order_id, CAST({_PURCHASE_TS} AS DATE) AS order_purchase_date,
       CAST(year({_PURCHASE_TS}) AS INTEGER) AS order_purchase_year,
       CAST(month({_PURCHASE_TS}) AS INTEGER) AS order_purchase_month
FROM raw_orders""")
def scalar_date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir, "orders").select(
        "order_id", *date_parts(safe_cast("order_purchase_timestamp", "timestamp"), "order_purchase"))


@register("scalar_datediff", f"""
SELECT order_id, CAST(date_diff('day', CAST({_PURCHASE_TS} AS DATE), {AS_OF}) AS INTEGER) AS recency_days
FROM raw_orders""")
def scalar_datediff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir, "orders").select(
        "order_id",
        recency_days(F.to_date(safe_cast("order_purchase_timestamp", "timestamp")), CFG)
        .alias("recency_days"))


@register("scalar_lineage", f"""
SELECT order_id, 'olist' AS record_source, {LOAD_TS} AS load_timestamp FROM raw_orders""")
def scalar_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir, "orders").select("order_id", *lineage(CFG.record_source, CFG))


@register("scalar_trim", """
SELECT customer_id, trim(customer_unique_id) AS customer_unique_id, trim(customer_city) AS customer_city,
       trim(customer_state) AS customer_state FROM raw_customers""")
def scalar_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir, "customers").select(
        "customer_id", *[trim_text(c).alias(c) for c in
                         ("customer_unique_id", "customer_city", "customer_state")])


@register("scalar_round_money", f"""
SELECT order_id, order_item_id, {sql_money('TRY_CAST(price AS DOUBLE)')} AS price,
       {sql_money('TRY_CAST(freight_value AS DOUBLE)')} AS freight_value FROM raw_order_items""")
def scalar_round_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir, "order_items").select(
        "order_id", "order_item_id",
        round_money(safe_cast("price", "double")).alias("price"),
        round_money(safe_cast("freight_value", "double")).alias("freight_value"))


