"""Curated layer: processed -> trimmed, rounded, key-constrained tables.

One ``select`` defines each curated schema, then one row per (trimmed) key.
The not-null checks are written on the source columns, before the trimming
``select``: ``trim`` keeps nulls null and non-nulls non-null, so this is the
same test, and on a column it reaches the Parquet scan as a pushed filter
(on ``trim(x)`` it could not). ``''`` is not null: only ``order_status``
rejects blanks, and that check needs the trimmed value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.config import PROCESSED_PREFIX, RunConfig
from strata.functions.scalars import date_parts, lineage, parse_timestamp, round_money, trim_text
from strata.operators.dedupe import keep_first
from strata.operators.filters import not_blank, not_null
from strata.plans.process import ORDER_TIMESTAMPS
from strata.specs import (CATEGORY_TRANSLATION, CUSTOMERS, GEOLOCATION, ORDER_ITEMS,
                          ORDERS, PAYMENTS, PRODUCTS, REVIEWS, SELLERS)


def _trimmed(*cols: str):
    return [trim_text(c).alias(c) for c in cols]


def _lineage(table: str, cfg: RunConfig):
    return lineage(f"{PROCESSED_PREFIX}.{table}", cfg)


def curate_orders(df: DataFrame, cfg: RunConfig) -> DataFrame:
    out = df.filter(not_null("order_id", "customer_id", "order_purchase_timestamp")).select(
        *_trimmed("order_id", "customer_id", "order_status"),
        *ORDER_TIMESTAMPS,
        *date_parts("order_purchase_timestamp", "order_purchase"),
        *_lineage("orders", cfg),
    )
    return keep_first(out.filter(not_blank("order_status")), ORDERS.key)


def curate_order_items(df: DataFrame, cfg: RunConfig) -> DataFrame:
    out = df.filter(not_null("order_id", "order_item_id", "product_id", "seller_id")).select(
        *_trimmed("order_id", "order_item_id", "product_id", "seller_id"),
        "shipping_limit_date",
        round_money("price").alias("price"),
        round_money("freight_value").alias("freight_value"),
        *_lineage("order_items", cfg),
    )
    return keep_first(out, ORDER_ITEMS.key)


def curate_customers(df: DataFrame, cfg: RunConfig) -> DataFrame:
    out = df.filter(not_null("customer_id")).select(*_trimmed(*CUSTOMERS.columns),
                                                    *_lineage("customers", cfg))
    return keep_first(out, CUSTOMERS.key)


def curate_products(df: DataFrame, cfg: RunConfig) -> DataFrame:
    out = df.filter(not_null("product_id")).select(
        *_trimmed("product_id", "product_category_name"),
        *PRODUCTS.columns[2:],
        *_lineage("products", cfg),
    )
    return keep_first(out, PRODUCTS.key)


def curate_sellers(df: DataFrame, cfg: RunConfig) -> DataFrame:
    out = df.filter(not_null("seller_id")).select(*_trimmed(*SELLERS.columns),
                                                  *_lineage("sellers", cfg))
    return keep_first(out, SELLERS.key)


def curate_payments(df: DataFrame, cfg: RunConfig) -> DataFrame:
    out = df.filter(not_null("order_id", "payment_type")).select(
        *_trimmed("order_id", "payment_sequential", "payment_type", "payment_installments"),
        round_money("payment_value").alias("payment_value"),
        *_lineage("payments", cfg),
    )
    return keep_first(out, PAYMENTS.key)


def curate_reviews(df: DataFrame, cfg: RunConfig) -> DataFrame:
    out = df.filter(not_null("review_id", "order_id", "review_score")).select(
        *_trimmed("review_id", "order_id"),
        "review_score", "review_comment_title", "review_comment_message",
        parse_timestamp("review_creation_date").alias("review_creation_date"),
        parse_timestamp("review_answer_timestamp").alias("review_answer_timestamp"),
        *_lineage("reviews", cfg),
    )
    return keep_first(out, REVIEWS.key)


def curate_category_translation(df: DataFrame, cfg: RunConfig) -> DataFrame:
    out = df.filter(not_null("product_category_name")).select(
        *_trimmed(*CATEGORY_TRANSLATION.columns), *_lineage("category_translation", cfg))
    return keep_first(out, CATEGORY_TRANSLATION.key)


def curate_geolocation(df: DataFrame, cfg: RunConfig) -> DataFrame:
    out = df.filter(not_null("geolocation_zip_code_prefix")).select(
        *_trimmed("geolocation_zip_code_prefix"),
        F.col("geolocation_lat"), F.col("geolocation_lng"),
        *_trimmed("geolocation_city", "geolocation_state"),
        *_lineage("geolocation", cfg),
    )
    return keep_first(out, GEOLOCATION.key)


CURATE = {
    "orders": curate_orders,
    "order_items": curate_order_items,
    "customers": curate_customers,
    "products": curate_products,
    "sellers": curate_sellers,
    "payments": curate_payments,
    "reviews": curate_reviews,
    "category_translation": curate_category_translation,
    "geolocation": curate_geolocation,
}
