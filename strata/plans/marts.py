"""Analytics marts over the curated layer.

Plan choices (same results as joining everything first, fewer/lighter shuffles):

* Dimension sides that are unique on their key (sellers, customers) are joined
  *after* aggregation, at mart grain. Grouping by ``seller_id`` and then
  attaching city/state equals grouping by (id, city, state) after the join,
  because each id has at most one dimension row. The fact rows therefore
  shuffle once, on the order key, and the dimension join is mart-sized.
* Fact joins are on the order key only. Before joining, items are reduced
  with additive partial aggregates: to (order, seller) grain for seller
  performance, to one total per order for RFM. The partial step runs
  map-side, so a hot order collapses before any shuffle and the join sides
  are small per key.
* Distinct line positions ride along as bit masks (``operators.distinct``), so
  each mart reads items once and joins them at order grain.
* Daily sales groups by (day, customer) first, so a hot day is spread over many
  tasks.
* Money sums are exact where all values are whole cents, and plain sums of
  doubles where not (see ``money_total``); averages are that sum over the
  count of the same values.

Curated tables are unique on their keys, so the marts' own "dedupe before
join" of orders / items / sellers / customers is a no-op on them and is only
run with ``dedupe_inputs=True`` (for inputs of unknown shape), as is their
trimming of ids and texts. The reviews
side is *not* unique per order and is always reduced to one review per order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.config import CURATED_PREFIX, RunConfig
from strata.functions.scalars import lineage, money_merge, money_parts, money_total, recency_days, trim_text
from strata.operators import distinct
from strata.operators.dedupe import keep_first
from strata.operators.filters import not_null
from strata.operators.joins import split_join


def _lineage(mart: str, cfg: RunConfig):
    return lineage(f"{CURATED_PREFIX}.{mart}", cfg)


def _ids(trim: bool, *cols: str) -> list[Column]:
    """Id and text columns. The curated layer has trimmed them: as they are, they keep the buckets of a bucketed
    table, and joins on them need no exchange."""
    return [trim_text(c).alias(c) if trim else F.col(c) for c in cols]


def latest_review_per_order(reviews: DataFrame, trim: bool = False) -> DataFrame:
    """One review per order: latest answer first, then highest review id."""
    r = reviews.select(*_ids(trim, "order_id", "review_id"), "review_score", "review_answer_timestamp")
    r = keep_first(r, ["order_id"], order=[
        F.col("review_answer_timestamp").desc_nulls_last(),
        F.col("review_id").desc_nulls_last(),
        F.col("review_score").asc_nulls_last(),
    ])
    return r.select("order_id", "review_score")


def seller_performance(orders: DataFrame, order_items: DataFrame, sellers: DataFrame,
                       reviews: DataFrame, cfg: RunConfig,
                       dedupe_inputs: bool = False) -> DataFrame:
    trim = dedupe_inputs
    o = orders.select(*_ids(trim, "order_id"), "order_purchase_timestamp")
    items = order_items.select(*_ids(trim, "order_id", "order_item_id", "seller_id"), "price", "freight_value")
    s = sellers.select(*_ids(trim, "seller_id", "seller_city", "seller_state"))
    if dedupe_inputs:
        o = keep_first(o, ["order_id"])
        items = keep_first(items, ["order_id", "order_item_id"])
        s = keep_first(s, ["seller_id"])
    r = latest_review_per_order(reviews, trim)

    # 1. (order, seller) grain. Every measure is additive or merges (distinct
    #    line positions as bit masks), so Spark pre-aggregates map-side: a hot
    #    order shrinks to one row per seller and 64 positions per task before
    #    any shuffle.
    per_order_seller = distinct.with_slots(items, "order_item_id").groupBy("order_id", "seller_id", *distinct.KEYS).agg(
        F.count_if(distinct.main()).alias("n_items"),
        *money_parts(distinct.measure("price"), "price"),
        *money_parts(distinct.measure("freight_value"), "freight"),
        distinct.merged(),
    )
    # 2. Order-level attributes (purchase date, one review) join on the order
    #    key; each is constant per order, so item-row averages become
    #    n_items-weighted sums.
    per_order = o.join(r, "order_id", "full_outer")
    enriched = split_join(per_order_seller, per_order, "order_id", "left")
    scored_items = F.when(F.col("review_score").isNotNull(), F.col("n_items"))
    # 3. Masks meet per (seller, slot), then all per seller.
    per_slot = enriched.groupBy("seller_id", *distinct.KEYS).agg(
        # an order has one main row per seller
        F.count(distinct.measure("order_id")).alias("total_orders"),
        *money_merge("price"), *money_merge("freight"),
        F.sum(F.col("review_score").cast("bigint") * F.col("n_items")).alias("scores"),
        F.sum(scored_items).alias("scored"),
        F.min(F.to_date("order_purchase_timestamp")).alias("min_order_date"),
        F.max(F.to_date("order_purchase_timestamp")).alias("max_order_date"),
        distinct.merged(),
    )
    per_seller = per_slot.groupBy("seller_id").agg(
        F.sum("total_orders").alias("total_orders"),
        distinct.total().alias("total_order_items"),
        money_total("price").alias("total_revenue"),
        F.try_divide(money_total("price"), F.sum("price_n").cast("double")).alias("avg_item_price"),
        F.try_divide(money_total("freight"), F.sum("freight_n").cast("double")).alias("avg_freight_value"),
        F.try_divide(F.sum("scores").cast("double"), F.sum("scored").cast("double")).alias("avg_review_score"),
        F.min("min_order_date").alias("min_order_date"),
        F.max("max_order_date").alias("max_order_date"),
    )
    return per_seller.join(s, "seller_id", "left").select(
        "seller_id", "seller_city", "seller_state",
        "total_orders", "total_order_items", "total_revenue", "avg_item_price",
        "avg_freight_value", "avg_review_score", "min_order_date", "max_order_date",
        *_lineage("seller_performance", cfg),
    )


def customer_rfm(orders: DataFrame, order_items: DataFrame, customers: DataFrame,
                 cfg: RunConfig, dedupe_inputs: bool = False) -> DataFrame:
    trim = dedupe_inputs
    # not-null checks on the source columns (trim keeps nullness): pushable
    o = (orders.filter(not_null("order_id", "customer_id"))
         .select(*_ids(trim, "order_id", "customer_id"), "order_purchase_date"))
    item_totals = (
        order_items.filter(not_null("order_id", "order_item_id"))
        .select(*_ids(trim, "order_id"), "price")
        .groupBy("order_id")
        .agg(*money_parts("price", "value"))
    )
    c = customers.filter(not_null("customer_id")).select(
        *_ids(trim, "customer_id", "customer_unique_id", "customer_city", "customer_state"))
    if dedupe_inputs:
        o = keep_first(o, ["order_id"])
        c = keep_first(c, ["customer_id"])

    per_customer = (
        o.join(item_totals, "order_id", "left")
        .groupBy("customer_id")
        .agg(
            F.countDistinct("order_id").alias("frequency_orders"),
            money_total("value").alias("monetary_value"),
            # orders without a priced item have no value and don't count
            F.try_divide(money_total("value"),
                         F.count_if(F.col("value_n") > 0).cast("double")).alias("avg_order_value"),
            F.min(F.to_date("order_purchase_date")).alias("first_order_date"),
            F.max(F.to_date("order_purchase_date")).alias("last_order_date"),
        )
    )
    return per_customer.join(c, "customer_id", "left").select(
        "customer_id", "customer_unique_id", "customer_city", "customer_state",
        "frequency_orders", "monetary_value", "avg_order_value",
        "first_order_date", "last_order_date",
        recency_days("last_order_date", cfg).alias("recency_days"),
        *_lineage("customer_rfm", cfg),
    )


def daily_sales(orders: DataFrame, order_items: DataFrame, cfg: RunConfig,
                dedupe_inputs: bool = False) -> DataFrame:
    trim = dedupe_inputs
    o = orders.filter(not_null("order_id")).select(
        *_ids(trim, "order_id", "customer_id"), F.to_date("order_purchase_date").alias("order_date"))
    if dedupe_inputs:
        o = keep_first(o, ["order_id"])
    items = order_items.filter(not_null("order_id")).select(*_ids(trim, "order_id", "order_item_id"), "price")
    # 1. one main row per order with items (a matched order is one order) and one per further 64 positions
    per_order = distinct.with_slots(items, "order_item_id").groupBy("order_id", *distinct.KEYS).agg(
        *money_parts(distinct.measure("price"), "price"), distinct.merged())
    matched = o.join(per_order, "order_id", "inner")
    # 2. distinct customers are the main rows of (day, customer); masks then meet per (day, slot), so a hot
    #    day is spread over its customers first
    per_customer = (matched.withColumn("customer_id", distinct.measure("customer_id"))
                    .groupBy("order_date", "customer_id", *distinct.KEYS)
                    .agg(F.count(distinct.measure("order_id")).alias("total_orders"), *money_merge("price"),
                         distinct.merged()))
    per_slot = per_customer.groupBy("order_date", *distinct.KEYS).agg(
        F.sum("total_orders").alias("total_orders"), F.count("customer_id").alias("total_customers"),
        *money_merge("price"), distinct.merged())
    days = per_slot.groupBy("order_date").agg(
        F.sum("total_orders").alias("total_orders"),
        F.sum("total_customers").alias("total_customers"),
        distinct.total().alias("total_items"),
        money_total("price").alias("total_revenue"),
        F.try_divide(money_total("price"), F.sum("price_n").cast("double")).alias("avg_item_price"),
    )
    return days.select("order_date", "total_orders", "total_customers", "total_items",
                       "total_revenue", "avg_item_price", *_lineage("daily_sales_mart", cfg))


# The marts' output columns above, and their table names (also part of each mart's record_source literal).
MARTS = ("seller_performance", "customer_rfm", "daily_sales_mart")


def build_marts(curated: dict[str, DataFrame], cfg: RunConfig,
                dedupe_inputs: bool = False) -> dict[str, DataFrame]:
    return {
        "seller_performance": seller_performance(
            curated["orders"], curated["order_items"], curated["sellers"],
            curated["reviews"], cfg, dedupe_inputs),
        "customer_rfm": customer_rfm(
            curated["orders"], curated["order_items"], curated["customers"], cfg, dedupe_inputs),
        "daily_sales_mart": daily_sales(curated["orders"], curated["order_items"], cfg, dedupe_inputs),
    }
