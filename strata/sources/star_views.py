"""Raw-shaped entity views derived from the star-schema test tables.

The original jobs read nine string-typed CSV files. The test data is a TPC-H-like
star schema, so each raw entity is derived from it with Spark (all columns cast
to text, exactly as a headered CSV would deliver them). ``dirty=True`` injects
deterministic dirt by key arithmetic so that the process/curate rules have
something to reject; the same rules are spelled out in the oracle SQL.

Work grows with the input: every view is a projection of one fact table, and
the only joins are to ``nation`` / ``region`` (25 / 5 rows by definition of the
schema), which Catalyst broadcasts from their file statistics.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.specs import ENTITIES

# Dirt injection rules (modulus on the source key, replacement).
DIRT_NULL_UNIQUE_ID_MOD = 97        # customers.customer_unique_id -> null
DIRT_NULL_PRODUCT_MOD = 101         # order_items.product_id -> null
DIRT_BLANK_STATUS_MOD = 89          # orders.order_status -> '  '
DIRT_BAD_TS_MOD = 211               # orders.order_purchase_timestamp -> 'not-a-date'
DIRT_NEGATIVE_PRICE_MOD = 103       # order_items.price -> negative
DIRT_PADDED_CITY_MOD = 3            # customers.customer_city -> ' city '
DIRT_BAD_SCORE_MOD = 113            # reviews.review_score -> 'x'
DIRT_DUP_SELLER_MOD = 10            # sellers: second copy with city 'DUP'
DIRT_NULL_PAYMENT_TYPE_MOD = 127    # payments.payment_type -> null
DIRT_NAN_PRICE_MOD = 109            # order_items.price, payments.payment_value -> 'NaN'
DIRT_INFINITE_PRICE_MOD = 131       # order_items.price -> 'Infinity'
DIRT_LARGE_PRICE_MOD = 137          # order_items.price -> LARGE_PRICE
DIRT_SUB_CENT_MOD = 7               # order_items.price, payments.payment_value -> more digits
DIRT_MULTILINE_MOD = 5              # reviews.review_comment_message -> several lines
LARGE_PRICE = "1234567890123.255"
SUB_CENT = "499999"                 # appended to a two-digit price

# Day offsets of the derived order timestamps.
APPROVED_DAYS, CARRIER_DAYS, DELIVERED_DAYS, ESTIMATED_DAYS = 1, 3, 7, 14
REVIEW_ANSWER_DAYS = 2


def _txt(c: Column) -> Column:
    return c.cast("string")


def _dirty(enabled: bool, cond: Column, dirty_value, clean: Column) -> Column:
    if not enabled:
        return clean
    return F.when(cond, dirty_value).otherwise(clean)


def _read(spark: SparkSession, sf_dir: str, table: str, *cols: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*cols)


def _geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _read(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    region = _read(spark, sf_dir, "region", "r_regionkey", "r_name")
    return (nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
            .select("n_nationkey", "n_name", "r_name"))


def _zip(nationkey: str) -> Column:
    return F.lpad(_txt(F.col(nationkey)), 5, "0")


def raw_orders(spark: SparkSession, sf_dir: str, dirty: bool = True) -> DataFrame:
    o = _read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    k, ts = F.col("o_orderkey"), F.col("o_orderdate")

    def shifted(days: int) -> Column:
        return _txt(F.timestamp_add("DAY", F.lit(days), ts))

    return o.select(
        _txt(k).alias("order_id"),
        _txt(F.col("o_custkey")).alias("customer_id"),
        _dirty(dirty, k % DIRT_BLANK_STATUS_MOD == 0, F.lit("  "),
               F.col("o_orderstatus")).alias("order_status"),
        _dirty(dirty, k % DIRT_BAD_TS_MOD == 0, F.lit("not-a-date"),
               _txt(ts)).alias("order_purchase_timestamp"),
        shifted(APPROVED_DAYS).alias("order_approved_at"),
        shifted(CARRIER_DAYS).alias("order_delivered_carrier_date"),
        shifted(DELIVERED_DAYS).alias("order_delivered_customer_date"),
        shifted(ESTIMATED_DAYS).alias("order_estimated_delivery_date"),
    )


def raw_order_items(spark: SparkSession, sf_dir: str, dirty: bool = True) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey",
               "l_linenumber", "l_extendedprice", "l_tax", "l_shipdate")
    part = F.col("l_partkey")
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    priced = _dirty(dirty, part % DIRT_SUB_CENT_MOD == 0, F.concat(_txt(price), F.lit(SUB_CENT)), _txt(price))
    priced = _dirty(dirty, part % DIRT_LARGE_PRICE_MOD == 0, F.lit(LARGE_PRICE), priced)
    priced = _dirty(dirty, part % DIRT_INFINITE_PRICE_MOD == 0, F.lit("Infinity"), priced)
    priced = _dirty(dirty, part % DIRT_NAN_PRICE_MOD == 0, F.lit("NaN"), priced)
    return li.select(
        _txt(F.col("l_orderkey")).alias("order_id"),
        _txt(F.col("l_linenumber")).alias("order_item_id"),
        _dirty(dirty, part % DIRT_NULL_PRODUCT_MOD == 0, F.lit(None).cast("string"),
               _txt(part)).alias("product_id"),
        _txt(F.col("l_suppkey")).alias("seller_id"),
        _txt(F.col("l_shipdate")).alias("shipping_limit_date"),
        _dirty(dirty, part % DIRT_NEGATIVE_PRICE_MOD == 0, _txt(-price), priced).alias("price"),
        _txt(price * F.col("l_tax").cast("decimal(8,2)")).alias("freight_value"),
    )


def raw_customers(spark: SparkSession, sf_dir: str, dirty: bool = True) -> DataFrame:
    c = _read(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey")
    g = _geography(spark, sf_dir)
    k = F.col("c_custkey")
    return c.join(g, c.c_nationkey == g.n_nationkey, "left").select(
        _txt(k).alias("customer_id"),
        _dirty(dirty, k % DIRT_NULL_UNIQUE_ID_MOD == 0, F.lit(None).cast("string"),
               F.col("c_name")).alias("customer_unique_id"),
        _zip("c_nationkey").alias("customer_zip_code_prefix"),
        _dirty(dirty, k % DIRT_PADDED_CITY_MOD == 0,
               F.concat(F.lit(" "), F.col("n_name"), F.lit(" ")),
               F.col("n_name")).alias("customer_city"),
        F.col("r_name").alias("customer_state"),
    )


def raw_products(spark: SparkSession, sf_dir: str, dirty: bool = True) -> DataFrame:
    p = _read(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size")
    size = F.col("p_size")
    return p.select(
        _txt(F.col("p_partkey")).alias("product_id"),
        F.col("p_type").alias("product_category_name"),
        _txt(F.length("p_name")).alias("product_name_lenght"),
        _txt(F.length("p_brand")).alias("product_description_lenght"),
        _txt(size % 5).alias("product_photos_qty"),
        _txt(size * 10).alias("product_weight_g"),
        _txt(size + 1).alias("product_length_cm"),
        _txt(size + 2).alias("product_height_cm"),
        _txt(size + 3).alias("product_width_cm"),
    )


def raw_sellers(spark: SparkSession, sf_dir: str, dirty: bool = True) -> DataFrame:
    s = _read(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    g = _geography(spark, sf_dir)
    base = s.join(g, s.s_nationkey == g.n_nationkey, "left").select(
        _txt(F.col("s_suppkey")).alias("seller_id"),
        _zip("s_nationkey").alias("seller_zip_code_prefix"),
        F.col("n_name").alias("seller_city"),
        F.col("r_name").alias("seller_state"),
    )
    if not dirty:
        return base
    dup = (base.filter(F.col("seller_id").cast("bigint") % DIRT_DUP_SELLER_MOD == 0)
           .withColumn("seller_city", F.lit("DUP")))
    return base.unionByName(dup)


def raw_payments(spark: SparkSession, sf_dir: str, dirty: bool = True) -> DataFrame:
    e = _read(spark, sf_dir, "events", "event_id", "event_type", "value")
    k = F.col("event_id")
    value = _txt(F.col("value").cast("decimal(18,2)"))
    value = _dirty(dirty, k % DIRT_SUB_CENT_MOD == 0, F.concat(value, F.lit(SUB_CENT)), value)
    return e.select(
        _txt(F.expr("event_id div 2")).alias("order_id"),
        _txt(k % 2 + 1).alias("payment_sequential"),
        _dirty(dirty, k % DIRT_NULL_PAYMENT_TYPE_MOD == 0, F.lit(None).cast("string"),
               F.col("event_type")).alias("payment_type"),
        _txt(k % 12 + 1).alias("payment_installments"),
        _dirty(dirty, k % DIRT_NAN_PRICE_MOD == 0, F.lit("NaN"), value).alias("payment_value"),
    )


def raw_reviews(spark: SparkSession, sf_dir: str, dirty: bool = True) -> DataFrame:
    e = _read(spark, sf_dir, "events", "event_id", "ts", "event_type", "value", "props")
    k, ts = F.col("event_id"), F.col("ts")
    fmt = "yyyy-MM-dd HH:mm:ss"
    return e.select(
        _txt(k).alias("review_id"),
        _txt(F.expr("event_id div 2")).alias("order_id"),
        _dirty(dirty, k % DIRT_BAD_SCORE_MOD == 0, F.lit("x"),
               _txt(F.floor("value") % 7)).alias("review_score"),
        F.col("event_type").alias("review_comment_title"),
        _dirty(dirty, k % DIRT_MULTILINE_MOD == 0,
               F.concat(F.col("props"), F.lit('\nsecond line, with "quotes"\n\n"end"')),
               F.col("props")).alias("review_comment_message"),
        F.date_format(ts, fmt).alias("review_creation_date"),
        F.date_format(F.timestamp_add("DAY", F.lit(REVIEW_ANSWER_DAYS), ts), fmt)
        .alias("review_answer_timestamp"),
    )


def raw_category_translation(spark: SparkSession, sf_dir: str, dirty: bool = True) -> DataFrame:
    p = _read(spark, sf_dir, "part", "p_type")
    return p.select(
        F.col("p_type").alias("product_category_name"),
        F.lower("p_type").alias("product_category_name_english"),
    )


def raw_geolocation(spark: SparkSession, sf_dir: str, dirty: bool = True) -> DataFrame:
    c = _read(spark, sf_dir, "customer", "c_nationkey")
    g = _geography(spark, sf_dir)
    nk = F.col("c_nationkey")
    return c.join(g, c.c_nationkey == g.n_nationkey, "left").select(
        _zip("c_nationkey").alias("geolocation_zip_code_prefix"),
        _txt(nk - 12).alias("geolocation_lat"),
        _txt(nk * 5 - 60).alias("geolocation_lng"),
        F.col("n_name").alias("geolocation_city"),
        F.col("r_name").alias("geolocation_state"),
    )


BUILDERS = {
    "orders": raw_orders,
    "order_items": raw_order_items,
    "customers": raw_customers,
    "products": raw_products,
    "sellers": raw_sellers,
    "payments": raw_payments,
    "reviews": raw_reviews,
    "category_translation": raw_category_translation,
    "geolocation": raw_geolocation,
}
assert set(BUILDERS) == set(ENTITIES)


def raw_view(spark: SparkSession, sf_dir: str, name: str, dirty: bool = True) -> DataFrame:
    return BUILDERS[name](spark, sf_dir, dirty)


def raw_views(spark: SparkSession, sf_dir: str, dirty: bool = True) -> dict[str, DataFrame]:
    return {name: fn(spark, sf_dir, dirty) for name, fn in BUILDERS.items()}
