"""Mergeable distinct counts against countDistinct, whatever the ids look like."""

import random

from pyspark.sql import functions as F

from strata.operators import distinct

IDS = [None, "", "0", "1", "01", "+1", " 1", "1 ", "-1", "-0", "63", "64", "65", "127", "128", "1e2", "3.0", "x", "é",
       "2147483647", "9223372036854775807", "9223372036854775808", "99999999999999999999999"]


def counted(df, *keys):
    """Two grains on the way up, as the marts do."""
    fine = distinct.with_slots(df, "id").groupBy(*keys, "order", *distinct.KEYS).agg(
        distinct.merged(), F.count_if(distinct.main()).alias("n"), F.sum(distinct.measure("v")).alias("v"))
    slots = fine.groupBy(*keys, *distinct.KEYS).agg(distinct.merged(), F.sum("n").alias("n"), F.sum("v").alias("v"),
                                                    F.count(distinct.measure("order")).alias("orders"))
    return slots.groupBy(*keys).agg(distinct.total().alias("ids"), F.sum("n").alias("n"), F.sum("v").alias("v"),
                                    F.sum("orders").alias("orders"))


def test_equals_count_distinct(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), rng.randint(1, 9), rng.choice(IDS + [str(rng.randint(0, 300))] * 20), i)
            for i in range(3000)] + [("none", 1, None, 5), ("none", 2, None, 6)]
    df = spark.createDataFrame(rows, "k string, order int, id string, v bigint")
    want = df.groupBy("k").agg(F.countDistinct("id").alias("ids"), F.count(F.lit(1)).alias("n"), F.sum("v").alias("v"),
                               F.countDistinct("order").alias("orders"))
    assert sorted(map(tuple, counted(df, "k").collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_a_key_with_many_positions_takes_a_row_per_64(spark):
    df = spark.range(10_000).select(F.lit("hot").alias("k"), F.lit(1).alias("order"),
                                    F.col("id").cast("string").alias("id"), F.lit(1).alias("v"))
    slots = distinct.with_slots(df, "id").groupBy("k", *distinct.KEYS).agg(distinct.merged())
    assert slots.count() == 10_000 // 64 + 1
    assert counted(df, "k").first().ids == 10_000


def test_numbers_count_like_their_text_and_empty_input(spark):
    df = spark.range(200).select(F.lit(1).alias("k"), F.lit(1).alias("order"), (F.col("id") % 70).alias("id"),
                                 F.lit(1).alias("v"))
    assert counted(df, "k").first().ids == 70
    assert counted(df.limit(0), "k").count() == 0
