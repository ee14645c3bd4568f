import contextlib
import io
import random

import pytest
from pyspark.sql import functions as F

from strata.operators.dedupe import keep_first
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_keeps_first_under_total_order_nulls_last(spark):
    df = spark.createDataFrame(
        [("k", None, 1), ("k", "b", 2), ("k", "a", 3), ("j", None, 4)], "k string, v string, w int")
    assert _rows(keep_first(df, ["k"])) == sorted([("j", None, 4), ("k", "a", 3)], key=repr)


def test_null_keys_collapse_to_one_row(spark):
    df = spark.createDataFrame([(None, "x"), (None, "a"), ("k", "z")], "k string, v string")
    assert _rows(keep_first(df, ["k"])) == sorted([(None, "a"), ("k", "z")], key=repr)


def test_composite_key(spark):
    df = spark.createDataFrame([("o", 1, 5.0), ("o", 1, 4.0), ("o", 2, 9.0)], "o string, i int, p double")
    assert _rows(keep_first(df, ["o", "i"])) == [("o", 1, 4.0), ("o", 2, 9.0)]


def test_independent_of_partitioning_and_input_order(spark):
    rows = [(f"k{i % 37}", random.Random(i).randint(0, 9), f"p{i}") for i in range(2000)]
    shuffled = rows[:]
    random.Random(7).shuffle(shuffled)
    a = keep_first(spark.createDataFrame(rows, "k string, v int, p string").repartition(1), ["k"])
    b = keep_first(spark.createDataFrame(shuffled, "k string, v int, p string").repartition(7), ["k"])
    assert _rows(a) == _rows(b)
    assert a.count() == 37


def test_hot_key_holding_a_third_of_rows(spark):
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        (F.lit(n) - F.col("id")).alias("v"))
    out = keep_first(df.repartition(8), ["k"])
    assert out.count() == 1 + (n - n // 3)
    assert out.filter("k = 'hot'").first().v == n - (n - 3)


def test_plan_limits_rows_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        keep_first(df, ["k"]).explain()
    plan = buf.getvalue()
    # the partial limit sits below the exchange: one row per key per map task
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_table_of_only_its_key(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), ("b", None)], "k string, n int")
    assert sorted(map(tuple, keep_first(df, ["k", "n"]).collect()), key=str) == [("a", 1), ("b", None)]


@pytest.mark.parametrize("name", ["orders", "order_items", "customers", "products"])
def test_one_exchange_gives_survivors_and_counts(spark, cfg, name):
    """Equal to the window dedupe and to the raw profile, over the dirty raw views."""
    from strata.operators import quality
    from strata.plans.layered import RAW_CHECKS
    from strata.plans.process import PROCESS
    from strata.sources.star_views import raw_view
    raw, spec = raw_view(spark, SF_SMALL, name), RAW_CHECKS[name]
    checks = quality.raw_checks(spec["nulls"], spec.get("negatives", ()))
    profile = PROCESS[name].profiled(raw, checks, spec["key"])
    got, want = PROCESS[name].from_profile(profile, cfg), PROCESS[name](raw, cfg)
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    metrics = quality.profile_metrics(profile, name, list(checks), spec["key"] is not None)
    assert sorted(map(tuple, metrics.collect())) == sorted(map(tuple, quality.raw_profile(
        raw, name, spec["key"], spec["nulls"], spec.get("negatives", ())).collect()))
    plan, source = (df._jdf.queryExecution().executedPlan().toString() for df in (profile, raw))
    assert plan.count("hashpartitioning(__raw_") == plan.count("partial_min") == 1
    assert plan.count("Exchange") == source.count("Exchange") + 1 and plan.count("FileScan") == source.count("FileScan")


def test_survivors_with_nulls_invalid_rows_and_retyped_keys(spark, cfg):
    from strata.operators import quality
    from strata.plans.process import PROCESS
    cols = "order_id, order_item_id, product_id, seller_id, shipping_limit_date, price, freight_value".split(", ")
    rows = [("o", "1", "p", "s", None, "2.0", "1"), ("o", "01", "p", "s", None, "1.0", "1"),   # one typed key
            ("o", "1", "p", "s", "2020-01-01", "2.0", "1"), ("o", "x", "p", "s", None, "1", "1"),
            ("o", None, "p", "s", None, "1", "1"), (None, "1", "p", "s", None, "-1", "-2"), (None, "1", None, "s", None, "-1", None),
            ("q", "2", "p", "s", None, "NaN", "0"), ("q", "2", "p", "s", None, "5", "0"), ("q", "3", "p", "s", None, "bad", "0")]
    raw = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))
    checks = quality.raw_checks(("order_id", "product_id"), ("price", "freight_value"))
    profile = PROCESS["order_items"].profiled(raw, checks)
    got = PROCESS["order_items"].from_profile(profile, cfg)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, PROCESS["order_items"](raw, cfg).collect()))
    assert sorted((r.order_id, r.order_item_id, r.price) for r in got.collect()) == [("o", 1, 2.0), ("q", 2, 5.0)]
    m = {r.metric: r.value for r in quality.profile_metrics(profile, "t", list(checks), True).collect()}
    assert m == {"raw_rows": 10, "null_order_id": 2, "null_product_id": 1, "negative_price": 2, "negative_freight_value": 1,
                 "duplicate_key_groups": 3}
    empty = PROCESS["order_items"].profiled(raw.limit(0), checks)
    assert PROCESS["order_items"].from_profile(empty, cfg).count() == 0
    assert {r.value for r in quality.profile_metrics(empty, "t", list(checks), True).collect()} == {0}
