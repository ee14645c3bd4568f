import datetime as dt
import math

from pyspark.sql import functions as F

from strata.functions.scalars import (date_parts, int_avg, lineage, money_avg, money_parts, money_sum, money_total,
                                      parse_timestamp, recency_days, round_money, safe_cast,
                                      trim_text)


def test_trim_strips_spaces_only(spark):
    df = spark.createDataFrame([(" a ",), ("\tb\t",), ("   ",), (None,)], "s string")
    got = [r[0] for r in df.select(trim_text("s")).collect()]
    assert got == ["a", "\tb\t", "", None]


def test_trim_of_int_is_text(spark):
    df = spark.createDataFrame([(7,)], "i int")
    out = df.select(trim_text("i").alias("t"))
    assert out.schema["t"].dataType.simpleString() == "string"
    assert out.first()[0] == "7"


def test_safe_cast_never_raises(spark):
    df = spark.createDataFrame([(" 4 ",), ("x",), ("",), (None,), ("12",)], "s string")
    got = [r[0] for r in df.select(safe_cast("s", "int")).collect()]
    assert got == [4, None, None, None, 12]
    ts = df.select(safe_cast("s", "timestamp")).collect()
    assert all(r[0] is None for r in ts[:4])


def test_parse_timestamp(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05",), ("not-a-date",), (None,)], "s string")
    got = [r[0] for r in df.select(parse_timestamp("s")).collect()]
    assert got[0] == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert got[1] is None and got[2] is None


def test_round_money_half_up(spark):
    vals = [(0.125,), (2.675,), (1.005,), (-0.125,), (10.0,), (1234.5678,), (None,), (float("nan"),),
            (1e300,)]
    df = spark.createDataFrame(vals, "x double")
    got = [r[0] for r in df.select(round_money("x")).collect()]
    assert got[:6] == [0.13, 2.68, 1.01, -0.13, 10.0, 1234.57]
    assert got[6] is None
    assert math.isnan(got[7])
    assert got[8] == 1e300


def test_round_money_rounds_once(spark):
    """Six-digit values equal Spark's own rounding of the double; none is cut to fewer digits first."""
    import random
    rng = random.Random(1)
    vals = [1.00499999, 0.00495, 0.00499999] + [round(rng.uniform(-1000, 1000), 6) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = df.select(round_money("x").alias("a"), F.round("x", 2).alias("b")).collect()
    assert [r.a for r in got] == [r.b for r in got]
    assert [r.a for r in got[:3]] == [1.0, 0.0, 0.0]


def test_money_sums_never_drop_or_fail(spark):
    nan, inf = float("nan"), float("inf")
    rows = [("sub", 0.004), ("sub", 0.004), ("nan", nan), ("nan", 5.0), ("inf", inf), ("inf", 1.0),
            ("big", 1e37), ("big", 1e300), ("over", 9e35), ("over", 9e35)]
    rows += [("many", 9e35)] * 20
    df = spark.createDataFrame(rows, "k string, p double")
    got = {r.k: (r.s, r.a) for r in df.groupBy("k").agg(money_sum("p").alias("s"), money_avg("p").alias("a")).collect()}
    assert got["sub"] == (0.008, 0.004)
    assert math.isnan(got["nan"][0]) and math.isnan(got["nan"][1])
    assert got["inf"] == (inf, inf)
    assert got["big"] == (1e300 + 1e37, (1e300 + 1e37) / 2)
    assert got["over"][0] == 1.8e36 and math.isclose(got["many"][0], 1.8e37)


def test_money_parts_add_up_like_one_sum(spark):
    nan = float("nan")
    rows = [("a", 1, 0.1), ("a", 1, 0.2), ("a", 2, 0.3), ("b", 1, nan), ("b", 2, 1.0), ("c", 1, None),
            ("d", 1, 0.001), ("d", 2, 0.01)]
    df = spark.createDataFrame(rows, "k string, o int, p double")
    parts = df.groupBy("k", "o").agg(*money_parts("p", "p"))
    got = {r.k: r.s for r in parts.groupBy("k").agg(money_total("p").alias("s")).collect()}
    assert got["a"] == 0.6 and math.isnan(got["b"]) and got["c"] is None and math.isclose(got["d"], 0.011)


def test_money_sum_and_avg_exact(spark):
    df = spark.createDataFrame([("a", 0.1), ("a", 0.2), ("a", None), ("b", None)], "k string, p double")
    got = {r.k: (r.s, r.a) for r in df.groupBy("k").agg(
        money_sum("p").alias("s"), money_avg("p").alias("a")).collect()}
    assert got["a"] == (0.3, 0.15)          # exact, not 0.30000000000000004
    assert got["b"] == (None, None)


def test_int_avg(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "v int")
    assert df.agg(int_avg("v")).first()[0] == 1.5


def test_date_parts_and_recency(spark, cfg):
    df = spark.createDataFrame([(dt.datetime(2001, 12, 31, 23, 0),)], "t timestamp")
    r = df.select(*date_parts("t", "p"), recency_days(F.to_date("t"), cfg).alias("r")).first()
    assert (r.p_date, r.p_year, r.p_month, r.r) == (dt.date(2001, 12, 31), 2001, 12, 1)


def test_lineage_literals(spark, cfg):
    r = spark.range(1).select(*lineage("olist", cfg)).first()
    assert r.record_source == "olist"
    assert r.load_timestamp == cfg.load_ts


def test_pinned_load_timestamp_ignores_the_driver_time_zone(spark):
    import os
    import time
    from strata.config import RunConfig
    from strata.functions.scalars import load_timestamp
    cfg = RunConfig(load_ts=dt.datetime(2024, 1, 1, 12, 30))
    aware = RunConfig(load_ts=dt.datetime(2024, 1, 1, 14, 30, tzinfo=dt.timezone(dt.timedelta(hours=2))))
    old = os.environ.get("TZ")
    os.environ["TZ"] = "America/New_York"
    time.tzset()
    try:
        got = spark.range(1).select(F.date_format(load_timestamp(cfg), "yyyy-MM-dd HH:mm").alias("a"),
                                    F.date_format(load_timestamp(aware), "yyyy-MM-dd HH:mm").alias("b")).first()
    finally:
        if old is None:
            os.environ.pop("TZ")
        else:
            os.environ["TZ"] = old
        time.tzset()
    assert (got.a, got.b) == ("2024-01-01 12:30", "2024-01-01 12:30")
