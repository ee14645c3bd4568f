"""Property tests against brute-force Python on small random fixtures."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.functions.scalars import round_money
from strata.operators.dedupe import keep_first
from strata.operators.quality import raw_profile

KEYS = st.one_of(st.none(), st.sampled_from(["a", "b", " a", "hot"]))
VALS = st.one_of(st.none(), st.text(alphabet="xyz ", max_size=3))
NUMS = st.one_of(st.none(), st.integers(min_value=-5, max_value=5))
ROWS = st.lists(st.tuples(KEYS, VALS, NUMS), max_size=40)

SETTINGS = settings(max_examples=25, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def _nulls_last(v):
    return (v is None, v if v is not None else 0)


def brute_keep_first(rows):
    best = {}
    for r in rows:
        order = (_nulls_last(r[1]), _nulls_last(r[2]))
        if r[0] not in best or order < best[r[0]][0]:
            best[r[0]] = (order, r)
    return sorted((v[1] for v in best.values()), key=repr)


@SETTINGS
@given(ROWS)
def test_keep_first_equals_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k string, v string, n int").repartition(3)
    got = sorted((tuple(r) for r in keep_first(df, ["k"]).collect()), key=repr)
    assert got == brute_keep_first(rows)


@SETTINGS
@given(ROWS)
def test_raw_profile_equals_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k string, v string, n int")
    got = {r.metric: r.value for r in raw_profile(df, "t", ["k"], ["k", "v"]).collect()}
    counts = {}
    for r in rows:
        counts[r[0]] = counts.get(r[0], 0) + 1
    assert got["raw_rows"] == len(rows)
    assert got["null_k"] == sum(r[0] is None for r in rows)
    assert got["null_v"] == sum(r[1] is None for r in rows)
    assert got["duplicate_key_groups"] == sum(c > 1 for c in counts.values())


@SETTINGS
@given(st.lists(st.integers(min_value=-10**9, max_value=10**9), min_size=1, max_size=30))
def test_round_money_equals_decimal_half_up(spark, ten_thousandths):
    # Money as parsed from text with up to 4 decimals.
    values = [float(Decimal(v) / 10000) for v in ten_thousandths]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(round_money("x")).collect()]
    want = [float(Decimal(repr(v)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)) for v in values]
    assert got == want
