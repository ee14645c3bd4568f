"""Plan-shape guards for the scale properties the design relies on."""

import contextlib
import io

import pytest

from strata import catalog

from tests.conftest import SF_SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


def _plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    return {k: _plan(fn(spark, SF_SMALL)) for k, fn in catalog.QUERIES.items()}


def test_no_python_udfs_or_pairwise_joins(plans):
    for key, plan in plans.items():
        for op in FORBIDDEN:
            assert op not in plan, (key, op)


def test_every_dedupe_limits_before_its_shuffle(plans):
    for key, plan in plans.items():
        tree = plan.split("\n\n")[0]
        partial = tree.count("WindowGroupLimit")
        windows = tree.count("Window (")
        # each row_number dedupe contributes one final and one partial limit
        assert partial == 2 * windows, key


def _children(tree: str):
    """(depth, operator) of each line of a formatted plan's tree."""
    for line in tree.splitlines():
        name = line.lstrip(" :+-*(0123456789)")
        if name:
            yield len(line) - len(name), name.split(" ")[0]


@pytest.mark.parametrize("key", ["join_left_chain", "join_left_preagg", "join_inner", "mart_seller_performance",
                                 "mart_daily_sales"])
def test_joins_with_hot_keys_deal_both_sides(spark, key):
    """With broadcasts off, no window or aggregate feeds such a join without an exchange of its own."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tree = _plan(catalog.QUERIES[key](spark, SF_SMALL)).split("\n\n")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = list(_children(tree))
    assert any(name == "SortMergeJoin" for _, name in lines)
    if not key.startswith("join_"):
        return
    for i, (_, name) in enumerate(lines):
        # a side without an exchange of its own would start with its Window
        assert not (name in ("SortMergeJoin",) and lines[i + 1][1] == "Window"), key


def test_split_join_has_an_exchange_on_each_side(spark):
    from pyspark.sql import functions as F

    from strata.operators.joins import split_join
    left = spark.range(100).select((F.col("id") % 7).alias("k"), "id")
    right = left.groupBy("k").agg(F.count("id").alias("n"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = split_join(left, right, "k")
        tree = _plan(df).split("\n\n")[0]
        assert df.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # one exchange per side of the join and one of the aggregate
    assert sum(name == "Exchange" for _, name in _children(tree)) == 3


def test_daily_mart_expands_no_item_rows(plans):
    """The distinct counts are narrow: no Expand multiplies the joined rows."""
    assert "Expand" not in plans["mart_daily_sales"]


def test_seller_mart_needs_no_expand(plans):
    assert "Expand" not in plans["mart_seller_performance"]


def test_key_predicates_reach_the_scan(plans):
    assert "PushedFilters: [IsNotNull(o_orderkey)" in plans["process_orders"]
    assert "IsNotNull(l_orderkey)" in plans["process_order_items"]


def test_scans_read_only_needed_columns(plans):
    # the orders view reads 4 of the 6 columns of the orders table
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_orderdate" \
        in plans["process_orders"]
    assert "o_totalprice" not in plans["process_orders"]


@pytest.mark.parametrize("key,items", [("mart_seller_performance", 1), ("mart_daily_sales", 1),
                                       ("agg_multi_distinct", 2)])
def test_distinct_counts_without_expand_or_item_grain_joins(spark, key, items):
    """Positions merge as masks: items are read once per mart, no Expand, and each item scan is
    aggregated before it meets an exchange."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(catalog.QUERIES[key](spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    tree, details = plan.split("\n\n")[0], plan
    assert "Expand" not in tree
    assert details.count("/order_items/v") == items
    lines = list(_children(tree))
    scans = [i for i, (_, op) in enumerate(lines) if op == "Scan"]
    for i in scans:
        above, depth = [], lines[i][0]
        for d, op in reversed(lines[:i]):
            if d < depth:
                above.append(op)
                depth = d
        if "Generate" in above:
            assert above.index("HashAggregate") < above.index("Exchange")
