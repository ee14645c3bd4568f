"""Skew check: run the layered job on a variant where one order id and one
seller id each hold a third of all item rows (and one day and one customer
each a third of all orders), and report per-stage task times.

Usage: python scripts/skew_check.py [sf_dir]

The variant is derived from the given tables: every third item row is moved
to order "0" (its item id made unique -- order id and line, digits only -- so
the rows survive dedupe and reach the marts as one hot order), and another
third to seller "1". The unskewed data runs first in the same process for
comparison. Both read a drop of FILES files per table, with broadcasts off and
a low skew threshold, so that joins are sort-merge joins as they are at scale
and a hot partition counts as skewed at this size. Spark's event log is
written to a fresh scratch folder; the script prints the joins that adaptive
execution split, and for each shuffle stage the task count, the slowest and the
median task.
"""

from __future__ import annotations

import glob
import io
import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def skewed(raw: dict) -> dict:
    from pyspark.sql import functions as F
    items = raw["order_items"]
    k = F.abs(F.xxhash64("order_id", "order_item_id")) % 3
    hot_order = k == 0
    items = items.select(
        F.when(hot_order, F.lit("0")).otherwise(F.col("order_id")).alias("order_id"),
        # digits only (the process layer parses item ids as int): unique per row
        F.when(hot_order, F.concat("order_id", F.lpad("order_item_id", 2, "0")))
        .otherwise(F.col("order_item_id")).alias("order_item_id"),
        "product_id",
        F.when(k == 1, F.lit("1")).otherwise(F.col("seller_id")).alias("seller_id"),
        "shipping_limit_date", "price", "freight_value",
    )
    orders = raw["orders"]
    j = F.abs(F.xxhash64("order_id")) % 3
    orders = orders.withColumns({
        # a third of all orders on one day (daily sales), another third for one customer (RFM)
        "order_purchase_timestamp": F.when(j == 0, F.lit("2000-01-01 00:00:00"))
        .otherwise(F.col("order_purchase_timestamp")),
        "customer_id": F.when(j == 1, F.lit("0")).otherwise(F.col("customer_id")),
    })
    return {**raw, "order_items": items, "orders": orders}


FILES = 16


def many_files(spark, raw: dict, folder: str) -> dict:
    for name, df in raw.items():
        df.repartition(FILES).write.parquet(f"{folder}/{name}")
    return {name: spark.read.parquet(f"{folder}/{name}") for name in raw}


def split_joins(plan: dict) -> int:
    own = plan["nodeName"].startswith("SortMergeJoin") and "skew=true" in plan["nodeName"] + plan["simpleString"]
    return int(own) + sum(split_joins(c) for c in plan["children"])


def merge_joins(plan: dict) -> int:
    return int(plan["nodeName"].startswith("SortMergeJoin")) + sum(merge_joins(c) for c in plan["children"])


def stage_report(event_dir: str) -> tuple[list[dict], dict]:
    import zstandard
    stages, tasks, reads, plans = {}, {}, {}, {}
    for f in glob.glob(f"{event_dir}/*/events_*") + glob.glob(f"{event_dir}/*"):
        if os.path.isdir(f):
            continue
        with open(f, "rb") as fh:
            raw = fh.read()
        try:
            text = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read().decode()
        except zstandard.ZstdError:
            text = raw.decode()
        for line in text.splitlines():
            e = json.loads(line)
            if "sparkPlanInfo" in e:
                plans[e["executionId"]] = e["sparkPlanInfo"]  # the last one ran
            if e["Event"] == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                stages[si["Stage ID"]] = si["Stage Name"].split(" at ")[0]
            elif e["Event"] == "SparkListenerTaskEnd":
                ti = e["Task Info"]
                tasks.setdefault(e["Stage ID"], []).append(ti["Finish Time"] - ti["Launch Time"])
                m = e.get("Task Metrics") or {}
                sr = m.get("Shuffle Read Metrics", {})
                reads[e["Stage ID"]] = reads.get(e["Stage ID"], 0) + sr.get("Total Records Read", 0)
    out = []
    for sid in sorted(stages):
        ts = tasks.get(sid, [])
        if len(ts) > 1:
            out.append({"stage": sid, "tasks": len(ts), "max_ms": max(ts),
                        "median_ms": statistics.median(ts),
                        "reads": "shuffle" if reads.get(sid) else "files"})
    return out, {"sort_merge_joins": sum(map(merge_joins, plans.values())),
                 "split_by_aqe": sum(map(split_joins, plans.values()))}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from strata.catalog import CFG
    from strata.plans.layered import run_layered
    from strata.session import build_session
    from strata.sources.layers import ANALYTICS, LayerStore
    from strata.sources.star_views import raw_views

    scratch = tempfile.mkdtemp(prefix="strata-skew-")
    events = os.path.join(scratch, "events")
    os.makedirs(events)
    spark = build_session("local[8]", 16, extra={"spark.eventLog.enabled": "true",
                                                 "spark.eventLog.dir": events,
                                                 "spark.sql.autoBroadcastJoinThreshold": "-1",
                                                 "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                                                 "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
                                                 "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
                                                 "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"})
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(os.path.join(scratch, "ckpt"))
    def timed_run(raw, name):
        store = LayerStore(os.path.join(scratch, name))
        t0 = time.perf_counter()
        run = run_layered(spark, raw, store, CFG)
        return store, run, time.perf_counter() - t0

    plain = many_files(spark, raw_views(spark, sf_dir), os.path.join(scratch, "drop"))
    hot_drop = many_files(spark, skewed(raw_views(spark, sf_dir)), os.path.join(scratch, "hot_drop"))
    timed_run(plain, "warm-up")                             # JIT/codegen, untimed
    _, base_run, base_total = timed_run(plain, "uniform")   # same process, for scale
    store, run, total = timed_run(hot_drop, "skewed")
    # the join queries' own shape over the skewed tables
    from pyspark.sql import functions as F

    from strata.operators.joins import split_join
    items = store.read(spark, "curated_layer", "order_items").select("order_id", "order_item_id", "seller_id", "price")
    sides = {"order_id": store.read(spark, "curated_layer", "orders").select("order_id", "customer_id"),
             "seller_id": store.read(spark, "curated_layer", "sellers").select("seller_id", "seller_city")}
    for key, side in sides.items():
        split_join(items, side.groupBy(key).agg(*[F.min(c).alias(c) for c in side.columns if c != key]), key, "left") \
            .write.format("noop").mode("overwrite").save()
    hot = (store.read(spark, "curated_layer", "order_items")
           .groupBy("order_id").count().orderBy("count", ascending=False).first())
    seller = store.read(spark, ANALYTICS, "seller_performance").filter("seller_id = '1'").first()
    day = store.read(spark, ANALYTICS, "daily_sales_mart").orderBy("total_orders", ascending=False).first()
    cust = store.read(spark, ANALYTICS, "customer_rfm").filter("customer_id = '0'").first()
    spark.stop()
    print(json.dumps({"uniform_seconds": round(base_total, 2),
                      "uniform_steps": {k: round(v, 2) for k, v in base_run.seconds.items()},
                      "skewed_seconds": round(total, 2),
                      "skewed_steps": {k: round(v, 2) for k, v in run.seconds.items()},
                      "hottest_curated_order": [hot["order_id"], hot["count"]],
                      "hot_seller_orders": seller["total_orders"],
                      "hot_day_orders": [str(day["order_date"]), day["total_orders"]],
                      "hot_customer_orders": cust["frequency_orders"]}))
    # Stages that read files are bound by the input layout (the test tables are
    # single row groups, read by one task); key skew shows in shuffle stages.
    stages, joins = stage_report(events)
    print(json.dumps(joins))
    report = [s for s in stages if s["reads"] == "shuffle"]
    worst = sorted(report, key=lambda s: s["max_ms"], reverse=True)
    for s in worst[:8]:
        print(json.dumps(s))


if __name__ == "__main__":
    main()
