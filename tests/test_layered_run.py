"""The layered production run: raw CSV drop -> processed -> curated -> marts."""

import uuid

from strata.catalog import QUERIES
from strata.plans.layered import run_layered
from strata.session import scratch_path
from strata.sources import ANALYTICS, LayerStore, read_raw_drop, write_raw_csv
from strata.sources.star_views import raw_views
from strata.specs import ENTITIES

from tests.conftest import SF_SMALL


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_layered_run_from_csv_drop_matches_registered_marts(spark, cfg):
    drop = scratch_path(spark, "drop", uuid.uuid4().hex)
    for name, df in raw_views(spark, SF_SMALL).items():
        write_raw_csv(df, f"{drop}/{name}", ENTITIES[name])
    store = LayerStore(scratch_path(spark, "run", uuid.uuid4().hex))
    run = run_layered(spark, read_raw_drop(spark, drop), store, cfg)

    assert {"process_layer", "curate_layer", "mart_layer", "dq_metrics"} <= set(run.seconds)
    for mart, key in (("seller_performance", "mart_seller_performance"),
                      ("customer_rfm", "mart_customer_rfm"),
                      ("daily_sales_mart", "mart_daily_sales")):
        assert _same(store.read(spark, ANALYTICS, mart), QUERIES[key](spark, SF_SMALL)), mart

    dq = {(r.table_name, r.metric): r.value for r in store.read(spark, ANALYTICS, "dq_metrics").collect()}
    # the run's metrics == the oracle-checked dq_* keys
    for key in ("dq_orders", "dq_customers", "dq_order_items", "dq_products"):
        expected = {(r.table_name, r.metric): r.value for r in QUERIES[key](spark, SF_SMALL).collect()}
        assert expected.items() <= dq.items(), key
    assert dq[("seller_performance", "row_count")] > 0
    assert len([k for k in dq if k[1] == "curated_output_rows"]) == len(ENTITIES)


def test_unpinned_run_stamps_one_load_timestamp(spark):
    from strata.config import RunConfig
    store = LayerStore(scratch_path(spark, "run", uuid.uuid4().hex))
    raw = {n: df for n, df in raw_views(spark, SF_SMALL).items() if n in ("orders", "sellers")}
    run = run_layered(spark, raw, store, RunConfig(), names=["orders", "sellers"],
                      layers=["process", "curate"])
    stamps = set()
    for layer in ("processed_layer", "curated_layer"):
        for n in ("orders", "sellers"):
            stamps |= {r[0] for r in store.read(spark, layer, n).select("load_timestamp").distinct().collect()}
    assert stamps == {run.cfg.load_ts}


def test_driver_program_runs_a_drop(spark):
    import json
    import os
    import subprocess
    import sys
    drop = scratch_path(spark, "drop", uuid.uuid4().hex)
    for name, df in raw_views(spark, SF_SMALL).items():
        write_raw_csv(df, f"{drop}/{name}", ENTITIES[name])
    wh = scratch_path(spark, "wh", uuid.uuid4().hex)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run(
        [sys.executable, "-m", "strata", "--drop", drop, "--warehouse", wh,
         "--load-ts", "2024-01-01T00:00:00", "--as-of", "2002-01-01", "--buckets", "3", "--balance"],
        cwd=root, capture_output=True, text=True, timeout=600, check=True)
    report = json.loads(out.stdout.strip().splitlines()[-1])
    assert set(report["seconds"]) >= {"process_layer", "curate_layer", "mart_layer", "dq_metrics"}
    got = LayerStore(wh).read(spark, ANALYTICS, "daily_sales_mart")
    assert _same(got, QUERIES["mart_daily_sales"](spark, SF_SMALL))


def test_layers_can_run_separately(spark, cfg):
    """process, then curate, then marts as separate runs over one store give
    the same marts as one full run (each run reads the layer before it)."""
    store = LayerStore(scratch_path(spark, "run", uuid.uuid4().hex))
    raw = raw_views(spark, SF_SMALL)
    run_layered(spark, raw, store, cfg, layers=["process"])
    run_layered(spark, None, store, cfg, layers=["curate"])
    run = run_layered(spark, None, store, cfg, layers=["marts"])
    assert set(run.seconds) == {"mart_layer", "dq_metrics"}
    got = store.read(spark, ANALYTICS, "daily_sales_mart")
    assert _same(got, QUERIES["mart_daily_sales"](spark, SF_SMALL))


def test_driver_program_runs_as_a_script_from_any_folder(tmp_path):
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, os.path.join(root, "strata", "__main__.py"), "--help"],
                         cwd=tmp_path, capture_output=True, text=True, timeout=120, check=True)
    assert "--layers" in out.stdout and "--warehouse" in out.stdout


def test_a_run_that_fails_in_a_later_layer_changes_no_table(spark, cfg):
    import dataclasses
    import datetime as dt

    import pytest
    from pyspark.sql import functions as F
    store = LayerStore(scratch_path(spark, "run", uuid.uuid4().hex))
    raw = {n: df for n, df in raw_views(spark, SF_SMALL).items() if n in ("orders", "sellers")}
    args = dict(names=["orders", "sellers"], layers=["process", "curate"])
    run_layered(spark, raw, store, cfg, **args)
    before = store.published(spark)
    later = dataclasses.replace(cfg, load_ts=dt.datetime(2030, 1, 1))
    bad = raw["sellers"].withColumn("seller_city", F.when(F.col("seller_id") == "3", F.raise_error(F.lit("lost")))
                                    .otherwise(F.col("seller_city")))
    with pytest.raises(Exception, match="lost"):
        run_layered(spark, {**raw, "sellers": bad}, store, later, **args)
    assert store.published(spark) == before
    for layer in ("processed_layer", "curated_layer"):
        stamps = {r[0] for n in ("orders", "sellers")
                  for r in store.read(spark, layer, n).select("load_timestamp").distinct().collect()}
        assert stamps == {cfg.load_ts}
    run_layered(spark, raw, store, later, **args)
    assert {r[0] for r in store.read(spark, "curated_layer", "orders").select("load_timestamp").distinct().collect()} == {
        later.load_ts}
