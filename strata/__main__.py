"""Driver program for one layered run (submit with spark-submit or python -m strata).

    spark-submit strata/__main__.py --drop <raw drop> --warehouse <layer root>

Reads the nine raw CSV entities from ``<drop>/<entity>/``, writes
``processed_layer``, ``curated_layer`` and ``analytics_layer`` (three marts and
``dq_metrics``) under ``<warehouse>``, and prints per-layer wall times.
Master, executors and ``spark.checkpoint.dir`` come from the cluster. Only the
driver imports this package: every transform is a JVM-side Spark expression,
so executors need no Python code from it.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os
import sys

if __package__ in (None, ""):  # run as a script (spark-submit strata/__main__.py)
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.config import RAW_RECORD_SOURCE, RunConfig
from strata.plans.layered import LAYER_JOB_PARALLELISM, LAYERS, run_layered
from strata.specs import ENTITIES
from strata.session import build_session
from strata.sources.csv import read_raw_drop
from strata.sources.layers import BY_ORDER, LayerStore


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description="Run raw -> processed -> curated -> marts")
    p.add_argument("--drop", help="folder with one sub-folder of CSV files per entity "
                                   "(needed when the process layer runs)")
    p.add_argument("--warehouse", required=True, help="root folder of the layer tables")
    p.add_argument("--record-source", default=RAW_RECORD_SOURCE)
    p.add_argument("--load-ts", type=dt.datetime.fromisoformat, default=None,
                   help="pin load_timestamp (default: now, fixed once for the run)")
    p.add_argument("--as-of", type=dt.date.fromisoformat, default=None,
                   help="pin the RFM recency date (default: today)")
    p.add_argument("--parallelism", type=int, default=LAYER_JOB_PARALLELISM,
                   help="table jobs of one layer submitted at once")
    p.add_argument("--layers", default=",".join(LAYERS),
                   help="comma-separated subset of process,curate,marts; others are read from the warehouse")
    p.add_argument("--tables", default=",".join(ENTITIES),
                   help="comma-separated entities for the process / curate layers")
    p.add_argument("--buckets", type=int, default=0,
                   help="write curated orders, order_items and reviews in this many buckets by order_id "
                        "(not for drops in which one order holds much of the rows)")
    p.add_argument("--balance", action="store_true", help="split hot and merge small partitions before each write")
    a = p.parse_args(argv)
    layers = [x for x in a.layers.split(",") if x]
    if "process" in layers and not a.drop:
        p.error("--drop is required when the process layer runs")

    spark = build_session(app_name="strata-layered-run")
    cfg = RunConfig(record_source=a.record_source, load_ts=a.load_ts, as_of=a.as_of)
    raw = read_raw_drop(spark, a.drop) if "process" in layers else None
    store = LayerStore(a.warehouse, buckets=BY_ORDER, n_buckets=a.buckets, balance=a.balance)
    run = run_layered(spark, raw, store, cfg,
                      names=[x for x in a.tables.split(",") if x],
                      parallelism=a.parallelism, layers=layers)
    print(json.dumps({"warehouse": a.warehouse, "load_ts": str(run.cfg.load_ts),
                      "seconds": {k: round(v, 2) for k, v in run.seconds.items()}}))
    spark.stop()


if __name__ == "__main__":
    main()
