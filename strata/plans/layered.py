"""End-to-end run: 9 process -> 9 curate -> 3 marts, a barrier between layers.

``compose_*`` build a lineage lazily as one plan. The ``write_*`` helpers are
the production shape: each layer is written as a table in the shared folder
before the next layer reads it. The write cuts lineage (an executor lost
while building a mart recomputes from the curated files, never from the raw
drop), and a table read by several consumers -- curated orders and items feed
all three marts -- is computed once instead of once per consumer.
"""

from __future__ import annotations

import datetime as dt
import time
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from strata.config import RunConfig
from strata.operators import quality
from strata.plans.curate import CURATE
from strata.plans.marts import MARTS, build_marts
from strata.plans.process import PROCESS
from strata.sources.layers import ANALYTICS, CURATED, PROCESSED, LayerStore, StoreRun


# Which raw columns each data-quality profile checks.
RAW_CHECKS = {
    "orders": dict(key=("order_id",),
                   nulls=("order_id", "customer_id", "order_purchase_timestamp")),
    "customers": dict(key=("customer_id",),
                      nulls=("customer_id", "customer_unique_id", "customer_city", "customer_state")),
    "order_items": dict(key=("order_id", "order_item_id"),
                        nulls=("order_id", "order_item_id", "product_id", "seller_id"),
                        negatives=("price", "freight_value")),
    "products": dict(key=None, nulls=("product_id",)),
}


def compose_processed(raw: dict[str, DataFrame], cfg: RunConfig) -> dict[str, DataFrame]:
    return {name: fn(raw[name], cfg) for name, fn in PROCESS.items()}


def compose_curated(raw: dict[str, DataFrame], cfg: RunConfig) -> dict[str, DataFrame]:
    processed = compose_processed(raw, cfg)
    return {name: fn(processed[name], cfg) for name, fn in CURATE.items()}


def compose_marts(raw: dict[str, DataFrame], cfg: RunConfig) -> dict[str, DataFrame]:
    return build_marts(compose_curated(raw, cfg), cfg)


# Independent tables of one layer are submitted as concurrent Spark jobs, so
# small tables and the tail tasks of big ones do not leave executors idle.
LAYER_JOB_PARALLELISM = 4


def write_layer(spark: SparkSession, store: LayerStore | StoreRun, layer: str,
                tables: dict[str, DataFrame],
                parallelism: int = LAYER_JOB_PARALLELISM) -> dict[str, DataFrame]:
    """Write each table (independent jobs, run concurrently), then return
    DataFrames that read the written files. Returns only when every table of
    the layer is written: the barrier before the next layer."""
    workers = max(1, min(parallelism, len(tables)))
    if workers == 1:
        for name, df in tables.items():
            store.write(df, layer, name)
    else:
        def write_one(name: str, df: DataFrame) -> None:
            # one scheduler pool per table job: FAIR shares executors between pools
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"{layer}.{name}")
            try:
                store.write(df, layer, name)
            finally:
                spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

        with ThreadPoolExecutor(max_workers=workers) as pool:
            futures = [pool.submit(write_one, name, df) for name, df in tables.items()]
            for f in futures:
                f.result()
    return {name: store.read(spark, layer, name) for name in tables}


def pin_run_time(cfg: RunConfig) -> RunConfig:
    """Fix "now" once per run so every table of the run carries the same
    ``load_timestamp`` / ``as_of``, whichever layer or retry computes it."""
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    return replace(cfg, load_ts=cfg.load_ts or now, as_of=cfg.as_of or now.date())


@dataclass
class LayeredRun:
    store: LayerStore
    cfg: RunConfig
    seconds: dict[str, float] = field(default_factory=dict)


LAYERS = ("process", "curate", "marts")
MART_INPUTS = ("orders", "order_items", "sellers", "reviews", "customers")


def run_layered(spark: SparkSession, raw: dict[str, DataFrame] | None, store: LayerStore,
                cfg: RunConfig, names: Iterable[str] | None = None,
                parallelism: int = LAYER_JOB_PARALLELISM,
                layers: Iterable[str] = LAYERS) -> LayeredRun:
    """Materialise the selected layers in order; returns per-layer wall times.

    ``names`` limits the process/curate layers to some entities and
    ``layers`` to some of process / curate / marts. A layer that is not run is
    read from ``store``, as each original job reads the previous layer's
    table, so e.g. ``layers=["marts"]`` rebuilds only the marts. All tables of
    the run are published together at its end; a run that fails leaves the
    tables of the last one.
    """
    held: list[DataFrame] = []
    try:
        with store.begin(spark) as tables:
            return _run_layers(spark, raw, store, tables, cfg, names, parallelism, layers, held)
    finally:
        for df in held:
            df.unpersist()


def _run_layers(spark: SparkSession, raw: dict[str, DataFrame] | None, home: LayerStore, store: StoreRun,
                cfg: RunConfig, names: Iterable[str] | None, parallelism: int, layers: Iterable[str],
                held: list[DataFrame]) -> LayeredRun:
    cfg = pin_run_time(cfg)
    run = LayeredRun(home, cfg)
    names = list(names or PROCESS)
    layers = set(layers)
    unknown = layers - set(LAYERS)
    if unknown:
        raise ValueError(f"unknown layers: {sorted(unknown)}")

    def timed(step: str, fn):
        t0 = time.perf_counter()
        out = fn()
        run.seconds[step] = time.perf_counter() - t0
        return out

    parts = []
    processed: dict[str, DataFrame] = {}
    curated: dict[str, DataFrame] = {}
    if "process" in layers:
        # a checked table is read once: one exchange gives the rows that stay and the counts of all rows.
        # Both wait on the executors (in memory, beyond it on disk) for the run; a part that is lost is computed again.
        checked = [n for n in names if n in RAW_CHECKS]
        checks = {n: quality.raw_checks(RAW_CHECKS[n]["nulls"], RAW_CHECKS[n].get("negatives", ())) for n in checked}
        profiles = {n: PROCESS[n].profiled(raw[n], checks[n], RAW_CHECKS[n]["key"]).persist(StorageLevel.MEMORY_AND_DISK)
                    for n in checked}
        held += profiles.values()
        processed = timed("process_layer", lambda: write_layer(spark, store, PROCESSED, {
            n: PROCESS[n].from_profile(profiles[n], cfg) if n in profiles else PROCESS[n](raw[n], cfg) for n in names},
            parallelism))
        for n in checked:
            parts.append(quality.profile_metrics(profiles[n], n, list(checks[n]), RAW_CHECKS[n]["key"] is not None)
                         .unionByName(quality.count_metric(processed[n], n, "processed_rows")))
    if "curate" in layers:
        source = processed or {n: store.read(spark, PROCESSED, n) for n in names}
        curated = timed("curate_layer", lambda: write_layer(
            spark, store, CURATED, {n: CURATE[n](source[n], cfg) for n in names}, parallelism))
        parts.append(quality.layer_counts({n: (source[n], curated[n]) for n in names}))
    if "marts" in layers:
        inputs = {n: curated[n] if n in curated else store.read(spark, CURATED, n) for n in MART_INPUTS}
        built = build_marts(inputs, cfg)
        marts = timed("mart_layer", lambda: write_layer(
            spark, store, ANALYTICS, {m: built[m] for m in MARTS}, parallelism))
        parts.append(quality.row_counts(marts))
    # Data-quality report of the run, one long table.
    if parts:
        timed("dq_metrics", lambda: store.write(quality.union_all(parts), ANALYTICS, "dq_metrics"))
    return run
