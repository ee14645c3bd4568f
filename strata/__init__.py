"""strata: layered commerce analytics (raw -> processed -> curated -> marts) on Spark.

Every transform is a ``DataFrame -> DataFrame`` function built from
``pyspark.sql.functions`` so Catalyst can prune, push down and plan shuffles.

    from strata import build_session, read_raw_drop, LayerStore, RunConfig, run_layered
    spark = build_session()
    run_layered(spark, read_raw_drop(spark, drop), LayerStore(warehouse), RunConfig())
"""

from strata.config import RunConfig
from strata.plans.layered import run_layered
from strata.session import build_session
from strata.sources import LayerStore, read_raw_csv, read_raw_drop

__all__ = ["RunConfig", "run_layered", "build_session", "LayerStore", "read_raw_csv", "read_raw_drop"]
