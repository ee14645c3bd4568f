"""Session construction and the shared work folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "strata", extra: dict | None = None) -> SparkSession:
    """A session configured the way every layer expects it.

    UTC session time (timestamps in the layers are instants), AQE on so the
    shuffle partition count, join strategy and skewed partitions are re-planned
    from runtime sizes, and no UI server.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # concurrent per-table jobs of one layer share executors fairly
        "spark.scheduler.mode": "FAIR",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> None:
    """Layer timestamps are interpreted in UTC (the original marts pin UTC too)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for written layers and lineage cuts.

    Taken from ``spark.checkpoint.dir`` as the cluster sets it. Only a local
    session (tests, the bench) may fall back to a fresh temporary folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d.rstrip("/")
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect client has no SparkContext
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    d = tempfile.mkdtemp(prefix="strata-")
    if sc is None:
        return d
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared folder (``file:`` prefixes are kept as given)."""
    return "/".join([shared_dir(spark), *parts])


def scratch_folder(spark: SparkSession, *parts: str) -> str:
    """A folder under the shared one that goes when the driver's JVM ends.

    Lazy results may read it until then, so it can't go earlier by itself;
    long-lived drivers remove it when they are done with what reads it.
    """
    folder = scratch_path(spark, *parts)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(at)
    fs.deleteOnExit(at)
    return folder
