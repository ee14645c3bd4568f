"""Layer tables: processed / curated / analytics, stored as Parquet directories.

A layer write replaces the whole table. Each write goes to a new version folder
of the table. Which versions are the tables is said by publications: small JSON
files, each naming one version per table that its run wrote, put in place by a
rename once all of these are finished. A table's version is that of the newest
publication which names it. So the tables of a run appear together: a run that
fails half-way leaves the old set in place, not new orders beside old items.

Writing a layer is also what cuts lineage between layers: a lost executor in a
later layer recomputes from the last written layer, never from the raw drop.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

PROCESSED = "processed_layer"
CURATED = "curated_layer"
ANALYTICS = "analytics_layer"

SUCCESS = "_SUCCESS"
RUNS = "_runs"  # folder of the publications
LAYOUT = "_layout.json"  # how a version is bucketed, beside its files
KEEP = 2        # published versions left of a table: the new one, and the one that readers may still hold
# Curated tables that the marts join on the order: see ``LayerStore.buckets``.
BY_ORDER = {f"{CURATED}/{t}": ("order_id",) for t in ("orders", "order_items", "reviews")}
UNPUBLISHED_HOURS = 72.0  # versions that no run published go when older; must exceed the longest run


def _stamp(prefix: str) -> str:
    """A name that sorts by time."""
    return f"{prefix}{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def _stamp_time(name: str) -> float | None:
    """Seconds since the epoch from a stamped name; None for other names."""
    digits = name[1:21]
    return int(digits) / 1e9 if len(name) == 30 and digits.isdigit() else None


@dataclass(frozen=True)
class LayerStore:
    """``buckets``: table -> key columns whose versions are written in ``n_buckets`` buckets, so that joins and
    aggregates on these columns need no exchange. A bucket is one task's work: leave a table out if one key
    holds much of it. ``balance`` splits hot partitions and merges small ones before a write, at the price of an
    exchange; a bucketed write has one of its own."""

    root: str
    unpublished_hours: float = UNPUBLISHED_HOURS
    buckets: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    n_buckets: int = 0
    balance: bool = False

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    # -- the folder, through the file system that Spark uses for it ------------
    def _fs(self, spark: SparkSession, path: str) -> tuple[object, object]:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at

    def _names(self, spark: SparkSession, path: str) -> list[str]:
        fs, at = self._fs(spark, path)
        return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []

    def _finished(self, spark: SparkSession, path: str) -> bool:
        fs, at = self._fs(spark, f"{path}/{SUCCESS}")
        return fs.exists(at)

    def _get(self, spark: SparkSession, path: str) -> dict:
        fs, at = self._fs(spark, path)
        stream = fs.open(at)
        try:
            return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _put(self, spark: SparkSession, path: str, content: dict) -> None:
        fs, at = self._fs(spark, path)
        stream = fs.create(at)
        try:
            stream.write(bytearray(json.dumps(content, sort_keys=True).encode()))
        finally:
            stream.close()

    # -- publications ----------------------------------------------------------
    def _publications(self, spark: SparkSession) -> list[tuple[str, dict[str, str]]]:
        """(name, {layer/table: version}) of each publication, oldest first."""
        out = []
        for name in self._names(spark, f"{self.root}/{RUNS}"):
            if not name.endswith(".json"):
                continue
            out.append((name, self._get(spark, f"{self.root}/{RUNS}/{name}")))
        return out

    def published(self, spark: SparkSession) -> dict[str, str]:
        """The version of every table, as of now."""
        now: dict[str, str] = {}
        for _, versions in self._publications(spark):
            now |= versions
        return now

    def publish(self, spark: SparkSession, versions: dict[str, str]) -> None:
        """Put finished versions in place, all at once; then remove what nobody reads any more."""
        if not versions:
            return
        for table, version in versions.items():
            if not self._finished(spark, f"{self.root}/{table}/{version}"):
                raise FileNotFoundError(f"version {version} of {table} is not finished")
        name = _stamp("r")
        fs, draft = self._fs(spark, f"{self.root}/{RUNS}/{name}.draft")
        self._put(spark, f"{self.root}/{RUNS}/{name}.draft", versions)
        if not fs.rename(draft, self._fs(spark, f"{self.root}/{RUNS}/{name}.json")[1]):
            raise OSError(f"publication {name} could not be put in place under {self.root}")
        self.clean(spark, versions)

    def clean(self, spark: SparkSession, tables: dict[str, str] | list[str] | None = None) -> list[str]:
        """Remove old versions of ``tables`` (default: all published ones); returns the folders removed.

        Of published versions the newest ``KEEP`` stay. Versions that no run
        published, finished or not, stay while they may belong to a run still
        going on (``unpublished_hours``).
        """
        publications = self._publications(spark)
        history: dict[str, list[str]] = {}
        for _, versions in publications:
            for table, version in versions.items():
                history.setdefault(table, []).append(version)
        oldest = time.time() - self.unpublished_hours * 3600
        removed = []
        for table in tables if tables is not None else history:
            known = list(dict.fromkeys(reversed(history.get(table, []))))  # newest first
            for name in self._names(spark, f"{self.root}/{table}"):
                age = _stamp_time(name)
                if age is None or name in known[:KEEP] or (name not in known and age >= oldest):
                    continue
                fs, at = self._fs(spark, f"{self.root}/{table}/{name}")
                if fs.delete(at, True):
                    removed.append(f"{self.root}/{table}/{name}")
        # a publication goes when each of its tables has KEEP newer ones
        seen: dict[str, int] = {}
        for name, versions in reversed(publications):
            if all(seen.get(t, 0) >= KEEP for t in versions):
                fs, at = self._fs(spark, f"{self.root}/{RUNS}/{name}")
                fs.delete(at, False)
            for t in versions:
                seen[t] = seen.get(t, 0) + 1
        for name in self._names(spark, f"{self.root}/{RUNS}"):
            if name.endswith(".draft") and (_stamp_time(name.removesuffix(".draft")) or oldest) < oldest:
                fs, at = self._fs(spark, f"{self.root}/{RUNS}/{name}")
                fs.delete(at, False)
        return removed

    # -- tables ----------------------------------------------------------------
    def write_version(self, df: DataFrame, layer: str, table: str) -> str:
        """Write a version that nobody reads yet; returns its name."""
        version = _stamp("v")
        folder = f"{self.path(layer, table)}/{version}"
        mark = ("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
        keys = self.buckets.get(f"{layer}/{table}") if self.n_buckets else None
        if not keys:
            (df.hint("rebalance") if self.balance else df).write.option(*mark).parquet(folder)
            return version
        # a task per bucket, so a file per bucket; the table's entry in the catalog goes, its files stay
        spark, name = df.sparkSession, f"strata_{uuid.uuid4().hex}"
        (df.repartition(self.n_buckets, *keys).write.format("parquet").option(*mark).option("path", folder)
         .bucketBy(self.n_buckets, *keys).sortBy(*keys).saveAsTable(name))
        spark.sql(f"DROP TABLE {name}")
        self._put(spark, f"{folder}/{LAYOUT}", {"keys": list(keys), "buckets": self.n_buckets})
        return version

    def read_version(self, spark: SparkSession, layer: str, table: str, version: str) -> DataFrame:
        """The rows of a version, known to be bucketed if they are."""
        folder = f"{self.path(layer, table)}/{version}"
        plain = spark.read.parquet(folder)
        fs, at = self._fs(spark, f"{folder}/{LAYOUT}")
        if not fs.exists(at):
            return plain
        layout, name = self._get(spark, f"{folder}/{LAYOUT}"), f"strata_{uuid.uuid4().hex}"
        keys = ", ".join(f"`{k}`" for k in layout["keys"])
        spark.sql(f"CREATE TABLE {name} ({plain.schema.toDDL()}) USING parquet CLUSTERED BY ({keys}) "
                  f"SORTED BY ({keys}) INTO {layout['buckets']} BUCKETS LOCATION '{folder}'")
        df = spark.table(name)  # resolved to its files here
        spark.sql(f"DROP TABLE {name}")
        return df

    def current(self, spark: SparkSession, layer: str, table: str) -> str:
        """The folder of the published version."""
        version = self.published(spark).get(f"{layer}/{table}")
        if version is None:
            raise FileNotFoundError(f"no published version of {layer}.{table} under {self.root}")
        return f"{self.path(layer, table)}/{version}"

    def write(self, df: DataFrame, layer: str, table: str) -> str:
        """Replace one table, as a run of its own; returns the folder of the new version."""
        version = self.write_version(df, layer, table)
        self.publish(df.sparkSession, {f"{layer}/{table}": version})
        return f"{self.path(layer, table)}/{version}"

    def read(self, spark: SparkSession, layer: str, table: str) -> DataFrame:
        return self.read_version(spark, layer, table, self.current(spark, layer, table).rpartition("/")[2])

    def begin(self, spark: SparkSession) -> "StoreRun":
        """A run over the tables as they are now; see ``StoreRun``."""
        return StoreRun(self, spark, self.published(spark))


@dataclass
class StoreRun:
    """Reads one consistent set of tables, with the run's own writes in front, and publishes these together.

    Tables that others publish meanwhile are not seen. Nothing is published
    unless ``publish`` is called; as a context manager, at the end of a block
    that did not fail.
    """

    store: LayerStore
    spark: SparkSession
    base: dict[str, str]
    written: dict[str, str] = field(default_factory=dict)

    def write(self, df: DataFrame, layer: str, table: str) -> str:
        self.written[f"{layer}/{table}"] = self.store.write_version(df, layer, table)
        return f"{self.store.path(layer, table)}/{self.written[f'{layer}/{table}']}"

    def read(self, spark: SparkSession, layer: str, table: str) -> DataFrame:
        version = (self.base | self.written).get(f"{layer}/{table}")
        if version is None:
            raise FileNotFoundError(f"no published version of {layer}.{table} under {self.store.root}")
        return self.store.read_version(spark, layer, table, version)

    def publish(self) -> None:
        self.store.publish(self.spark, self.written)
        self.base, self.written = self.base | self.written, {}

    def __enter__(self) -> "StoreRun":
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is None:
            self.publish()
