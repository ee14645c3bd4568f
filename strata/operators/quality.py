"""Data-quality metrics as long-form DataFrames ``(table_name, metric, value)``.

The original jobs run one Spark job per metric (five scans of the raw file for
orders). Here every raw metric of a table comes out of one aggregation: rows
are first grouped by the key (partial aggregation map-side, so a hot key is
pre-counted before the shuffle), carrying per-key row / null / negative
counts, and one global aggregate then sums them and counts keys seen more than
once. Row counts of later layers are plain ``count`` aggregates; all pieces are
stacked with ``unionByName`` so one action computes them together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.scalars import safe_cast
from strata.operators.dedupe import ROWS


def _long(df: DataFrame, table: str) -> DataFrame:
    """One-row wide metrics -> (table_name, metric, value)."""
    metrics = df.columns
    return df.unpivot([], metrics, "metric", "value").select(
        F.lit(table).alias("table_name"), "metric", F.col("value").cast("bigint").alias("value"))


def count_metric(df: DataFrame, table: str, metric: str) -> DataFrame:
    """Row count of ``df`` as one (table_name, metric, value) row."""
    return df.agg(F.count(F.lit(1)).alias(metric)).transform(lambda d: _long(d, table))


def raw_checks(null_cols: Sequence[str] = (), negative_cols: Sequence[str] = ()) -> dict[str, Column]:
    """Conditions on a raw row by metric name: nulls, and negative numbers (text parsed as double)."""
    return {**{f"null_{c}": F.col(c).isNull() for c in null_cols},
            **{f"negative_{c}": safe_cast(c, "double") < 0 for c in negative_cols}}


def profile_metrics(profile: DataFrame, table: str, checks: Sequence[str], keyed: bool) -> DataFrame:
    """Metrics from rows per raw key value that hold ``__rows`` and a count per check."""
    wide = profile.agg(
        F.coalesce(F.sum(ROWS), F.lit(0)).alias("raw_rows"),
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in checks],
        *[F.count_if(F.col(ROWS) > 1).alias("duplicate_key_groups")] * keyed,
    )
    return _long(wide, table)


def raw_profile(df: DataFrame, table: str, key: Sequence[str] | None,
                null_cols: Sequence[str] = (), negative_cols: Sequence[str] = (),
                processed: DataFrame | None = None) -> DataFrame:
    """Raw rows, nulls per column, negative numbers (text parsed as double),
    number of key values occurring more than once (null is a value), and the
    processed row count."""
    checks = raw_checks(null_cols, negative_cols)
    per_row = [F.count(F.lit(1)).alias(ROWS), *[F.count_if(c).alias(n) for n, c in checks.items()]]
    out = profile_metrics(df.groupBy(*key).agg(*per_row) if key else df.agg(*per_row), table, list(checks), bool(key))
    if processed is not None:
        out = out.unionByName(count_metric(processed, table, "processed_rows"))
    return out


def layer_counts(pairs: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Input and output rows of the curate step, per table."""
    parts = []
    for table, (src, out) in pairs.items():
        parts.append(count_metric(src, table, "curated_input_rows"))
        parts.append(count_metric(out, table, "curated_output_rows"))
    return union_all(parts)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return union_all([count_metric(df, name, "row_count") for name, df in tables.items()])


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their row count (HAVING)."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))


def union_all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
