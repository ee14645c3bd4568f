"""Deterministic deduplication: keep one row per key.

``dropDuplicates`` keeps an arbitrary row, so its output depends on partitioning.
``keep_first`` keeps the first row of each key under a total order instead:
``row_number() over (partition by key order by ...) = 1``.

Plan shape: Catalyst turns the ``rn = 1`` filter into a partial
``WindowGroupLimit`` that runs *before* the shuffle, so each map task sends at
most one row per key. A key holding a third of all rows therefore shuffles
only one row per map task, and the final per-key sort sees a handful of rows.
Null keys are equal to each other and collapse to one row, as in
``dropDuplicates``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.specs import LINEAGE_COLUMNS

_RN = "__strata_rn"
ROWS, FIRST = "__rows", "__first"


def order_columns(df: DataFrame, keys: Sequence[str],
                  exclude: Sequence[str] = LINEAGE_COLUMNS) -> list[str]:
    """All retained business columns except the keys: a total order up to
    fully identical rows."""
    return [c for c in df.columns if c not in keys and c not in exclude]


def ascending(cols: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in cols]


def keep_first(df: DataFrame, keys: Sequence[str],
               order: Sequence[Column] | None = None) -> DataFrame:
    """One row per ``keys``: the first under ``order`` (default: every other
    business column ascending, nulls last)."""
    if order is None:
        # a table of nothing but its key has equal rows per key: any order will do
        order = ascending(order_columns(df, keys) or keys)
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*order)
    return (df.withColumn(_RN, F.row_number().over(w))
            .filter(F.col(_RN) == 1)
            .drop(_RN))


def first_and_counts(df: DataFrame, group: Sequence[str], columns: Sequence[str], keys: Sequence[str],
                     valid: Column, counts: Mapping[str, Column]) -> DataFrame:
    """Per value of ``group`` (null is a value): ``__rows``, how many rows meet each of ``counts``, and in
    ``__first`` the valid row that ``keep_first`` over ``keys`` would keep (null if none is valid).

    One aggregate, so one exchange, gives both; its partial step sends at most
    one row per value and map task. Columns are ranked with nulls last.
    """
    order = order_columns(df.select(*columns), keys)
    ranked = [x for i, c in enumerate(order) for x in (F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"c{i}"))]
    rest = [F.col(c).alias(f"r{i}") for i, c in enumerate(columns) if c not in order]
    first = F.min(F.when(F.coalesce(valid, F.lit(False)), F.struct(*ranked, *rest)))
    at = {c: f"c{i}" for i, c in enumerate(order)} | {c: f"r{i}" for i, c in enumerate(columns) if c not in order}
    return (df.groupBy(*group).agg(F.count(F.lit(1)).alias(ROWS),
                                   *[F.count_if(c).alias(n) for n, c in counts.items()], first.alias(FIRST))
            .withColumn(FIRST, F.when(F.col(FIRST).isNotNull(),
                                      F.struct(*[F.col(FIRST)[at[c]].alias(c) for c in columns]))))


def survivors(profile: DataFrame) -> DataFrame:
    """The rows kept by ``first_and_counts``."""
    return profile.where(F.col(FIRST).isNotNull()).select(f"{FIRST}.*")
