"""Joins whose hot keys can be split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TAG = "__strata_tag"


def split_join(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``on`` with a fresh exchange on both sides.

    Adaptive execution splits a hot key only between two exchanges. A side
    that was just aggregated, or reduced by a window, on the key would be
    joined where it lies, in one task per key; the extra hash column makes
    both sides be dealt anew. Use it where the other side's rows per key are
    few and this side's may be many.
    """
    on = [on] if isinstance(on, str) else list(on)
    tag = lambda df: df.withColumn(_TAG, F.xxhash64(*on))
    return tag(left).join(tag(right), [_TAG, *on], how).drop(_TAG)
