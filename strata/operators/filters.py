"""Validity predicates of the process and curate layers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def all_of(preds: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, preds)


def not_null(*cols: str) -> Column:
    """Every listed column is non-null."""
    return all_of([F.col(c).isNotNull() for c in cols])


def non_negative(*cols: str) -> Column:
    """Every listed number is ``>= 0`` (null fails; NaN passes, as NaN sorts
    above every number in Spark)."""
    return all_of([F.col(c) >= 0 for c in cols])


def in_range(c: str, low, high) -> Column:
    """``low <= c <= high`` (null fails)."""
    return F.col(c).between(low, high)


def not_blank(c: str) -> Column:
    """Non-null and not the empty string."""
    return F.col(c).isNotNull() & (F.col(c) != "")
