"""Scalar column functions used by every layer. All are built-in Spark
expressions, so they stay inside whole-stage codegen.

Spark 4 runs in ANSI mode: a plain ``cast`` throws on one bad value, whereas the
layers' contract is "bad value -> null -> filtered". Hence ``try_cast`` and
``try_to_timestamp`` everywhere a string is parsed.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.config import RunConfig

# Money is rounded to cents; sums of cents are exact in this type.
MONEY_SCALE = 2
MONEY_SUM = "decimal(38,2)"


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_cast(c: Column | str, to: str) -> Column:
    """Cast that yields null (not an error) for unparseable input."""
    return col_of(c).try_cast(to)


def parse_timestamp(c: Column | str) -> Column:
    """String -> timestamp with cast semantics; unparseable -> null."""
    return F.try_to_timestamp(col_of(c))


def trim_text(c: Column | str) -> Column:
    """Strip spaces at both ends (tabs are kept; ``'  '`` becomes ``''``, not null).

    A non-string input is turned into text first, as the curated layer does
    for ``order_item_id``.
    """
    return F.trim(col_of(c).cast("string"))


def round_money(c: Column | str, scale: int = MONEY_SCALE) -> Column:
    """``round(x, 2)`` HALF_UP of a double, as Spark rounds it: from the shortest
    decimal text of the value, once. NaN and infinities stay what they are."""
    return F.round(col_of(c), scale)


def _cents(x: Column) -> tuple[Column, Column]:
    """The value as whole cents, and whether that is exactly the value."""
    d = x.try_cast(MONEY_SUM)
    return d, F.coalesce(d.cast("double") == x, F.lit(False))


def money_parts(c: Column | str, name: str) -> list[Column]:
    """Additive aggregates from which ``money_total`` makes an exact sum later:
    cents that are exact, how many values are not, the plain sum, the count."""
    x = col_of(c)
    d, exact = _cents(x)
    return [F.try_sum(F.when(exact, d)).alias(f"{name}_cents"),
            F.count_if(x.isNotNull() & ~exact).alias(f"{name}_inexact"),
            F.sum(x).alias(f"{name}_plain"),
            F.count(x).alias(f"{name}_n")]


def money_merge(name: str) -> list[Column]:
    """``money_parts`` of rows of ``money_parts``. Cents that overflowed count as an inexact value."""
    cents, n, inexact = F.col(f"{name}_cents"), F.col(f"{name}_n"), F.col(f"{name}_inexact")
    return [F.try_sum(cents).alias(f"{name}_cents"),
            (F.sum(inexact) + F.count_if(cents.isNull() & (n > inexact))).alias(f"{name}_inexact"),
            F.sum(f"{name}_plain").alias(f"{name}_plain"),
            F.sum(n).alias(f"{name}_n")]


def money_total(name: str) -> Column:
    """Sum over rows of ``money_parts``: exact where all values are whole cents
    (so independent of the order of rows), else the plain sum of doubles, in
    which NaN and infinities show. Never fails; null without a value."""
    cents = F.try_sum(f"{name}_cents")
    lost = F.count_if(F.col(f"{name}_cents").isNull() & (F.col(f"{name}_n") > F.col(f"{name}_inexact")))
    return (F.when((F.sum(f"{name}_inexact") == 0) & (lost == 0) & cents.isNotNull(), cents.cast("double"))
            .otherwise(F.sum(f"{name}_plain")))


def money_sum(c: Column | str) -> Column:
    """Sum of money in one aggregate, by the rule of ``money_total``."""
    x = col_of(c)
    d, exact = _cents(x)
    cents = F.try_sum(F.when(exact, d))
    return (F.when((F.count_if(x.isNotNull() & ~exact) == 0) & cents.isNotNull(), cents.cast("double"))
            .otherwise(F.sum(x)))


def money_avg(c: Column | str) -> Column:
    """``money_sum`` over the number of the same non-null values (null when none)."""
    return F.try_divide(money_sum(c), F.count(col_of(c)).cast("double"))


def int_avg(c: Column | str) -> Column:
    """Average of an integer column (exact integer sum / count)."""
    x = col_of(c)
    return F.try_divide(F.sum(x.cast("bigint")).cast("double"), F.count(x).cast("double"))


def load_timestamp(cfg: RunConfig) -> Column:
    """The run's load time. A pinned value is passed as text and read in the
    session time zone (UTC), not in the driver process's local zone, which is
    what a naive Python datetime literal would use; an aware value is
    converted to UTC first."""
    if cfg.load_ts is None:
        return F.current_timestamp()
    ts = cfg.load_ts
    if ts.tzinfo is not None:
        ts = ts.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return F.lit(ts.isoformat(sep=" ")).cast("timestamp")


def as_of_date(cfg: RunConfig) -> Column:
    if cfg.as_of is None:
        return F.current_date()
    return F.lit(cfg.as_of).cast("date")


def lineage(record_source: str, cfg: RunConfig) -> list[Column]:
    """``record_source`` literal and ``load_timestamp`` of the run."""
    return [F.lit(record_source).alias("record_source"),
            load_timestamp(cfg).alias("load_timestamp")]


def date_parts(ts: Column | str, prefix: str) -> list[Column]:
    """``<prefix>_date``, ``_year``, ``_month`` of a timestamp."""
    t = col_of(ts)
    return [F.to_date(t).alias(f"{prefix}_date"),
            F.year(t).alias(f"{prefix}_year"),
            F.month(t).alias(f"{prefix}_month")]


def recency_days(last_date: Column | str, cfg: RunConfig) -> Column:
    """Days from the last order to the run date (``as_of``)."""
    return F.datediff(as_of_date(cfg), col_of(last_date))


def to_date_literal(d: dt.date) -> Column:
    return F.lit(d).cast("date")
