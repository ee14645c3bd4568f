"""Exact distinct counts that merge, as bit masks of whole numbers.

``countDistinct`` beside other aggregates needs the rows once more (a scan of
their own, or Expand). Line positions are small whole numbers, so a set of
them fits a few 64-bit masks, which ``bit_or`` merges at every grain on the
way up. A number n is bit n % 64 of slot n / 64; slot 0 rides in the row that
carries the other measures (the main row), other slots and ids that are no
plain whole number get rows of their own. So a key with positions below 64
costs eight bytes, and one with any number of them a row per 64, which a hash
exchange spreads. (Spark's bitmap aggregates hold 4 KB per group, too much for
an order with three lines.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 64
SLOT, ODD, MASK = "__strata_slot", "__strata_odd", "__strata_mask"
KEYS = [SLOT, ODD]  # group by these besides the key


def main() -> Column:
    """True for the row that carries a key's other measures."""
    return (F.col(SLOT) == 0) & F.col(ODD).isNull()


def with_slots(df: DataFrame, id_col: str) -> DataFrame:
    """``df`` with slot, odd id and mask of ``id_col`` (compared as text; null is no value).

    Every row stays once as a main row; a row whose id has no bit there comes
    a second time. Measures must be taken of main rows only (``measure``).
    """
    text = F.col(id_col).cast("string")
    n = text.try_cast("bigint")
    plain = (n >= 0) & (n.cast("string") == text)  # '01', '+1' and ' 1' are texts of their own
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (n % BITS).cast("int"))
    slot = F.shiftright(n, 6)  # n / BITS
    row = lambda s, o, m: F.struct(s.cast("bigint").alias(SLOT), o.cast("string").alias(ODD),
                                   m.cast("bigint").alias(MASK))
    none = F.lit(None)
    entries = (F.when(text.isNull(), F.array(row(F.lit(0), none, none)))
               .when(F.coalesce(plain & (n < BITS), F.lit(False)), F.array(row(F.lit(0), none, bit)))
               .when(F.coalesce(plain, F.lit(False)), F.array(row(F.lit(0), none, none), row(slot, none, bit)))
               .otherwise(F.array(row(F.lit(0), none, none), row(F.lit(0), text, none))))
    return df.select("*", F.inline(entries))


def measure(c: Column | str) -> Column:
    """The value on main rows, null on the others."""
    return F.when(main(), F.col(c) if isinstance(c, str) else c)


def merged() -> Column:
    """The mask of a group that has ``KEYS`` among its keys."""
    return F.bit_or(MASK).alias(MASK)


def total() -> Column:
    """Distinct ids of a key, over its rows by slot and odd id."""
    return F.coalesce(F.sum(F.bit_count(MASK)), F.lit(0)).cast("bigint") + F.count(ODD)
