"""Scalar functions (casts, trims, money rounding, date parts, lineage)."""

from strata.functions.scalars import (
    date_parts,
    int_avg,
    lineage,
    load_timestamp,
    money_avg,
    money_sum,
    parse_timestamp,
    recency_days,
    round_money,
    safe_cast,
    trim_text,
)

__all__ = ["date_parts", "int_avg", "lineage", "load_timestamp", "money_avg", "money_sum",
           "parse_timestamp", "recency_days", "round_money", "safe_cast", "trim_text"]
