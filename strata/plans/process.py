"""Process layer: raw strings -> typed rows with lineage, one row per key.

Each transform casts in place (``withColumns``, so unmentioned raw columns pass
through as text), adds lineage, keeps valid rows, then keeps one row per key.

Validity runs *before* the dedupe: for any key with at least one valid row a
valid row is kept (one of the outcomes an arbitrary-survivor dedupe allows), and
the predicates run before the shuffle, key predicates reaching the scan.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.config import RunConfig
from strata.functions.scalars import date_parts, lineage, safe_cast
from strata.operators.dedupe import first_and_counts, keep_first, survivors
from strata.operators.filters import in_range, non_negative, not_null
from strata.specs import (CATEGORY_TRANSLATION, CUSTOMERS, GEOLOCATION, ORDER_ITEMS,
                          ORDERS, PAYMENTS, PRODUCTS, REVIEWS, SELLERS)

ORDER_TIMESTAMPS = ("order_purchase_timestamp", "order_approved_at",
                    "order_delivered_carrier_date", "order_delivered_customer_date",
                    "order_estimated_delivery_date")


def _as_text(*cols: str) -> dict:
    return {c: F.col(c).cast("string") for c in cols}


@dataclass(frozen=True)
class Process:
    """One entity's transform: cast in place, add lineage, keep valid rows, keep one row per key."""

    key: tuple[str, ...]
    typed: Callable[[DataFrame], DataFrame]
    valid: Callable[[], Column] | None = None
    lineage: bool = True
    retyped_key: bool = False  # raw texts that differ may be one typed key

    def __call__(self, raw: DataFrame, cfg: RunConfig) -> DataFrame:
        df = self.typed(raw)
        if self.lineage:
            df = df.select("*", *lineage(cfg.record_source, cfg))
        if self.valid:
            df = df.filter(self.valid())
        return keep_first(df, self.key)

    def profiled(self, raw: DataFrame, checks: Mapping[str, Column], key: Sequence[str] | None = None) -> DataFrame:
        """One exchange for survivors and counts: a row per raw key value with its first valid typed row, the
        number of raw rows and how many meet each of ``checks`` (conditions on raw columns)."""
        names = {f"__check_{n}": c for n, c in checks.items()}
        names |= {f"__raw_{k}": F.col(k) for k in (key or self.key)}
        df = self.typed(raw.withColumns(names))
        business = [c for c in df.columns if c not in names]
        return first_and_counts(df, [f"__raw_{k}" for k in (key or self.key)], business, self.key,
                                self.valid() if self.valid else F.lit(True), {n: F.col(f"__check_{n}") for n in checks})

    def from_profile(self, profile: DataFrame, cfg: RunConfig) -> DataFrame:
        """What ``self(raw, cfg)`` gives, from ``profiled``."""
        df = survivors(profile)
        if self.lineage:
            df = df.select("*", *lineage(cfg.record_source, cfg))
        return keep_first(df, self.key) if self.retyped_key else df


def _orders(raw: DataFrame) -> DataFrame:
    df = raw.withColumns({
        **_as_text("order_id", "customer_id", "order_status"),
        **{c: safe_cast(c, "timestamp") for c in ORDER_TIMESTAMPS},
    })
    return df.select("*", *date_parts("order_purchase_timestamp", "order_purchase"))


def _order_items(raw: DataFrame) -> DataFrame:
    return raw.withColumns({
        **_as_text("order_id", "product_id", "seller_id"),
        "order_item_id": safe_cast("order_item_id", "int"),
        "shipping_limit_date": safe_cast("shipping_limit_date", "timestamp"),
        "price": safe_cast("price", "double"),
        "freight_value": safe_cast("freight_value", "double"),
    })


def _payments(raw: DataFrame) -> DataFrame:
    return raw.withColumns({**_as_text("order_id"), "payment_value": safe_cast("payment_value", "double")})


def _reviews(raw: DataFrame) -> DataFrame:
    return raw.withColumns({**_as_text("review_id"), "review_score": safe_cast("review_score", "int")})


def _texts(*cols: str) -> Callable[[DataFrame], DataFrame]:
    return lambda raw: raw.withColumns(_as_text(*cols))


def _unchanged(raw: DataFrame) -> DataFrame:
    return raw


PROCESS = {
    "orders": Process(ORDERS.key, _orders,
                      lambda: not_null("order_id", "customer_id", "order_purchase_timestamp")),
    "order_items": Process(ORDER_ITEMS.key, _order_items,
                           lambda: not_null("order_id", "order_item_id", "product_id", "seller_id")
                           & non_negative("price", "freight_value"), retyped_key=True),
    "customers": Process(CUSTOMERS.key, _texts(*CUSTOMERS.columns),
                         lambda: not_null("customer_id", "customer_unique_id")),
    "products": Process(PRODUCTS.key, _texts("product_id", "product_category_name"), lambda: not_null("product_id")),
    "sellers": Process(SELLERS.key, _texts("seller_id", "seller_city", "seller_state"),
                       lambda: not_null("seller_id")),
    "payments": Process(PAYMENTS.key, _payments, lambda: not_null("order_id")),
    "reviews": Process(REVIEWS.key, _reviews, lambda: in_range("review_score", 1, 5)),
    # dedupe only: no cast, no lineage, and a null key survives as one row
    "category_translation": Process(CATEGORY_TRANSLATION.key, _unchanged, lineage=False),
    # (zip, lat, lng) compared as text; no lineage
    "geolocation": Process(GEOLOCATION.key, _unchanged, lineage=False),
}
