"""Declarative description of the nine raw entities.

Fixed values: raw column names (in file order, source misspellings kept) and
the natural key of each entity, as the raw CSV files define them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Entity:
    name: str
    columns: tuple[str, ...]
    key: tuple[str, ...]
    multiline: bool = False

    @property
    def raw_schema(self) -> T.StructType:
        """Every raw column is read as a nullable string; no inference."""
        return T.StructType([T.StructField(c, T.StringType(), True) for c in self.columns])


# Raw schemas and keys of the nine entities.
ORDERS = Entity(
    "orders",
    ("order_id", "customer_id", "order_status", "order_purchase_timestamp",
     "order_approved_at", "order_delivered_carrier_date",
     "order_delivered_customer_date", "order_estimated_delivery_date"),
    ("order_id",),
)
ORDER_ITEMS = Entity(
    "order_items",
    ("order_id", "order_item_id", "product_id", "seller_id",
     "shipping_limit_date", "price", "freight_value"),
    ("order_id", "order_item_id"),
)
CUSTOMERS = Entity(
    "customers",
    ("customer_id", "customer_unique_id", "customer_zip_code_prefix",
     "customer_city", "customer_state"),
    ("customer_id",),
)
PRODUCTS = Entity(
    "products",
    ("product_id", "product_category_name", "product_name_lenght",
     "product_description_lenght", "product_photos_qty", "product_weight_g",
     "product_length_cm", "product_height_cm", "product_width_cm"),
    ("product_id",),
)
SELLERS = Entity(
    "sellers",
    ("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"),
    ("seller_id",),
)
PAYMENTS = Entity(
    "payments",
    ("order_id", "payment_sequential", "payment_type", "payment_installments",
     "payment_value"),
    ("order_id", "payment_sequential"),
)
REVIEWS = Entity(
    "reviews",
    ("review_id", "order_id", "review_score", "review_comment_title",
     "review_comment_message", "review_creation_date", "review_answer_timestamp"),
    ("review_id",),
    multiline=True,
)
CATEGORY_TRANSLATION = Entity(
    "category_translation",
    ("product_category_name", "product_category_name_english"),
    ("product_category_name",),
)
GEOLOCATION = Entity(
    "geolocation",
    ("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng",
     "geolocation_city", "geolocation_state"),
    ("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"),
)

ENTITIES: dict[str, Entity] = {e.name: e for e in (
    ORDERS, ORDER_ITEMS, CUSTOMERS, PRODUCTS, SELLERS, PAYMENTS, REVIEWS,
    CATEGORY_TRANSLATION, GEOLOCATION,
)}

LINEAGE_COLUMNS = ("record_source", "load_timestamp")
