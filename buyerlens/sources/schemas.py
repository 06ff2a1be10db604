"""Declared tables: column types, keys and value rules.

Timestamps carry no zone (``TimestampNTZType``), so calendar arithmetic never
depends on the session time zone. Length limits sit in the field metadata.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

MAX_LENGTH = "max_length"

MONEY = T.DecimalType(10, 2)
STAMP = T.TimestampNTZType()


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class Table:
    """What a table must look like; ``checks`` maps a rule name to a SQL predicate."""

    name: str
    schema: T.StructType
    primary_key: tuple[str, ...]
    foreign_keys: tuple[ForeignKey, ...] = ()
    checks: dict[str, str] = field(default_factory=dict)
    multiline: bool = False

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema if not f.nullable]

    @property
    def max_lengths(self) -> dict[str, int]:
        return {f.name: f.metadata[MAX_LENGTH] for f in self.schema if MAX_LENGTH in f.metadata}


def _text(name: str, limit: int | None = None, required: bool = False) -> T.StructField:
    metadata = {MAX_LENGTH: limit} if limit else {}
    return T.StructField(name, T.StringType(), not required, metadata)


def _id(name: str) -> T.StructField:
    return _text(name, 32, required=True)


def _value(name: str, kind: T.DataType, required: bool = False) -> T.StructField:
    return T.StructField(name, kind, not required)


# Table names, column names, types, limits, keys and rules are
# the interface of the source files and have to be exactly these.
CUSTOMERS = Table(
    "customers",
    T.StructType([
        _id("customer_id"),
        _id("customer_unique_id"),
        _text("customer_zip_code_prefix", 5, required=True),
        _text("customer_city", 100, required=True),
        _text("customer_state", 2, required=True),
    ]),
    primary_key=("customer_id",),
)

SELLERS = Table(
    "sellers",
    T.StructType([
        _id("seller_id"),
        _text("seller_zip_code_prefix", 5, required=True),
        _text("seller_city", 100, required=True),
        _text("seller_state", 2, required=True),
    ]),
    primary_key=("seller_id",),
)

PRODUCTS = Table(
    "products",
    T.StructType([
        _id("product_id"),
        _text("product_category_name", 100),
        _value("product_name_lenght", T.ShortType()),
        _value("product_description_lenght", T.ShortType()),
        _value("product_photos_qty", T.ShortType()),
        _value("product_weight_g", T.IntegerType()),
        _value("product_length_cm", T.ShortType()),
        _value("product_height_cm", T.ShortType()),
        _value("product_width_cm", T.ShortType()),
    ]),
    primary_key=("product_id",),
)

TRANSLATIONS = Table(
    "product_category_translation",
    T.StructType([
        _text("product_category_name", 100, required=True),
        _text("product_category_name_english", 100, required=True),
    ]),
    primary_key=("product_category_name",),
)

ORDERS = Table(
    "orders",
    T.StructType([
        _id("order_id"),
        _id("customer_id"),
        _text("order_status", 20, required=True),
        _value("order_purchase_timestamp", STAMP, required=True),
        _value("order_approved_at", STAMP),
        _value("order_delivered_carrier_date", STAMP),
        _value("order_delivered_customer_date", STAMP),
        _value("order_estimated_delivery_date", STAMP, required=True),
    ]),
    primary_key=("order_id",),
    foreign_keys=(ForeignKey("customer_id", "customers", "customer_id"),),
)

ORDER_ITEMS = Table(
    "order_items",
    T.StructType([
        _id("order_id"),
        _value("order_item_id", T.IntegerType(), required=True),
        _id("product_id"),
        _id("seller_id"),
        _value("shipping_limit_date", STAMP, required=True),
        _value("price", MONEY, required=True),
        _value("freight_value", MONEY, required=True),
    ]),
    primary_key=("order_id", "order_item_id"),
    foreign_keys=(
        ForeignKey("order_id", "orders", "order_id"),
        ForeignKey("product_id", "products", "product_id"),
        ForeignKey("seller_id", "sellers", "seller_id"),
    ),
    checks={"price_not_negative": "price >= 0", "freight_not_negative": "freight_value >= 0"},
)

ORDER_PAYMENTS = Table(
    "order_payments",
    T.StructType([
        _id("order_id"),
        _value("payment_sequential", T.IntegerType(), required=True),
        _text("payment_type", 20, required=True),
        _value("payment_installments", T.IntegerType(), required=True),
        _value("payment_value", MONEY, required=True),
    ]),
    primary_key=("order_id", "payment_sequential"),
    foreign_keys=(ForeignKey("order_id", "orders", "order_id"),),
)

ORDER_REVIEWS = Table(
    "order_reviews",
    T.StructType([
        _id("review_id"),
        _id("order_id"),
        _value("review_score", T.ShortType(), required=True),
        _text("review_comment_title"),
        _text("review_comment_message"),
        _value("review_creation_date", STAMP, required=True),
        _value("review_answer_timestamp", STAMP, required=True),
    ]),
    primary_key=("review_id",),
    foreign_keys=(ForeignKey("order_id", "orders", "order_id"),),
    checks={"score_in_range": "review_score BETWEEN 1 AND 5"},
    multiline=True,
)

TABLES: dict[str, Table] = {
    t.name: t
    for t in (
        CUSTOMERS, SELLERS, PRODUCTS, TRANSLATIONS,
        ORDERS, ORDER_ITEMS, ORDER_PAYMENTS, ORDER_REVIEWS,
    )
}
