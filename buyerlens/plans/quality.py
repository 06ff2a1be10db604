"""Row counts and data-quality reports."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buyerlens.operators.cleaning import DELIVERED
from buyerlens.sources.schemas import TABLES

# Names under which the checks report.
DUPLICATE_CHECK = "reviews_doublons_restants"
DELIVERY_CHECK = "delivered_sans_date"
CATEGORY_CHECK = "produits_sans_categorie"
TRANSLATION_CHECK = "categories_sans_traduction"


def _rows() -> Column:
    return F.count(F.lit(1))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table, by table name."""
    counts = [
        tables[name].agg(_rows().alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name in TABLES if name in tables
    ]
    return reduce(DataFrame.unionByName, counts).orderBy("table_name")


def _named(check: str, df: DataFrame) -> DataFrame:
    return df.select(F.lit(check).alias("check_name"), "*")


def duplicate_count(df: DataFrame, key: str, check: str = DUPLICATE_CHECK) -> DataFrame:
    """Rows beyond one per key value. A row without a key counts as one too many."""
    keys = df.groupBy(key).agg(_rows().alias("rows"))
    surplus = F.col("rows") - F.when(F.col(key).isNull(), 0).otherwise(1)
    return _named(check, keys.agg(F.coalesce(F.sum(surplus), F.lit(0)).alias("duplicates")))


def delivered_without_date(orders: DataFrame) -> DataFrame:
    missing = (F.col("order_status") == DELIVERED) & F.col("order_delivered_customer_date").isNull()
    return _named(DELIVERY_CHECK, orders.where(missing).agg(_rows().alias("remaining")))


def products_without_category(products: DataFrame) -> DataFrame:
    missing = F.col("product_category_name").isNull()
    return _named(CATEGORY_CHECK, products.where(missing).agg(_rows().alias("remaining")))


def untranslated_categories(products: DataFrame, translations: DataFrame) -> DataFrame:
    """Distinct categories in use that have no translation."""
    name = "product_category_name"
    used = products.where(F.col(name).isNotNull()).select(name).distinct()
    missing = used.join(translations.select(name), name, "left_anti")
    return _named(TRANSLATION_CHECK, missing.agg(_rows().alias("missing")))


def zero_payments(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """Payments of zero by type and order status. They are reported, not changed."""
    zero = payments.where(F.col("payment_value") == 0).groupBy("order_id", "payment_type").agg(_rows().alias("rows"))
    return (
        zero.join(orders.select("order_id", "order_status"), "order_id")
        .groupBy("payment_type", "order_status")
        .agg(F.sum("rows").alias("payments"))
    )


def cleaning_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Six totals as text, by name; both order totals come from one scan."""
    def totals(table: str, **metrics: Column) -> DataFrame:
        pairs = F.array(*(
            F.struct(F.lit(name).alias("metric"), F.col(name).cast("string").alias("value")) for name in metrics
        ))
        counted = tables[table].agg(*(metric.alias(name) for name, metric in metrics.items()))
        return counted.select(F.explode(pairs).alias("row")).select("row.*")

    parts = [
        totals("customers", total_customers=_rows()),
        totals("orders", total_orders=_rows(), delivered_orders=F.count_if(F.col("order_status") == DELIVERED)),
        totals("order_items", total_order_items=_rows()),
        totals("order_reviews", total_reviews=_rows()),
        totals("products", total_products=_rows()),
    ]
    return reduce(DataFrame.unionByName, parts).orderBy("metric")
