"""Cleaning steps. Each returns a new table and changes nothing when applied twice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from buyerlens.sources.schemas import TRANSLATIONS

BOM = "\ufeff"

# They appear in the cleaned tables and have to be exactly these.
DELIVERED = "delivered"
NO_CATEGORY = "sem_categoria"
DAYS_AFTER_CARRIER = 7
DAYS_AFTER_PURCHASE = 14
EXTRA_TRANSLATIONS = [
    ("portateis_cozinha_e_preparadores_de_alimentos", "portable_kitchen_food_processors"),
    ("pc_gamer", "pc_gamer"),
    ("sem_categoria", "no_category"),
]


def strip_bom(df: DataFrame, column: str) -> DataFrame:
    """Remove byte-order marks from a text column."""
    return df.withColumn(column, F.replace(F.col(column), F.lit(BOM), F.lit("")))


def impute_delivery_date(
    orders: DataFrame,
    after_carrier: int = DAYS_AFTER_CARRIER,
    after_purchase: int = DAYS_AFTER_PURCHASE,
) -> DataFrame:
    """Estimate the delivery date of delivered orders that lack one."""
    estimate = F.coalesce(
        F.col("order_delivered_carrier_date") + F.make_dt_interval(F.lit(after_carrier)),
        F.col("order_purchase_timestamp") + F.make_dt_interval(F.lit(after_purchase)),
    )
    delivered_on = F.col("order_delivered_customer_date")
    return orders.withColumn(
        "order_delivered_customer_date",
        F.when(F.col("order_status") == DELIVERED, F.coalesce(delivered_on, estimate)).otherwise(delivered_on),
    )


def fill_category(products: DataFrame, label: str = NO_CATEGORY) -> DataFrame:
    """Give products without a category a visible one, so that distinct counts see it."""
    return products.fillna({"product_category_name": label})


def extra_translations(spark: SparkSession) -> DataFrame:
    """The translations missing from the delivered file."""
    return spark.createDataFrame(EXTRA_TRANSLATIONS, TRANSLATIONS.schema)


def add_missing_translations(translations: DataFrame, additions: DataFrame) -> DataFrame:
    """Append the additions whose category is not there yet; existing rows win."""
    key = "product_category_name"
    new_names = additions.groupBy(key).agg(
        F.min("product_category_name_english").alias("product_category_name_english")
    )
    return translations.unionByName(new_names.join(translations, key, "left_anti"))
