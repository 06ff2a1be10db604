"""The whole batch: import, check, clean, compute, publish."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame, SparkSession

from buyerlens.operators.cleaning import (
    add_missing_translations,
    extra_translations,
    fill_category,
    impute_delivery_date,
)
from buyerlens.operators.integrity import require_integrity
from buyerlens.plans.features import AS_OF, customer_features
from buyerlens.session import delete_path
from buyerlens.sources.csv import import_tables
from buyerlens.sources.versions import VersionedTable

VIEW = "v_customer_features"
FEATURE_TABLES = ("customers", "orders", "order_items", "order_reviews", "products")


def clean_tables(spark: SparkSession, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Every cleaning step over the loaded tables it applies to."""
    steps = {
        "orders": impute_delivery_date,
        "products": fill_category,
        "product_category_translation": lambda df: add_missing_translations(df, extra_translations(spark)),
    }
    return {name: steps[name](df) if name in steps else df for name, df in tables.items()}


def features_of(tables: Mapping[str, DataFrame], as_of: dt.date = AS_OF) -> DataFrame:
    """``customer_features`` over a set of tables."""
    return customer_features(*(tables[name] for name in FEATURE_TABLES), as_of=as_of)


def publish_view(tables: Mapping[str, DataFrame], as_of: dt.date = AS_OF, name: str = VIEW) -> DataFrame:
    """Offer the features to SQL as a view; it is computed when read."""
    features = features_of(tables, as_of)
    features.createOrReplaceTempView(name)
    return features


def feature_store(spark: SparkSession, root: str) -> VersionedTable:
    """The materialized features under ``root``."""
    return VersionedTable(spark, root, "customer_unique_id")


def build(
    spark: SparkSession,
    csv_paths: Mapping[str, str | list[str]],
    store: VersionedTable,
    as_of: dt.date = AS_OF,
    strict: bool = True,
    multiline: Collection[str] = (),
) -> DataFrame:
    """CSV files in, the current version of the features out. Also the way to refresh.

    The files are imported below the store first, and that import is removed at the end. ``strict``
    checks every declared rule on the imported tables. The tables in ``multiline`` may have line breaks
    inside quotes.
    """
    folder = f"{store.root}/import-{uuid.uuid4().hex}"
    try:
        tables = import_tables(spark, csv_paths, folder, multiline)
        if strict:
            require_integrity(tables)
        store.publish(features_of(clean_tables(spark, tables), as_of))
    finally:
        delete_path(spark, folder)
    return store.read()
