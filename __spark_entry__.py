"""Registered queries and the SQL each is checked against.

Every query runs the library over stand-ins for the store's tables, built from
the whole of the given parquet files. Decimals leave as double and whole
numbers as bigint, so that both engines return the same column types.
"""

from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Callable
from functools import reduce
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from buyerlens.operators import cleaning, integrity
from buyerlens.operators.keep_latest import keep_latest
from buyerlens.operators.sequence import order_sequence
from buyerlens.plans import features as plans
from buyerlens.plans import quality, refresh, reports, rollups
from buyerlens.plans.build import FEATURE_TABLES, clean_tables, feature_store, features_of, publish_view
from buyerlens.session import scratch_path
from buyerlens.sources import csv
from buyerlens.sources.schemas import TABLES
from buyerlens.sources.standin import AS_OF, BASKET_BIN, BASKET_CAP, RISK_SPEND, before_and_delivery, damaged_tables, standin_table, standin_tables
from buyerlens.sources.versions import VersionedTable
from oracle_queries import ORACLES

try:
    import corpus_pipeline
    from buyerlens.llm import registry as corpus
except ModuleNotFoundError as missing:  # the corpus operators can be left out
    if missing.name not in ("corpus_pipeline", "buyerlens.llm"):
        raise
    corpus_pipeline = corpus = None

SMOKE_DIR = "/root/testdata/sf0.001"

Query = Callable[[SparkSession, str], DataFrame]

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType)


def portable(df: DataFrame) -> DataFrame:
    def convert(field: T.StructField):
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, _WHOLE):
            return F.col(field.name).cast("bigint").alias(field.name)
        return F.col(field.name)

    return df.select(*(convert(f) for f in df.schema))


def _cleaned(spark: SparkSession, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Tables as an import and the cleaning leave them: of each review the newest version."""
    found = clean_tables(spark, tables)
    if "order_reviews" in found:
        found["order_reviews"] = csv.latest_reviews(found["order_reviews"])
    return found


class _Tables(dict):
    """Stand-in tables, each built when a query asks for it."""

    def __init__(self, spark: SparkSession, folder: str, cleaned: bool = False):
        super().__init__()
        self._build = lambda name: standin_table(spark, folder, name)
        self._finish = (lambda t: _cleaned(spark, t)) if cleaned else (lambda t: t)

    def __missing__(self, name: str) -> DataFrame:
        self.update(self._finish({name: self._build(name)}))
        return self[name]


def _raw(spark: SparkSession, folder: str) -> _Tables:
    return _Tables(spark, folder)


def _clean(spark: SparkSession, folder: str) -> _Tables:
    return _Tables(spark, folder, cleaned=True)


def _features(spark: SparkSession, folder: str) -> DataFrame:
    return features_of(_clean(spark, folder), AS_OF)


def _amounts(spark: SparkSession, folder: str) -> DataFrame:
    t = _raw(spark, folder)
    return plans.order_amounts(t["customers"], t["orders"], t["order_items"])


def _published(spark: SparkSession, folder: str):
    store = feature_store(spark, scratch_path(spark, "features"))
    store.publish(_features(spark, folder))
    return store


def _refreshed(spark: SparkSession, folder: str) -> DataFrame:
    """Features as of a month earlier, refreshed to the current date."""
    store = feature_store(spark, scratch_path(spark, "features"))
    for as_of in (AS_OF - dt.timedelta(days=30), AS_OF):
        store.publish(features_of(_clean(spark, folder), as_of))
    return store.read()


def _folded(spark: SparkSession, folder: str) -> DataFrame:
    """Features after a delivery of new and corrected rows was folded into the state before it."""
    before, delivery = (_cleaned(spark, t) for t in before_and_delivery(spark, folder))
    store = refresh.state_store(spark, scratch_path(spark, "state"))
    refresh.publish_state(store, before)
    refresh.refresh_state(store, before, delivery)
    return refresh.read_features(store, AS_OF)


def _customer_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Look up the customer with the highest id among those with features."""
    store = _published(spark, folder)
    return store.lookup(store.read().agg(F.max(store.key)).first()[0])


def _items_latest(spark: SparkSession, folder: str) -> DataFrame:
    items = _raw(spark, folder)["order_items"]
    return keep_latest(
        items,
        keys=["order_id", "order_item_id"],
        newest_by=["shipping_limit_date"],
        tie_break=["product_id", "seller_id", "price", "freight_value"],
    )


def _review_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as review versions: the same review id repeats with other dates."""
    lineitem = spark.read.parquet(f"{folder}/lineitem.parquet")
    return lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("review_id"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        (F.col("l_linenumber") % 5 + 1).cast("smallint").alias("review_score"),
        F.concat(F.lit('He said "ok", '), F.col("l_returnflag"), F.lit("\nand left")).alias("review_comment_title"),
        F.expr("CASE l_suppkey % 3 WHEN 0 THEN l_linestatus WHEN 1 THEN '' END").alias("review_comment_message"),
        F.col("l_shipdate").alias("review_creation_date"),
        (F.col("l_shipdate") + F.expr("INTERVAL 1 DAY")).alias("review_answer_timestamp"),
    )


def _through_csv(spark: SparkSession, df: DataFrame, table: str) -> DataFrame:
    """Write a table the way it is delivered and import it."""
    folder = scratch_path(spark, "csv")
    path = f"{folder}/delivered"
    writer = df.write.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
    writer.csv(path, header=True, quote='"', escape='"', emptyValue='""', nullValue="")
    return csv.import_tables(spark, {table: path}, f"{folder}/imported")[table]


def _load(table: str) -> Query:
    return lambda spark, folder: _through_csv(spark, _raw(spark, folder)[table], table)


def _load_translations(spark: SparkSession, folder: str) -> DataFrame:
    marked = F.concat(F.lit(cleaning.BOM), F.col("product_category_name"))
    delivered = _raw(spark, folder)["product_category_translation"].withColumn("product_category_name", marked)
    return _through_csv(spark, delivered, "product_category_translation")


def _strip_bom(spark: SparkSession, folder: str) -> DataFrame:
    marked = spark.read.parquet(f"{folder}/part.parquet").select(
        F.col("p_partkey").alias("product_id"),
        F.concat(F.lit(cleaning.BOM), "p_name").alias("product_name"),
    )
    return cleaning.strip_bom(marked, "product_name")


def _with_gap(translations: DataFrame) -> DataFrame:
    """Two categories lose their translation, for the queries that look for such."""
    return translations.where("product_category_name NOT IN ('LARGE', 'PROMO')")


def _extended_translations(spark: SparkSession, folder: str) -> DataFrame:
    """Add the fixed translations and one per category in use; those that exist stay as they are."""
    t = _raw(spark, folder)
    in_use = t["products"].where("product_category_name IS NOT NULL").select(
        "product_category_name", F.initcap("product_category_name").alias("product_category_name_english")
    )
    additions = cleaning.extra_translations(spark).unionByName(in_use)
    return cleaning.add_missing_translations(_with_gap(t["product_category_translation"]), additions)


def _fan_out(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Features and customers when each person holds three accounts."""
    tables = _cleaned(spark, standin_tables(spark, folder, FEATURE_TABLES, accounts_per_person=3))
    return features_of(tables, AS_OF), tables["customers"]


def _view(spark: SparkSession, folder: str) -> DataFrame:
    publish_view(_clean(spark, folder), AS_OF)
    return spark.sql("SELECT * FROM v_customer_features")


def _damaged_queries() -> dict[str, Callable[[dict[str, DataFrame]], DataFrame]]:
    """Queries over deliveries that break rules of every kind."""
    return {
        "pk_violations": integrity.key_violations,
        "fk_orphans": integrity.orphan_counts,
        "key_report": integrity.key_report,
        "null_and_length_violations": integrity.null_and_length_violations,
        "check_violations": integrity.check_violations,
    }


_ROW_KEYS = {t.name: [k for k in t.primary_key] for t in TABLES.values()}


def _set_aside(spark: SparkSession, folder: str) -> DataFrame:
    """Key and broken rules of every row that the quarantine sets aside."""
    _, aside = integrity.quarantine(damaged_tables(spark, folder), scratch_path(spark, "quarantine"))
    parts = [
        df.select(
            F.lit(name).alias("table_name"),
            F.concat_ws("/", *(F.coalesce(F.col(k).cast("string"), F.lit("?")) for k in _ROW_KEYS[name])).alias("row_key"),
            F.concat_ws("; ", integrity.BROKEN).alias("broken_rules"),
        )
        for name, df in aside.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _kept_by_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of each table that the quarantine lets pass."""
    sound, _ = integrity.quarantine(damaged_tables(spark, folder), scratch_path(spark, "quarantine"))
    return quality.row_counts(sound)


def _raw_queries() -> dict[str, Callable[[dict[str, DataFrame]], DataFrame]]:
    """Queries over the tables as delivered."""
    return {
        "impute_delivery_date": lambda t: cleaning.impute_delivery_date(t["orders"]),
        "delivered_without_date": lambda t: quality.delivered_without_date(t["orders"]),
        "fill_category": lambda t: cleaning.fill_category(t["products"]),
        "products_without_category": lambda t: quality.products_without_category(t["products"]),
        "zero_value_report": lambda t: quality.zero_payments(t["order_payments"], t["orders"]),
        "order_amounts": lambda t: plans.order_amounts(t["customers"], t["orders"], t["order_items"]),
        "order_sequence": lambda t: order_sequence(
            plans.order_amounts(t["customers"], t["orders"], t["order_items"])
        ),
    }


def _clean_queries() -> dict[str, Callable[[dict[str, DataFrame]], DataFrame]]:
    """Queries over the cleaned tables."""
    return {
        "cleaning_summary": quality.cleaning_summary,
        "untranslated_categories": lambda t: quality.untranslated_categories(
            t["products"], _with_gap(t["product_category_translation"])
        ),
        "features_satisfaction": lambda t: plans.features_satisfaction(
            t["customers"], t["orders"], t["order_reviews"]
        ),
        "features_diversity": lambda t: plans.features_diversity(
            t["customers"], t["orders"], t["order_items"], t["products"]
        ),
    }


def _feature_queries() -> dict[str, Callable[[DataFrame], DataFrame]]:
    """Queries over the feature table."""
    return {
        "customer_features": lambda f: f,
        "features_preview": plans.preview,
        "top_customers": plans.top_customers,
        "features_summary": plans.features_summary,
        "kpis": reports.kpis,
        "recency_buckets": reports.recency_buckets,
        "basket_histogram": lambda f: reports.basket_histogram(f, BASKET_CAP, BASKET_BIN),
        "basket_histogram_capped": lambda f: reports.basket_histogram(f, BASKET_CAP, BASKET_BIN, overflow=False),
        "frequency_buckets": reports.frequency_buckets,
        "score_distribution": reports.score_distribution,
        "negative_pct_histogram": reports.negative_pct_histogram,
        "risk_kpis": lambda f: reports.risk_kpis(f, spend=RISK_SPEND),
        "top_at_risk": lambda f: reports.top_at_risk(f, spend=RISK_SPEND),
        "top_at_risk_headings": lambda f: reports.with_headings(reports.top_at_risk(f, spend=RISK_SPEND)),
    }


def _rollup(spark: SparkSession, folder: str) -> DataFrame:
    """The roll-up published beside the features."""
    cuts = rollups.Cuts(basket_cap=BASKET_CAP, basket_bin=BASKET_BIN, risk_spend=RISK_SPEND)
    root = scratch_path(spark, "rollup")
    store, sums = feature_store(spark, f"{root}/features"), VersionedTable(spark, f"{root}/sums", rollups.KEY)
    return rollups.publish_with_rollup(store, sums, _features(spark, folder), cuts)


def _rollup_queries() -> dict[str, Callable[[DataFrame], DataFrame]]:
    """Reports from the published roll-up; each equals the report of that name over the features."""
    found = {"kpis": rollups.kpis, "features_summary": rollups.features_summary, "risk_kpis": rollups.risk_kpis}
    for name in ("recency_buckets", "frequency_buckets", "score_distribution", "basket_histogram", "basket_histogram_capped",
                 "negative_pct_histogram"):
        found[name] = lambda sums, name=name: rollups.distributions(sums)[name]
    return {f"rollup_{name}": query for name, query in found.items()}


def queries() -> dict[str, Query]:
    """One entry per operator or report."""
    found: dict[str, Query] = {
        "duplicate_count": lambda s, d: quality.duplicate_count(_review_versions(s, d), "review_id"),
        "dedup_latest": _items_latest,
        "row_counts": lambda s, d: quality.row_counts(standin_tables(s, d)),
        "quarantined_rows": _set_aside,
        "quarantine_row_counts": _kept_by_quarantine,
        "strip_bom": _strip_bom,
        "insert_missing_translations": _extended_translations,
        "features_rfm": lambda s, d: plans.features_rfm(_amounts(s, d), AS_OF),
        "features_trend": lambda s, d: plans.features_trend(_amounts(s, d)),
        "features_gap": lambda s, d: plans.features_gap(_amounts(s, d)),
        "features_view": _view,
        "materialized_read": lambda s, d: _published(s, d).read(),
        "features_refresh": _refreshed,
        "features_refresh_differential": _folded,
        "customer_lookup": _customer_lookup,
        "geo_by_state": lambda s, d: reports.geo_by_state(*_fan_out(s, d)),
        "geo_by_spend": lambda s, d: reports.geo_by_spend(*_fan_out(s, d)),
        "geo_all_states": lambda s, d: reports.states(*_fan_out(s, d)),
        "load_category_translation": _load_translations,
        "load_order_reviews": lambda s, d: _through_csv(s, _review_versions(s, d), "order_reviews"),
    }
    for table in ("customers", "sellers", "products", "orders", "order_items", "order_payments"):
        found[f"load_{table}"] = _load(table)
    for name, query in _damaged_queries().items():
        found[name] = lambda s, d, query=query: query(damaged_tables(s, d))
    for name, query in _raw_queries().items():
        found[name] = lambda s, d, query=query: query(_raw(s, d))
    for name, query in _clean_queries().items():
        found[name] = lambda s, d, query=query: query(_clean(s, d))
    for name, query in _rollup_queries().items():
        found[name] = lambda s, d, query=query: query(_rollup(s, d))
    for name, query in _feature_queries().items():
        found[name] = lambda s, d, query=query: query(_features(s, d))
    registered = {
        name: (lambda s, d, query=query: portable(query(s, d)))
        for name, query in sorted(found.items())
    }
    if corpus:
        registered.update(corpus.QUERIES, pipeline=corpus_pipeline.run)
    return registered


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per query, for those that SQL can express."""
    oracles = dict(ORACLES)
    if corpus:
        oracles.update(corpus.ORACLES)
    return oracles


def entry(spark: SparkSession) -> DataFrame:
    """Customer features over the smallest test tables."""
    return queries()["customer_features"](spark, SMOKE_DIR)
