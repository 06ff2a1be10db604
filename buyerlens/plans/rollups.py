"""Reports from partial sums that are written when features are published.

A roll-up has one row per combination of recency bucket, number of orders, rounded score, bins
and risk, with sums that can be added: a few hundred to some thousand rows for any number
of customers. Every report over the whole feature table but the lists of customers and the
states follows from it, and equals the one computed from the features. Thresholds and bins are
fixed when the roll-up is made.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buyerlens.functions.buckets import FREQUENCY_CAP, RECENCY_BEYOND, RECENCY_EDGES, bin_start, frequency_bucket, recency_bucket
from buyerlens.functions.numbers import cents, from_units, percentage, ratio
from buyerlens.plans.reports import BASKET_BIN, BASKET_CAP, NEGATIVE_BIN, RISK_DAYS, RISK_SPEND
from buyerlens.sources.versions import VersionedTable

KEY = "rollup_key"


class Cuts(NamedTuple):
    """Edges, caps and widths of a roll-up; the defaults are those of the reports."""

    recency_edges: Sequence[tuple[int, str]] = tuple(RECENCY_EDGES)
    recency_beyond: str = RECENCY_BEYOND
    frequency_cap: int = FREQUENCY_CAP
    basket_cap: int | Decimal = BASKET_CAP
    basket_bin: int | Decimal = BASKET_BIN
    negative_bin: int | Decimal = NEGATIVE_BIN
    risk_days: int = RISK_DAYS
    risk_spend: int | Decimal = RISK_SPEND


def _groups(cuts: Cuts) -> dict[str, Column]:
    basket, share = F.col("avg_basket"), F.col("pct_negative_reviews")
    return {
        "recency": recency_bucket(F.col("recency_days"), cuts.recency_edges, cuts.recency_beyond),
        "orders": frequency_bucket(F.col("frequency"), cuts.frequency_cap),
        "repeat": F.col("frequency") > 1,
        "note": F.round("avg_review_score", 0).cast("int"),
        "basket": F.when(basket < cuts.basket_cap, bin_start(basket, cuts.basket_bin)).otherwise(F.lit(cuts.basket_cap)),
        "beyond_cap": basket >= cuts.basket_cap,
        "negative": bin_start(share, cuts.negative_bin),
        "at_risk": F.expr(f"recency_days > {cuts.risk_days} AND total_spent > {cuts.risk_spend}"),
    }


def rollup(features: DataFrame, cuts: Cuts = Cuts()) -> DataFrame:
    """The partial sums of a feature table."""
    groups = _groups(cuts)
    rows = features.groupBy(*(c.alias(name) for name, c in groups.items())).agg(
        F.count("*").alias("clients"),
        F.expr(f"SUM({cents('total_spent')}) AS spent_cents"),
        F.expr("SUM(recency_days) AS days"),
        F.expr(f"SUM({cents('avg_review_score')}) AS score_cents"),
        F.count("avg_review_score").alias("scored"),
        F.min("recency_days").alias("least_days"),
        F.min("frequency").alias("least_orders"),
    )
    key = F.concat_ws("|", *(F.coalesce(F.col(n).cast("string"), F.lit("-")) for n in groups))
    return rows.withColumn(KEY, key)


def merged_rollups(rollups: DataFrame) -> DataFrame:
    """One roll-up of those of several feature tables without common customers."""
    sums = ("clients", "spent_cents", "days", "score_cents", "scored")
    names = [n for n in _groups(Cuts())]
    return rollups.groupBy(*names, KEY).agg(
        *(F.sum(c).alias(c) for c in sums), *(F.min(c).alias(c) for c in ("least_days", "least_orders"))
    ).select(*rollups.columns)


def publish_with_rollup(features: VersionedTable, rollups: VersionedTable, df: DataFrame, cuts: Cuts = Cuts()) -> DataFrame:
    """Publish a feature table, and the roll-up of what was published; returns the roll-up.

    The roll-up's notes name the version it belongs to.
    """
    sequence = features.publish(df)
    rollups.publish(rollup(features.read(), cuts), notes={"features": sequence})
    return rollups.read()


def kpis(sums: DataFrame) -> DataFrame:
    """As ``reports.kpis``."""
    return sums.selectExpr(
        "SUM(clients) AS nb_clients",
        "COALESCE(SUM(clients) FILTER (WHERE repeat), 0) AS nb_recurrents",
        f"{percentage('COALESCE(SUM(clients) FILTER (WHERE repeat), 0)', 'SUM(clients)', 1)} AS pct_recurrents",
        f"ROUND({from_units('SUM(spent_cents)', 2)}, 0) AS revenue_total",
        f"{ratio('SUM(score_cents)', 'SUM(scored)', 2, scale=2)} AS score_moyen",
    )


def features_summary(sums: DataFrame) -> DataFrame:
    """As ``features.features_summary``."""
    return sums.selectExpr(
        "SUM(clients) AS nb_clients",
        "COALESCE(SUM(clients) FILTER (WHERE repeat), 0) AS clients_recurrents",
        f"{ratio('SUM(days)', 'SUM(clients)', 1)} AS recency_moyenne",
        f"{ratio('SUM(spent_cents)', 'SUM(clients)', 2, scale=2)} AS depense_moyenne",
    )


def risk_kpis(sums: DataFrame) -> DataFrame:
    """As ``reports.risk_kpis``."""
    at_risk = "FILTER (WHERE at_risk)"
    totals = sums.selectExpr(
        "SUM(clients) AS clients",
        f"COALESCE(SUM(clients) {at_risk}, 0) AS nb_a_risque",
        f"ROUND({from_units(f'SUM(spent_cents) {at_risk}', 2)}, 0) AS revenue_perdu",
        f"SUM(days) {at_risk} AS silent_days",
        f"ROUND({from_units('SUM(spent_cents)', 2)}, 0) AS revenue_total_global",
    )
    return totals.selectExpr(
        "nb_a_risque",
        "revenue_perdu",
        f"{ratio('silent_days', 'nb_a_risque', 0)} AS recence_moyenne",
        "revenue_total_global",
        f"{percentage('nb_a_risque', 'clients', 1)} AS pct_clients",
        f"{percentage('CAST(revenue_perdu AS BIGINT)', 'CAST(revenue_total_global AS BIGINT)', 0)} AS pct_revenue",
    )


def _distribution(sums: DataFrame, group: str, name: str, order: str) -> DataFrame:
    rows = sums.where(F.col(group).isNotNull()).groupBy(F.col(group).alias(name))
    return rows.agg(F.sum("clients").alias("nb_clients"), F.min(order).alias("__first")).orderBy("__first").select(name, "nb_clients")


def distributions(sums: DataFrame) -> Mapping[str, DataFrame]:
    """As the reports of these names."""
    return {
        "recency_buckets": _distribution(sums, "recency", "bucket", "least_days"),
        "frequency_buckets": _distribution(sums, "orders", "freq", "least_orders"),
        "score_distribution": _distribution(sums, "note", "note", "note"),
        "basket_histogram": _distribution(sums, "basket", "bin_start", "basket"),
        "basket_histogram_capped": _distribution(sums.where("NOT beyond_cap"), "basket", "bin_start", "basket"),
        "negative_pct_histogram": _distribution(sums, "negative", "bin_start", "negative"),
    }
