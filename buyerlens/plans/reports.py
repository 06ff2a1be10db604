"""Reports over a feature table: key figures, distributions, customers at risk, states.

Thresholds are keyword arguments; their defaults are fixed values.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buyerlens.functions.buckets import (
    FREQUENCY_CAP,
    RECENCY_BEYOND,
    RECENCY_EDGES,
    bin_start,
    frequency_bucket,
    recency_bucket,
)
from buyerlens.functions.numbers import cents, percentage, ratio

_CUSTOMER = "customer_unique_id"

# A customer at risk is silent for more days, and spent more, than
# these; the basket histogram shows means below the cap.
RISK_DAYS = 180
RISK_SPEND = 200
BASKET_CAP = 1000
BASKET_BIN = 25
NEGATIVE_BIN = 5


def _rows() -> Column:
    return F.count(F.lit(1))


def kpis(features: DataFrame) -> DataFrame:
    """Clients, repeat clients and their share, revenue, mean score."""
    mean_score = ratio(cents("SUM(avg_review_score)"), "COUNT(avg_review_score)", 2, scale=2)
    return features.selectExpr(
        "COUNT(*) AS nb_clients",
        "COUNT_IF(frequency > 1) AS nb_recurrents",
        f"{percentage('COUNT_IF(frequency > 1)', 'COUNT(*)', 1)} AS pct_recurrents",
        "ROUND(SUM(total_spent), 0) AS revenue_total",
        f"{mean_score} AS score_moyen",
    )


def _distribution(df: DataFrame, label: Column, name: str, order: Column) -> DataFrame:
    """Clients per label, in the order of the smallest value behind each label."""
    return (
        df.groupBy(label.alias(name))
        .agg(_rows().alias("nb_clients"), F.min(order).alias("__first"))
        .orderBy("__first")
        .select(name, "nb_clients")
    )


def recency_buckets(
    features: DataFrame, edges: Sequence[tuple[int, str]] = tuple(RECENCY_EDGES), beyond: str = RECENCY_BEYOND
) -> DataFrame:
    days = F.col("recency_days")
    return _distribution(features, recency_bucket(days, edges, beyond), "bucket", days)


def frequency_buckets(features: DataFrame, cap: int = FREQUENCY_CAP) -> DataFrame:
    orders = F.col("frequency")
    return _distribution(features, frequency_bucket(orders, cap), "freq", orders)


def score_distribution(features: DataFrame) -> DataFrame:
    """Clients per mean score rounded to a whole number."""
    score = F.col("avg_review_score")
    return _distribution(features.where(score.isNotNull()), F.round(score, 0).cast("int"), "note", score)


def basket_histogram(
    features: DataFrame, cap: int | Decimal = BASKET_CAP, width: int | Decimal = BASKET_BIN, overflow: bool = True
) -> DataFrame:
    """Clients per bin of the mean basket; baskets from the cap on share a last bin, or are left out without ``overflow``."""
    basket = F.col("avg_basket")
    if not overflow:
        return _distribution(features.where(basket < cap), bin_start(basket, width), "bin_start", basket)
    start = bin_start(basket, width)
    start = F.when(basket < cap, start).otherwise(F.lit(cap))
    return _distribution(features, start, "bin_start", basket)


def negative_pct_histogram(features: DataFrame, width: int | Decimal = NEGATIVE_BIN) -> DataFrame:
    """Clients per bin of the share of negative reviews, for clients with reviews."""
    share = F.col("pct_negative_reviews")
    return _distribution(features.where(share.isNotNull()), bin_start(share, width), "bin_start", share)


def _at_risk(days: int, spend: int | Decimal) -> str:
    return f"recency_days > {days} AND total_spent > {spend}"


def risk_kpis(features: DataFrame, days: int = RISK_DAYS, spend: int | Decimal = RISK_SPEND) -> DataFrame:
    """Size, revenue and mean recency of the group at risk, beside the total revenue, in one pass."""
    at_risk = f"FILTER (WHERE {_at_risk(days, spend)})"
    totals = features.selectExpr(
        "COUNT(*) AS clients",
        f"COUNT(*) {at_risk} AS nb_a_risque",
        f"ROUND(SUM(total_spent) {at_risk}, 0) AS revenue_perdu",
        f"SUM(recency_days) {at_risk} AS silent_days",
        "ROUND(SUM(total_spent), 0) AS revenue_total_global",
    )
    return totals.selectExpr(
        "nb_a_risque",
        "revenue_perdu",
        f"{ratio('silent_days', 'nb_a_risque', 0)} AS recence_moyenne",
        "revenue_total_global",
        f"{percentage('nb_a_risque', 'clients', 1)} AS pct_clients",
        f"{percentage('CAST(revenue_perdu AS BIGINT)', 'CAST(revenue_total_global AS BIGINT)', 0)} AS pct_revenue",
    )


def top_at_risk(
    features: DataFrame, days: int = RISK_DAYS, spend: int | Decimal = RISK_SPEND, n: int = 20
) -> DataFrame:
    """The ``n`` customers at risk who spent most."""
    return (
        features.where(_at_risk(days, spend))
        .select(_CUSTOMER, "recency_days", "frequency", "total_spent", "avg_review_score", "pct_negative_reviews")
        .orderBy(F.desc("total_spent"), F.asc(_CUSTOMER))
        .limit(n)
    )


# Headings under which the list of customers at risk is shown.
RISK_HEADINGS = {
    "customer_unique_id": "ID client",
    "recency_days": "Recence (j)",
    "frequency": "Commandes",
    "total_spent": "Depense totale (R$)",
    "avg_review_score": "Note moyenne",
    "pct_negative_reviews": "% reviews neg",
}


def with_headings(top: DataFrame) -> DataFrame:
    """The list of customers at risk under its display headings."""
    return top.withColumnsRenamed(RISK_HEADINGS)


def states(features: DataFrame, customers: DataFrame) -> DataFrame:
    """Clients and mean spend per state.

    A person's spend counts once per account, and a person with accounts in two
    states counts in both. Accounts are reduced to one row per person and state
    before the join, so a person with very many accounts joins only a few rows.
    """
    accounts = customers.groupBy(_CUSTOMER, "customer_state").agg(_rows().alias("accounts"))
    totals = (
        features.select(_CUSTOMER, "total_spent")
        .join(accounts, _CUSTOMER)
        .groupBy(F.col("customer_state").alias("state"))
        .agg(
            _rows().alias("nb_clients"),
            F.expr(f"SUM({cents('total_spent')} * accounts)").alias("cents"),
            F.sum("accounts").alias("accounts"),
        )
    )
    return totals.selectExpr(
        "state", "nb_clients", f"{ratio('cents', 'accounts', 2, scale=2)} AS panier_moyen"
    )


def geo_by_state(features: DataFrame, customers: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` states with most clients."""
    return states(features, customers).orderBy(F.desc("nb_clients"), F.asc("state")).limit(n)


def geo_by_spend(features: DataFrame, customers: DataFrame, n: int = 10) -> DataFrame:
    """The same states, highest mean spend first."""
    return geo_by_state(features, customers, n).orderBy(F.desc("panier_moyen"), F.asc("state"))
