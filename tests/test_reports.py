from __future__ import annotations

from decimal import Decimal

import pytest

from buyerlens.plans import reports
from tests.conftest import money

SCHEMA = """customer_unique_id string, recency_days int, frequency bigint, total_spent decimal(22,2),
    avg_basket decimal(22,2), basket_trend decimal(22,2), avg_days_between_orders decimal(22,1),
    avg_review_score decimal(22,2), pct_negative_reviews decimal(22,1), category_diversity bigint"""


def features(spark, rows):
    """Rows of (id, recency, frequency, spent, basket, score, negative share)."""
    full = [
        (c, days, n, money(spent), money(basket), None, None,
         score and money(score), negative and money(negative), 1)
        for c, days, n, spent, basket, score, negative in rows
    ]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture
def sample(spark):
    return features(spark, [
        ("a", 30, 1, "200.00", "999.99", "2.50", "0.0"),
        ("b", 31, 2, "200.01", "1000.00", "4.49", "100.0"),
        ("c", 90, 4, "500.00", "24.99", None, None),
        ("d", 180, 5, "900.50", "25.00", "5.00", "7.5"),
        ("e", 181, 6, "200.00", "0.00", "1.00", "4.9"),
        ("f", 365, 1, "300.25", "60.00", "3.50", "5.0"),
        ("g", 366, 1, "250.25", "60.00", None, None),
    ])


def pairs(df):
    return [tuple(r) for r in df.collect()]


def test_recency_edges_are_inclusive_and_ordered(sample):
    assert pairs(reports.recency_buckets(sample)) == [
        ("0-30j", 1), ("31-90j", 2), ("91-180j", 1), ("181-365j", 2), ("> 365j", 1)
    ]


def test_edges_are_parameters(sample):
    assert pairs(reports.recency_buckets(sample, edges=[(100, "recent")], beyond="old")) == [("recent", 3), ("old", 4)]
    assert pairs(reports.frequency_buckets(sample, cap=2)) == [("1", 3), ("2+", 4)]


def test_frequency_is_capped(sample):
    assert pairs(reports.frequency_buckets(sample)) == [("1", 3), ("2", 1), ("4", 1), ("5+", 2)]


def test_scores_round_half_up(sample):
    assert pairs(reports.score_distribution(sample)) == [(1, 1), (3, 1), (4, 2), (5, 1)]


def test_basket_bins_stop_below_the_cap(sample):
    assert pairs(reports.basket_histogram(sample, overflow=False)) == [
        (Decimal(0), 2), (Decimal(25), 1), (Decimal(50), 2), (Decimal(975), 1)
    ]


def test_negative_share_bins(sample):
    assert pairs(reports.negative_pct_histogram(sample)) == [(Decimal(0), 2), (Decimal(5), 2), (Decimal(100), 1)]


def test_buckets_add_up(sample):
    total = sample.count()
    for report in (reports.recency_buckets, reports.frequency_buckets):
        assert sum(n for _, n in pairs(report(sample))) == total


def test_risk_limits_are_strict(sample):
    row = reports.risk_kpis(sample).first()
    assert (row.nb_a_risque, row.revenue_perdu, row.recence_moyenne) == (2, Decimal(551), Decimal(366))
    assert (row.revenue_total_global, row.pct_clients, row.pct_revenue) == (Decimal(2551), Decimal("28.6"), Decimal(22))
    assert [r.customer_unique_id for r in reports.top_at_risk(sample).collect()] == ["f", "g"]


def test_risk_without_customers(sample):
    row = reports.risk_kpis(sample, days=10_000).first()
    assert (row.nb_a_risque, row.revenue_perdu, row.recence_moyenne, row.pct_revenue) == (0, None, None, None)


def test_display_headings(sample):
    assert reports.with_headings(reports.top_at_risk(sample, n=1)).columns == list(reports.RISK_HEADINGS.values())


def test_key_figures(sample):
    row = reports.kpis(sample).first()
    assert (row.nb_clients, row.nb_recurrents, row.pct_recurrents) == (7, 4, Decimal("57.1"))
    assert (row.revenue_total, row.score_moyen) == (Decimal(2551), Decimal("3.30"))


def test_key_figures_of_nothing(spark):
    row = reports.kpis(features(spark, [])).first()
    assert tuple(row) == (0, 0, None, None, None)


def test_states_weigh_by_account_and_count_people_once_per_state(spark, shop):
    shop.customer("a1", "P", "SP").customer("a2", "P", "SP").customer("a3", "P", "RJ").customer("b1", "Q", "SP")
    shop.customer("c1", "nobody", "MG")
    table = features(spark, [("P", 1, 1, "10.00", "1", None, None), ("Q", 1, 1, "40.01", "1", None, None)])
    customers = shop.tables()["customers"]
    assert pairs(reports.geo_by_state(table, customers)) == [
        ("SP", 2, Decimal("20.00")), ("RJ", 1, Decimal("10.00"))
    ]
    assert pairs(reports.geo_by_spend(table, customers, n=1)) == [("SP", 2, Decimal("20.00"))]
