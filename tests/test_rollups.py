from __future__ import annotations

from decimal import Decimal

import pytest

from buyerlens.plans import features as plans
from buyerlens.plans import reports, rollups
from buyerlens.plans.build import feature_store
from buyerlens.sources.versions import VersionedTable

SCHEMA = ("customer_unique_id string, recency_days int, frequency long, total_spent decimal(22,2), avg_basket decimal(22,2), "
          "avg_review_score decimal(22,2), pct_negative_reviews decimal(22,1)")


@pytest.fixture
def features(spark):
    def row(k):
        spent = Decimal(k * 37 % 4000) / 2 + Decimal("0.55")
        score = None if k % 5 == 0 else Decimal(100 + k * 13 % 401).scaleb(-2)
        share = None if k % 5 == 0 else Decimal(k * 7 % 1001).scaleb(-1)
        return (f"u{k:03}", k * 11 % 700, k % 7 + 1, spent, spent / (k % 7 + 1), score, share)

    return spark.createDataFrame([row(k) for k in range(300)], SCHEMA)


def direct(features):
    return {
        "kpis": reports.kpis(features), "features_summary": plans.features_summary(features), "risk_kpis": reports.risk_kpis(features),
        "recency_buckets": reports.recency_buckets(features), "frequency_buckets": reports.frequency_buckets(features),
        "score_distribution": reports.score_distribution(features), "basket_histogram": reports.basket_histogram(features),
        "basket_histogram_capped": reports.basket_histogram(features, overflow=False),
        "negative_pct_histogram": reports.negative_pct_histogram(features),
    }


def from_sums(sums):
    return {"kpis": rollups.kpis(sums), "features_summary": rollups.features_summary(sums), "risk_kpis": rollups.risk_kpis(sums),
            **rollups.distributions(sums)}


def rows(found):
    """Rows in their order, and columns."""
    return {name: (df.columns, [tuple(r) for r in df.collect()]) for name, df in found.items()}


def test_reports_from_sums_equal_those_from_features(features):
    assert rows(from_sums(rollups.rollup(features))) == rows(direct(features))


def test_sums_of_parts_merge(features):
    parts = rollups.rollup(features.where("frequency < 3")).unionByName(rollups.rollup(features.where("frequency >= 3")))
    assert rows(from_sums(rollups.merged_rollups(parts))) == rows(direct(features))


def test_nobody(features):
    none = features.limit(0)
    found, expected = rows(from_sums(rollups.rollup(none))), rows(direct(none))
    assert {n: v for n, v in found.items() if "kpis" not in n and n != "features_summary"} == {
        n: v for n, v in expected.items() if "kpis" not in n and n != "features_summary"}
    assert found["risk_kpis"][1][0][0] == 0


def test_published_beside_the_features(spark, features, tmp_path):
    store = feature_store(spark, str(tmp_path / "features"))
    sums = VersionedTable(spark, str(tmp_path / "sums"), rollups.KEY)
    rollups.publish_with_rollup(store, sums, features)
    found = rollups.publish_with_rollup(store, sums, features.where("frequency = 2"))
    assert sums.notes() == {"features": 2}
    assert rows(from_sums(found)) == rows(direct(store.read()))
