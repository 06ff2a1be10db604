"""Plans: what is scanned, what is shuffled, and how hot keys are handled."""

from __future__ import annotations

import contextlib
import re

import pytest

from buyerlens.operators.keep_latest import keep_latest
from buyerlens.plans import features as plans
from buyerlens.plans import reports
from buyerlens.plans.build import features_of


@contextlib.contextmanager
def settings(spark, values):
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}
EAGER_SPLITS = {
    **NO_BROADCAST,
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """20,000 orders in parquet; one account, one product and one order each hold a third of their rows."""
    root = tmp_path_factory.mktemp("stored")
    orders, items = spark.range(20_000), spark.range(60_000)
    frames = {
        "customers": spark.range(3_000).selectExpr(
            "id AS customer_id", "id DIV 3 AS customer_unique_id", "CONCAT('S', id % 20) AS customer_state"),
        "products": spark.range(500).selectExpr(
            "id AS product_id", "CONCAT('kind', id % 30) AS product_category_name"),
        "orders": orders.selectExpr(
            "id AS order_id", "IF(id % 3 = 0, 0, xxhash64(id) & 2047) AS customer_id", "'delivered' AS order_status",
            "TIMESTAMP_NTZ'2018-01-01 00:00:00' + MAKE_DT_INTERVAL(CAST(id % 200 AS INT)) AS order_purchase_timestamp"),
        "order_items": items.selectExpr(
            "IF(id % 3 = 1, 7, id % 20000) AS order_id", "CAST(id AS INT) AS order_item_id",
            "IF(id % 3 = 0, 0, (xxhash64(id) & 1023) % 500) AS product_id",
            "CAST(id % 1000 AS DECIMAL(10, 2)) AS price", "CAST(1 AS DECIMAL(10, 2)) AS freight_value"),
        "order_reviews": orders.selectExpr(
            "id AS review_id", "IF(id % 3 = 0, 7, id) AS order_id", "CAST(id % 5 + 1 AS SMALLINT) AS review_score"),
    }
    tables = {}
    for name, df in frames.items():
        df.repartition(8).write.parquet(f"{root}/{name}")
        tables[name] = spark.read.parquet(f"{root}/{name}")
    return tables


def test_scans_read_only_what_is_needed(spark, stored):
    plan = plan_of(features_of(stored))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert all("customer_state" not in s and "review_id" not in s for s in schemas)
    assert "PushedFilters: [IsNotNull(order_status), EqualTo(order_status,delivered)" in plan


def test_features_shuffle_each_input_once_per_key(spark, stored):
    with settings(spark, NO_BROADCAST):
        plan = plan_of(features_of(stored))
    # By account: orders and customers. By product: items and products. By order: orders with their
    # person, items with their categories, reviews. By person: the sums. No shuffle by category.
    exchanges = [line for line in plan.splitlines() if "Exchange " in line and "Broadcast" not in line]
    assert len(exchanges) == 2 + 2 + 3 + 1 and "product_category_name, " not in "".join(exchanges)
    assert len(re.findall(r"FileScan parquet", plan)) == 5  # each table once
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_categories_are_united_before_both_shuffles(spark, stored):
    with settings(spark, NO_BROADCAST):
        plan = plan_of(plans.features_diversity(*(stored[n] for n in ("customers", "orders", "order_items", "products"))))
    assert plan.count("partial_bit_or(categories_0") == 2 and "Expand" not in plan
    keys = re.findall(r"hashpartitioning\(([^)]*?), \d+\)", plan)
    assert not [k for k in keys if "category" in k]


def test_items_and_reviews_are_summed_before_the_shuffle(spark, stored):
    with settings(spark, NO_BROADCAST):
        plan = plan_of(features_of(stored))
    assert "partial_sum(item_cents" in plan and "partial_sum(review_score" in plan
    assert "partial_max(" in plan and "Window" not in plan


def test_keep_latest_cuts_every_key_before_the_shuffle(spark, stored):
    plan = plan_of(keep_latest(stored["order_items"], ["order_id"], ["price"], ["order_item_id"]))
    limit, shuffle = plan.index("Partial"), plan.index("Exchange")
    assert "WindowGroupLimit" in plan and shuffle < limit


def test_hot_keys_are_split_and_results_stay_whole(spark, stored):
    arguments = [stored[n] for n in ("customers", "orders", "order_items", "products")]
    expected = {tuple(r) for r in plans.diversity_by_distinct(*arguments).collect()}
    with settings(spark, EAGER_SPLITS):
        df = plans.features_diversity(*arguments)
        found = {tuple(r) for r in df.collect()}
        plan = plan_of(df)
    assert found == expected
    # The hot account and the hot product are split; the hot order is one row per task before it is shuffled.
    final = plan.split("Initial Plan")[0]
    assert final.count("Join(skew=true)") == 2
    by_order = re.findall(r"Exchange hashpartitioning\(order_id#\d+L, .*\n.*", final)
    assert any("HashAggregate(keys=[order_id" in x for x in by_order)


def test_hot_keys_in_the_whole_feature_table(spark, stored):
    expected = {tuple(r) for r in features_of(stored).collect()}
    with settings(spark, EAGER_SPLITS):
        df = features_of(stored)
        assert {tuple(r) for r in df.collect()} == expected
        assert "Join(skew=true)" in plan_of(df)
    assert len(expected) == len({row[0] for row in expected})


def test_accounts_are_reduced_before_they_meet_the_features(spark, stored):
    features = features_of(stored).select("customer_unique_id", "total_spent")
    with settings(spark, NO_BROADCAST):
        plan = plan_of(reports.states(features, stored["customers"]))
    assert "partial_count(1)" in plan and "count(distinct customer_unique_id" not in plan


def test_top_lists_sort_no_more_than_they_return(spark, stored):
    assert "TakeOrderedAndProject(limit=20" in plan_of(plans.top_customers(features_of(stored)))
