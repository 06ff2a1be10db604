"""A refreshed state equals a full recomputation, whatever a delivery brings."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from buyerlens.operators import categories
from buyerlens.plans import refresh
from buyerlens.plans.build import FEATURE_TABLES
from buyerlens.plans.features import AS_OF
from buyerlens.sources.schemas import TABLES

NAMES = list(FEATURE_TABLES)


@pytest.fixture
def tables(shop):
    dice = random.Random(3)
    for n in range(30):
        shop.product(f"p{n:02}", f"cat{n % 9}" if n % 7 else None)
    for n in range(120):
        shop.customer(f"a{n:03}", f"u{n % 40:02}")
        items = [(f"p{dice.randrange(30):02}", f"{dice.randrange(1, 900)}.{dice.randrange(10, 99)}", "0.50") for _ in range(dice.randrange(4))]
        shop.order(f"o{n:03}", f"a{n:03}", f"2018-0{n % 9 + 1}-{n % 28 + 1:02}T10:00:00", items=items,
                   scores=[dice.randrange(1, 6) for _ in range(n % 3)], status="delivered" if n % 11 else "shipped")
    found = shop.tables()
    return {name: found[name] for name in NAMES}


@pytest.fixture
def store(spark, tmp_path, tables):
    found = refresh.state_store(spark, str(tmp_path / "state"))
    refresh.publish_state(found, tables, segments=5)
    return found


def rows(df, condition, *changes):
    changed = {c.rsplit(" AS ", 1)[1]: c for c in changes}
    schema = df.schema
    found = df.where(condition).selectExpr(*(changed.get(c, c) for c in df.columns))
    return found.select(*(F.col(f.name).cast(f.dataType) for f in schema))


def new_order(t, order="n1", account="a003", product="p05"):
    return {
        "orders": rows(t["orders"], "order_id = 'o003'", f"'{order}' AS order_id", f"'{account}' AS customer_id"),
        "order_items": rows(t["order_items"].limit(1), "TRUE", f"'{order}' AS order_id", f"'{product}' AS product_id"),
        "order_reviews": rows(t["order_reviews"].limit(1), "TRUE", f"'{order}' AS order_id", "'new' AS review_id"),
    }


def joined(*deliveries):
    """Several deliveries as one."""
    found = {}
    for delivery in deliveries:
        for name, df in delivery.items():
            found[name] = found[name].unionByName(df) if name in found else df
    return found


def only_new(t):
    """A new order, one without items, and one of a new person."""
    person = {"customers": rows(t["customers"], "customer_id = 'a001'", "'b1' AS customer_id", "'new' AS customer_unique_id")}
    bare = {"orders": new_order(t, "n3", "a009")["orders"]}
    return joined(new_order(t), bare, {k: v for k, v in new_order(t, "n2", "b1").items() if k != "order_reviews"}, person)


def corrected(t):
    """Prices, states of orders, more items of an old order, a new order of a person with a corrected one."""
    items = rows(t["order_items"], "order_id LIKE 'o01%'", "price * 2 AS price").unionByName(
        rows(t["order_items"], "order_id IN ('o005', 'o043')", "order_item_id + 10 AS order_item_id"))
    states = rows(t["orders"], "order_id IN ('o007', 'o011')", "IF(order_status = 'shipped', 'delivered', 'shipped') AS order_status")
    return joined({"order_items": items, "orders": states}, new_order(t))


def moved(t):
    """An order of another account, an account of another person, a review of another order."""
    return {
        "orders": rows(t["orders"], "order_id = 'o020'", "'a021' AS customer_id"),
        "customers": rows(t["customers"], "customer_id IN ('a030', 'a031')", "'u39' AS customer_unique_id"),
        "order_reviews": rows(t["order_reviews"], "review_id = 'o002-r0'", "'o050' AS order_id", "1 AS review_score"),
    }


def other_products(t):
    """Other categories, and an item of a product that is new itself."""
    products = rows(t["products"], "product_id IN ('p03', 'p07')", "'other' AS product_category_name").unionByName(
        rows(t["products"], "product_id = 'p01'", "'p77' AS product_id"))
    return {**new_order(t, product="p77"), "products": products}


@pytest.mark.parametrize("delivered", [only_new, corrected, moved, other_products])
def test_refresh_equals_recomputation(store, tables, delivered):
    before = {s.folder for s in store.segments()}
    delivery = delivered(tables)
    refresh.refresh_state(store, tables, delivery)
    assert refresh.refreshed_equals_full(store, refresh.merged_tables(tables, delivery))
    if delivered is only_new:
        assert before & {s.folder for s in store.segments()}  # key ranges that nothing touched


def test_deliveries_one_after_the_other(store, tables):
    for delivered in (only_new, lambda t: {}, moved):
        delivery = delivered(tables)
        refresh.refresh_state(store, tables, delivery)
        tables = refresh.merged_tables(tables, delivery)
    assert refresh.refreshed_equals_full(store, tables)


def test_more_categories_than_there_is_room_for(store, tables):
    room = store.notes()["room"]
    many = tables["products"].crossJoin(store.spark.range(5)).selectExpr(
        "CONCAT(product_id, '-', id) AS product_id", "CONCAT('x', product_id, id) AS product_category_name",
        *tables["products"].columns[2:])
    delivery = {"products": many, **new_order(tables, product="p03-2")}
    refresh.refresh_state(store, tables, delivery)
    assert store.notes()["room"] > room
    assert refresh.refreshed_equals_full(store, refresh.merged_tables(tables, delivery))


def test_a_state_needs_bitmaps(spark, tmp_path, tables, monkeypatch):
    monkeypatch.setattr(categories, "MAX_CATEGORIES", 2)
    with pytest.raises(ValueError, match="too many categories"):
        refresh.publish_state(refresh.state_store(spark, str(tmp_path / "x")), tables)


def test_upsert_replaces_by_key(spark):
    rows_ = spark.createDataFrame([("o", 1, "a"), ("o", 2, "b")], "order_id string, order_item_id int, v string")
    new = spark.createDataFrame([("o", 2, "c"), ("q", 1, "d")], "order_id string, order_item_id int, v string")
    found = refresh.upserted(rows_, new, TABLES["order_items"].primary_key).collect()
    assert sorted(map(tuple, found)) == [("o", 1, "a"), ("o", 2, "c"), ("q", 1, "d")]


def test_reviews_before_a_delivery_are_computed_once(spark, store, tables):
    counted = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            counted.add(batch.num_rows)
            yield batch

    reviews = tables["order_reviews"]
    watched = dict(tables, order_reviews=reviews.mapInArrow(count, reviews.schema))
    delivery = joined(new_order(tables), {"order_reviews": rows(reviews, "order_id LIKE 'o02%'", "CAST(1 AS SMALLINT) AS review_score")})
    refresh.refresh_state(store, watched, delivery)
    assert counted.value == reviews.count()
    assert refresh.refreshed_equals_full(store, refresh.merged_tables(tables, delivery), AS_OF)
