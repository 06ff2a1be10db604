from __future__ import annotations

from buyerlens.operators import cleaning
from buyerlens.operators.keep_latest import keep_latest
from buyerlens.sources.schemas import TRANSLATIONS
from tests.conftest import at


def delivery_dates(df):
    return {r.order_id: r.order_delivered_customer_date for r in df.collect()}


def test_delivery_date_is_estimated_only_where_missing(shop):
    shop.customer("a", "P")
    shop.order("kept", "a", "2018-01-01T08:00:00", delivered=at("2018-01-03T00:00:00"))
    shop.order("carrier", "a", "2018-01-01T08:00:00", carrier=at("2018-01-02T09:30:00"))
    shop.order("purchase", "a", "2018-01-01T08:00:00")
    shop.order("shipped", "a", "2018-01-01T08:00:00", status="shipped", carrier=at("2018-01-02T00:00:00"))
    once = cleaning.impute_delivery_date(shop.tables()["orders"])
    assert delivery_dates(once) == {
        "kept": at("2018-01-03T00:00:00"),
        "carrier": at("2018-01-09T09:30:00"),
        "purchase": at("2018-01-15T08:00:00"),
        "shipped": None,
    }
    assert delivery_dates(cleaning.impute_delivery_date(once)) == delivery_dates(once)


def test_missing_category_becomes_visible(shop):
    shop.product("x", None).product("y", "toys")
    once = cleaning.fill_category(shop.tables()["products"])
    found = sorted(r.product_category_name for r in once.collect())
    assert found == ["sem_categoria", "toys"]
    assert sorted(r.product_category_name for r in cleaning.fill_category(once).collect()) == found


def test_existing_translations_win_and_repeats_collapse(spark):
    existing = spark.createDataFrame([("pc_gamer", "gaming"), ("toys", "toys")], TRANSLATIONS.schema)
    extra = cleaning.extra_translations(spark)
    once = cleaning.add_missing_translations(existing, extra.unionByName(extra))
    rows = {r[0]: r[1] for r in once.collect()}
    assert once.count() == len(rows) == 4
    assert rows["pc_gamer"] == "gaming" and rows["sem_categoria"] == "no_category"
    again = cleaning.add_missing_translations(once, extra)
    assert {r[0]: r[1] for r in again.collect()} == rows


def test_byte_order_mark_is_removed_once_and_for_all(spark):
    df = spark.createDataFrame([("﻿a﻿b",), ("c",), (None,)], "t string")
    once = cleaning.strip_bom(df, "t")
    assert [r.t for r in once.collect()] == ["ab", "c", None]
    assert [r.t for r in cleaning.strip_bom(once, "t").collect()] == ["ab", "c", None]


def test_keep_latest_takes_null_as_newest_and_breaks_ties(spark):
    df = spark.createDataFrame(
        [("k", 1, "a"), ("k", 3, "c"), ("k", 3, "b"), ("n", 9, "x"), ("n", None, "y")], "key string, ts int, tag string"
    )
    rows = {r.key: r.tag for r in keep_latest(df, ["key"], ["ts"], ["tag"]).collect()}
    assert rows == {"k": "b", "n": "y"}
