from __future__ import annotations

from buyerlens.operators.cleaning import add_missing_translations, extra_translations, fill_category, impute_delivery_date
from buyerlens.plans import quality
from tests.conftest import at, money


def pairs(df):
    return [tuple(r) for r in df.collect()]


def test_row_counts_are_ordered_by_name(shop):
    shop.customer("a", "P").order("o", "a", "2018-01-01T00:00:00")
    counts = pairs(quality.row_counts(shop.tables()))
    assert [name for name, _ in counts] == sorted(name for name, _ in counts) and len(counts) == 8
    assert dict(counts)["orders"] == 1 and dict(counts)["products"] == 0


def test_duplicates_against_count_distinct(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,)], "review_id string")
    expected = df.selectExpr("count(*) - count(DISTINCT review_id)").first()[0]
    assert pairs(quality.duplicate_count(df, "review_id")) == [("reviews_doublons_restants", expected)]
    empty = spark.createDataFrame([], "review_id string")
    assert pairs(quality.duplicate_count(empty, "review_id")) == [("reviews_doublons_restants", 0)]


def test_cleaning_leaves_nothing_to_report(spark, shop):
    shop.customer("a", "P").product("x", None).product("y", "pc_gamer").product("z", "unheard_of")
    shop.order("o", "a", "2018-01-01T00:00:00").order("p", "a", "2018-01-01T00:00:00", status="shipped")
    t = shop.tables()
    orders, products, words = t["orders"], t["products"], t["product_category_translation"]
    assert pairs(quality.delivered_without_date(orders)) == [("delivered_sans_date", 1)]
    assert pairs(quality.delivered_without_date(impute_delivery_date(orders))) == [("delivered_sans_date", 0)]
    assert pairs(quality.products_without_category(products)) == [("produits_sans_categorie", 1)]
    filled = fill_category(products)
    assert pairs(quality.products_without_category(filled)) == [("produits_sans_categorie", 0)]
    assert pairs(quality.untranslated_categories(products, words)) == [("categories_sans_traduction", 2)]
    words = add_missing_translations(words, extra_translations(spark))
    assert pairs(quality.untranslated_categories(filled, words)) == [("categories_sans_traduction", 1)]


def test_zero_payments_are_listed_by_type_and_status(shop):
    shop.order("o", "a", "2018-01-01T00:00:00").order("p", "a", "2018-01-01T00:00:00", status="canceled")
    shop.rows["order_payments"] += [
        ("o", 1, "voucher", 1, money("0.00")), ("o", 2, "voucher", 1, money("0.00")),
        ("o", 3, "credit_card", 1, money("9.00")), ("p", 1, "not_defined", 1, money("0.00")),
    ]
    t = shop.tables()
    assert sorted(pairs(quality.zero_payments(t["order_payments"], t["orders"]))) == [
        ("not_defined", "canceled", 1), ("voucher", "delivered", 2)
    ]


def test_summary_is_text_in_order(shop):
    shop.customer("a", "P").product("x", "toys")
    shop.order("o", "a", "2018-01-01T00:00:00", items=[("x", "1", "0")], scores=[1, 2])
    shop.order("p", "a", "2018-01-01T00:00:00", status="shipped", delivered=at("2018-01-02T00:00:00"))
    assert pairs(quality.cleaning_summary(shop.tables())) == [
        ("delivered_orders", "1"), ("total_customers", "1"), ("total_order_items", "1"),
        ("total_orders", "2"), ("total_products", "1"), ("total_reviews", "2"),
    ]
