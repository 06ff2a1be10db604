from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal
from fractions import Fraction

import pytest

from buyerlens.operators.cleaning import fill_category
from buyerlens.plans import features as plans
from buyerlens.plans.build import features_of
from tests.conftest import at
from tests.test_numbers import half_away

AS_OF = dt.date(2018, 10, 17)


def by_customer(df):
    return {row.customer_unique_id: row.asDict() for row in df.collect()}


def test_default_date_is_the_last_order_of_the_data():
    assert plans.AS_OF == AS_OF


def test_single_order_has_no_trend_and_no_gap(shop):
    shop.customer("a", "P").product("x", "toys").order("o", "a", "2018-10-07T23:59:00", items=[("x", "10.00", "2.50")])
    row = by_customer(features_of(shop.tables()))["P"]
    assert row == {
        "customer_unique_id": "P", "recency_days": 10, "frequency": 1, "total_spent": Decimal("12.50"),
        "avg_basket": Decimal("12.50"), "basket_trend": None, "avg_days_between_orders": None,
        "avg_review_score": None, "pct_negative_reviews": None, "category_diversity": 1,
    }


def test_gap_counts_calendar_days(shop):
    shop.customer("a", "P").product("x", "toys")
    shop.order("o1", "a", "2018-01-01T23:59:00", items=[("x", "1", "0")])
    shop.order("o2", "a", "2018-01-02T00:01:00", items=[("x", "2", "0")])
    row = by_customer(features_of(shop.tables()))["P"]
    assert row["avg_days_between_orders"] == Decimal("1.0")
    assert row["basket_trend"] == Decimal("1.00")


def test_orders_at_one_moment_are_taken_by_order_id(shop):
    shop.customer("a", "P").product("x", "toys")
    shop.order("o2", "a", "2018-01-01T10:00:00", items=[("x", "7", "0")])
    shop.order("o1", "a", "2018-01-01T10:00:00", items=[("x", "4", "0")])
    assert by_customer(features_of(shop.tables()))["P"]["basket_trend"] == Decimal("3.00")


def test_trend_rounds_half_cents_away_from_zero(shop):
    shop.product("x", "toys")
    for person, prices in {"up": ["1.00", "1.00", "1.01"], "down": ["1.01", "1.01", "1.00"]}.items():
        shop.customer(person, person)
        for n, price in enumerate(prices):
            shop.order(f"{person}{n}", person, f"2018-01-0{n + 1}T00:00:00", items=[("x", price, "0")])
    rows = by_customer(features_of(shop.tables()))
    assert rows["up"]["basket_trend"] == Decimal("0.01")
    assert rows["down"]["basket_trend"] == Decimal("-0.01")


def test_delivered_order_without_items_makes_no_customer_but_its_review_counts(shop):
    shop.customer("a", "P").customer("b", "Q").product("x", "toys")
    shop.order("o1", "a", "2018-09-01T00:00:00", scores=[1])
    shop.order("o2", "a", "2018-01-01T00:00:00", items=[("x", "5", "0")], scores=[4])
    shop.order("o3", "b", "2018-01-01T00:00:00", scores=[5])
    tables = shop.tables()
    rows = by_customer(features_of(tables))
    assert set(rows) == {"P"}
    assert rows["P"]["frequency"] == 1
    assert rows["P"]["recency_days"] == 289
    assert rows["P"]["avg_review_score"] == Decimal("2.50")
    satisfaction = plans.features_satisfaction(tables["customers"], tables["orders"], tables["order_reviews"])
    assert set(by_customer(satisfaction)) == {"P", "Q"}


def test_every_review_of_an_order_counts(shop):
    shop.customer("a", "P").product("x", "toys")
    shop.order("o", "a", "2018-01-01T00:00:00", items=[("x", "5", "0"), ("x", "5", "0")], scores=[1, 2, 5])
    row = by_customer(features_of(shop.tables()))["P"]
    assert row["avg_review_score"] == Decimal("2.67")
    assert row["pct_negative_reviews"] == Decimal("66.7")
    assert row["total_spent"] == Decimal("10.00")


def test_limit_of_a_negative_score_is_a_parameter(shop):
    shop.customer("a", "P").product("x", "toys")
    shop.order("o", "a", "2018-01-01T00:00:00", items=[("x", "5", "0")], scores=[1, 3, 5])
    t = shop.tables()
    frames = [t[n] for n in ("customers", "orders", "order_items", "order_reviews", "products")]
    row = plans.customer_features(*frames, negative_score=3).first()
    assert row.pct_negative_reviews == Decimal("66.7")


def test_other_states_of_an_order_are_left_out(shop):
    shop.customer("a", "P").product("x", "toys")
    shop.order("o1", "a", "2018-01-01T00:00:00", items=[("x", "5", "0")])
    shop.order("o2", "a", "2018-02-01T00:00:00", status="canceled", items=[("x", "9", "0")], scores=[1])
    row = by_customer(features_of(shop.tables()))["P"]
    assert (row["frequency"], row["total_spent"], row["avg_review_score"]) == (1, Decimal("5.00"), None)


def test_diversity_ignores_missing_categories_until_they_are_filled(shop):
    shop.customer("a", "P").product("x", "toys").product("y", None)
    shop.order("o", "a", "2018-01-01T00:00:00", items=[("x", "5", "0"), ("y", "5", "0")])
    tables = shop.tables()
    assert by_customer(features_of(tables))["P"]["category_diversity"] == 1
    tables["products"] = fill_category(tables["products"])
    assert by_customer(features_of(tables))["P"]["category_diversity"] == 2


def test_unknown_product_keeps_the_money(shop):
    shop.customer("a", "P").product("x", "toys")
    shop.order("o", "a", "2018-01-01T00:00:00", items=[("nowhere", "5", "0")])
    row = by_customer(features_of(shop.tables()))["P"]
    assert (row["total_spent"], row["category_diversity"]) == (Decimal("5.00"), None)


def random_shop(shop, seed):
    """Accounts, ties in time, missing parts, and one person with a third of the orders."""
    dice = random.Random(seed)
    people = [f"P{n}" for n in range(8)]
    accounts = []
    for n in range(30):
        person = "P0" if n % 3 == 0 else dice.choice(people)
        accounts.append(f"a{n}")
        shop.customer(f"a{n}", person, dice.choice(["SP", "RJ", "MG"]))
    for n, category in enumerate(["toys", "books", None, "garden"]):
        shop.product(f"x{n}", category)
    for n in range(120):
        day = dt.datetime(2018, 1, 1) + dt.timedelta(days=dice.randrange(60), hours=dice.randrange(3) * 10)
        items = [
            (f"x{dice.randrange(4)}", f"{dice.randrange(100, 9999) / 100:.2f}", f"{dice.randrange(500) / 100:.2f}")
            for _ in range(dice.randrange(4))
        ]
        scores = [dice.randint(1, 5) for _ in range(dice.randrange(3))]
        status = "delivered" if dice.random() < 0.9 else "shipped"
        shop.order(f"o{n:03}", dice.choice(accounts), day.isoformat(), status, items, scores)
    return shop


def brute_force(shop):
    """The features again, order by order in plain Python."""
    person = {r[0]: r[1] for r in shop.rows["customers"]}
    category = {r[0]: r[1] for r in shop.rows["products"]}
    items, scores = defaultdict(list), defaultdict(list)
    for order, _, product, _, _, price, freight in shop.rows["order_items"]:
        items[order].append((product, price + freight))
    for _, order, score, *_ in shop.rows["order_reviews"]:
        scores[order].append(score)
    history, reviews, kinds = defaultdict(list), defaultdict(list), defaultdict(set)
    for order, account, status, bought, *_ in shop.rows["orders"]:
        if status != "delivered":
            continue
        who = person[account]
        reviews[who] += scores[order]
        if items[order]:
            history[who].append((bought, order, sum(amount for _, amount in items[order])))
            kinds[who] |= {category[p] for p, _ in items[order] if category[p] is not None}
    result = {}
    for who, orders in history.items():
        orders.sort()
        steps = list(zip(orders, orders[1:]))
        mean = lambda values, digits: (
            half_away(Fraction(sum(Fraction(v) for v in values), len(values)), digits) if values else None
        )
        amounts = [amount for *_, amount in orders]
        seen = reviews[who]
        result[who] = {
            "customer_unique_id": who,
            "recency_days": (AS_OF - orders[-1][0].date()).days,
            "frequency": len(orders),
            "total_spent": sum(amounts),
            "avg_basket": mean(amounts, 2),
            "basket_trend": mean([b[2] - a[2] for a, b in steps], 2),
            "avg_days_between_orders": mean([(b[0].date() - a[0].date()).days for a, b in steps], 1),
            "avg_review_score": mean(seen, 2),
            "pct_negative_reviews": mean([100 * (s <= 2) for s in seen], 1),
            "category_diversity": len(kinds[who]),
        }
    return result


@pytest.mark.parametrize("seed", [1, 2])
def test_features_match_brute_force(shop, seed):
    random_shop(shop, seed)
    assert by_customer(features_of(shop.tables())) == brute_force(shop)


def test_one_plan_equals_the_join_of_the_parts(shop):
    random_shop(shop, 3)
    t = shop.tables()
    amounts = plans.order_amounts(t["customers"], t["orders"], t["order_items"])
    parts = plans.features_rfm(amounts)
    for part in (
        plans.features_trend(amounts),
        plans.features_gap(amounts),
        plans.features_satisfaction(t["customers"], t["orders"], t["order_reviews"]),
        plans.features_diversity(t["customers"], t["orders"], t["order_items"], t["products"]),
    ):
        parts = parts.join(part, "customer_unique_id", "left")
    assert by_customer(features_of(t)) == by_customer(parts)


def test_invariants(shop):
    random_shop(shop, 4)
    rows = by_customer(features_of(shop.tables())).values()
    for row in rows:
        assert abs(row["total_spent"] - row["frequency"] * row["avg_basket"]) <= row["frequency"] * Decimal("0.005")


def test_order_amounts_count_items(shop):
    shop.customer("a", "P").product("x", "toys")
    shop.order("o", "a", "2018-01-01T00:00:00", items=[("x", "5.10", "0.20"), ("x", "1", "0")])
    t = shop.tables()
    rows = plans.order_amounts(t["customers"], t["orders"], t["order_items"]).collect()
    assert [tuple(r) for r in rows] == [("P", "o", at("2018-01-01T00:00:00"), Decimal("6.30"), 2)]


def test_top_preview_and_summary(shop):
    random_shop(shop, 5)
    features = features_of(shop.tables())
    expected = brute_force(shop)
    top = [r.customer_unique_id for r in plans.top_customers(features, 3).collect()]
    assert top == sorted(expected, key=lambda c: (-expected[c]["total_spent"], c))[:3]
    assert plans.preview(features, 2).count() == 2
    summary = plans.features_summary(features).first()
    rows = list(expected.values())
    assert summary.nb_clients == len(rows)
    assert summary.clients_recurrents == sum(r["frequency"] > 1 for r in rows)
    assert summary.recency_moyenne == half_away(Fraction(sum(r["recency_days"] for r in rows), len(rows)), 1)
    assert summary.depense_moyenne == half_away(Fraction(sum(r["total_spent"] for r in rows)) / len(rows), 2)
