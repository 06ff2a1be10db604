from __future__ import annotations

import random

import pytest

from buyerlens.operators import categories
from buyerlens.operators.categories import CategoryBits
from buyerlens.plans import features as plans
from buyerlens.plans.build import FEATURE_TABLES, features_of


@pytest.fixture
def varied(shop):
    """150 categories, products without one, items of unknown products, people without known products."""
    dice = random.Random(8)
    for n in range(180):
        shop.product(f"p{n}", f"cat{n:03}" if n < 150 else None)
    bought: dict[str, set] = {}
    for n in range(300):
        person = f"u{n % 23}"
        shop.customer(f"a{n}", person)
        items = [f"p{dice.randrange(180)}" for _ in range(dice.randrange(0, 9))] if n % 23 else ["gone"]
        if n % 23 == 1:
            items = ["p160", "gone"]
        shop.order(f"o{n}", f"a{n}", f"2018-01-{n % 28 + 1:02}T00:00:00", items=[(i, "1.10", "0.05") for i in items],
                   scores=[n % 5 + 1] * (n % 3))
        known = [int(i[1:]) for i in items if i != "gone"]
        if known:
            bought.setdefault(person, set()).update(k for k in known if k < 150)
    return shop.tables(), {person: len(found) for person, found in bought.items()}


def diversity(df):
    return {r.customer_unique_id: r.category_diversity for r in df.collect()}


def test_bits_count_what_sets_count(varied):
    tables, expected = varied
    arguments = [tables[n] for n in ("customers", "orders", "order_items", "products")]
    assert len(CategoryBits.of(tables["products"]).words) == 3
    assert diversity(plans.features_diversity(*arguments)) == expected
    assert diversity(plans.diversity_by_distinct(*arguments)) == expected
    assert expected["u1"] == 0 and "u0" not in expected
    whole = diversity(features_of(tables))
    assert whole == {**{p: None for p in whole}, **expected}


def test_more_categories_than_bitmaps_hold(varied, monkeypatch):
    tables, expected = varied
    by_bits = sorted(map(tuple, features_of(tables).collect()))
    monkeypatch.setattr(categories, "MAX_CATEGORIES", 149)
    assert CategoryBits.of(tables["products"]) is None
    assert sorted(map(tuple, features_of(tables).collect())) == by_bits
    assert diversity(plans.features_diversity(*(tables[n] for n in ("customers", "orders", "order_items", "products")))) == expected


def test_known_categories_keep_their_numbers(varied):
    tables, _ = varied
    bits = CategoryBits.of(tables["products"], known=["zebra", "cat007"])
    assert bits.names[:2] == ("zebra", "cat007") and len(bits.names) == 151


def test_states_of_parts_merge_into_the_whole(varied):
    tables, _ = varied
    bits = CategoryBits.of(tables["products"])
    arguments = [tables[n] for n in FEATURE_TABLES]
    parts = None
    for rest in range(3):
        part = [*arguments]
        part[1] = tables["orders"].where(f"CAST(SUBSTRING(order_id, 2) AS INT) % 3 = {rest}")
        state = plans.person_state(*part, bits=bits)
        parts = state if parts is None else parts.unionByName(state)
    merged = plans.features_of_state(plans.merged_states(parts, bits), bits.count)
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, features_of(tables).collect()))


def test_no_products(shop):
    shop.customer("a", "P").order("o", "a", "2018-01-01T00:00:00", items=[("x", "2", "1")])
    (row,) = features_of(shop.tables()).collect()
    assert row.category_diversity is None and row.frequency == 1
