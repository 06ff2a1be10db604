from __future__ import annotations

import pytest

from buyerlens.operators import integrity
from buyerlens.sources.schemas import ORDER_ITEMS, ORDERS, TABLES
from tests.conftest import at, money


@pytest.fixture
def sound(shop):
    shop.customer("a", "P").product("x", "toys")
    shop.order("o1", "a", "2018-01-01T00:00:00", items=[("x", "5", "0")], scores=[3])
    return shop


def test_sound_tables_pass(sound):
    integrity.require_integrity(sound.tables())


def count_by(df, *keys):
    value = df.columns[-1]
    return {tuple(r[k] for k in keys): r[value] for r in df.collect() if r[value]}


def test_duplicate_and_missing_keys(sound):
    sound.customer("a", "Q").customer("a", "R").customer(None, "S")
    rows = {r.table_name: r for r in integrity.key_violations(relaxed(sound)).collect()}
    assert len(rows) == 8
    assert tuple(rows["customers"])[2:] == (1, 2, 1)
    assert tuple(rows["order_items"])[2:] == (0, 0, 0)
    keys = integrity.duplicate_keys(relaxed(sound)["customers"], ("customer_id",)).collect()
    assert sorted((str(k.customer_id), k.row_count) for k in keys) == [("None", 1), ("a", 3)]


def relaxed(shop):
    """The tables with every column nullable, as files deliver them."""
    frames = {}
    for name, rows in shop.rows.items():
        ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in integrity.TABLES[name].schema)
        frames[name] = shop.spark.createDataFrame(rows, ddl)
    frames["sellers"] = shop.spark.createDataFrame(
        [("seller", "01000", "city", "SP")],
        "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string",
    )
    return frames


def test_composite_key(sound):
    sound.rows["order_items"] += [sound.rows["order_items"][0]]
    rows = {r.table_name: r for r in integrity.key_violations(relaxed(sound)).collect()}
    assert (rows["order_items"].duplicate_keys, rows["order_items"].surplus_rows) == (1, 1)


def test_orphans_count_keys_and_rows(sound):
    sound.order("o2", "ghost", "2018-01-01T00:00:00", items=[("y", "1", "0"), ("y", "1", "0")])
    sound.order("o3", "ghost", "2018-01-01T00:00:00")
    rows = {(r.table_name, r.column_name): (r.orphan_keys, r.orphan_rows)
            for r in integrity.orphan_counts(relaxed(sound)).collect()}
    assert len(rows) == 6
    assert rows[("orders", "customer_id")] == (1, 2)
    assert rows[("order_items", "product_id")] == (1, 2)
    assert rows[("order_items", "order_id")] == (0, 0)


def test_null_reference_is_no_orphan(sound):
    tables = relaxed(sound)
    sound.rows["orders"].append(("o9", None, "delivered", at("2018-01-01T00:00:00"), None, None, None, None))
    orphans = integrity.orphan_keys(relaxed(sound)["orders"], ORDERS.foreign_keys[0], tables["customers"])
    assert orphans.count() == 0


def test_null_and_length_rules(sound):
    sound.rows["customers"] += [("b", "Q", "123456", "city", "SPX"), ("c", None, "12345   ", "city", "S")]
    found = count_by(integrity.null_and_length_violations(relaxed(sound)), "table_name", "column_name", "rule")
    assert found == {
        ("customers", "customer_zip_code_prefix", "length <= 5"): 1,
        ("customers", "customer_state", "length <= 2"): 1,
        ("customers", "customer_unique_id", "not null"): 1,
    }


def test_value_rules(sound):
    day = at("2018-01-01T00:00:00")
    sound.rows["order_items"] += [
        ("o1", 2, "x", "seller", day, money("-0.01"), money("0")),
        ("o1", 3, "x", "seller", day, None, money("-5")),
    ]
    sound.rows["order_reviews"] += [("r8", "o1", 0, None, None, day, day), ("r9", "o1", 6, None, None, day, day)]
    assert count_by(integrity.check_violations(relaxed(sound)), "table_name", "check_name") == {
        ("order_items", "price_not_negative"): 1,
        ("order_items", "freight_not_negative"): 1,
        ("order_reviews", "score_in_range"): 2,
    }


def test_strict_mode_names_every_broken_rule(sound):
    sound.customer("a", "Q").order("o2", "ghost", "2018-01-01T00:00:00", scores=[6])
    with pytest.raises(integrity.IntegrityError) as raised:
        integrity.require_integrity(relaxed(sound))
    message = str(raised.value)
    assert "customers key customer_id: 1" in message
    assert "orders customer_id -> customers: 1" in message
    assert "order_reviews score_in_range review_score BETWEEN 1 AND 5: 1" in message


def test_keys_of_several_columns_do_not_read_alike(spark):
    tables = {"order_payments": spark.createDataFrame(
        [("1", 12), ("11", 2), ("1:1", 2), ("1", 12), (None, 1), ("x", None)], "order_id string, payment_sequential int")}
    (row,) = integrity.key_violations(tables).collect()
    assert tuple(row)[2:] == (1, 1, 2)


def test_one_pass_finds_what_the_single_checks_find(sound):
    sound.customer("a", "Q").customer(None, "S").order("o2", "ghost", "2018-01-01T00:00:00", items=[("y", "1", "0")] * 2, scores=[9])
    tables = relaxed(sound)
    report = {(r.table_name, r.rule): r.violations for r in integrity.key_report(tables).collect()}
    assert len(report) == 8 + 6
    single = {(r.table_name, f"key {r.key_columns}"): r.surplus_rows + r.null_key_rows for r in integrity.key_violations(tables).collect()}
    single |= {(r.table_name, f"{r.column_name} -> {r.parent_table}"): r.orphan_rows for r in integrity.orphan_counts(tables).collect()}
    assert report == single
    for table in TABLES.values():
        for key in table.foreign_keys:
            orphans = integrity.orphan_keys(tables[table.name], key, tables[key.parent]).collect()
            assert report[table.name, f"{key.column} -> {key.parent}"] == sum(r.row_count for r in orphans)


def test_one_shuffle_of_keys_and_one_scan_per_table(sound, tmp_path):
    tables = {}
    for name, df in relaxed(sound).items():
        df.write.parquet(f"{tmp_path}/{name}")
        tables[name] = sound.spark.read.parquet(f"{tmp_path}/{name}")
    plan = integrity.key_report(tables)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 8
    assert len([x for x in plan.splitlines() if "Exchange hashpartitioning(domain" in x]) == 2  # keys; then one row per domain
    assert "Join" not in plan.replace("BroadcastHashJoin", "")


def test_empty_tables_break_nothing(shop):
    tables = {name: df.limit(0) for name, df in relaxed(shop).items()}
    assert {r.violations for r in integrity.key_report(tables).collect()} == {0}
    integrity.require_integrity(tables)


def test_broken_rows_carry_the_names_of_their_rules(sound):
    day = at("2018-01-01T00:00:00")
    sound.rows["order_items"] += [("o1", 2, "x", "seller", day, money("-1"), None), ("o1", 3, None, "s" * 33, day, money("1"), money("-1"))]
    rows = integrity.broken_rows(relaxed(sound)["order_items"], ORDER_ITEMS).orderBy("order_item_id").collect()
    assert [(r.order_item_id, r.broken_rules) for r in rows] == [
        (2, ["freight_value: not null", "price_not_negative: price >= 0"]),
        (3, ["product_id: not null", "seller_id: length <= 32", "freight_not_negative: freight_value >= 0"]),
    ]


def test_quarantine_parts_every_row(sound, tmp_path):
    sound.rows["order_reviews"] += [("r8", "o1", 0, None, None, None, at("2018-01-01T00:00:00"))]
    tables = relaxed(sound)
    good, bad = integrity.quarantine(tables, str(tmp_path))
    for name, df in tables.items():
        assert good[name].columns == df.columns
        kept, aside = good[name].collect(), bad[name].drop(integrity.BROKEN).collect()
        assert sorted(map(str, kept + aside)) == sorted(map(str, df.collect()))
        assert {r.violations for r in integrity.rule_violations({name: good[name]}).collect()} <= {0}
    assert [r.broken_rules for r in bad["order_reviews"].collect()] == [
        ["review_creation_date: not null", "score_in_range: review_score BETWEEN 1 AND 5"]]
