from __future__ import annotations

import datetime as dt

import pytest

from buyerlens.operators.integrity import IntegrityError
from buyerlens.plans.build import VIEW, build, feature_store, publish_view
from buyerlens.session import CHECKPOINT_SETTING, file_system, shared_folder
from buyerlens.sources.schemas import TABLES
from buyerlens.sources.versions import Conflict, VersionedTable

CSV = {
    "customers": 'a,P,01409,franca,SP\nb,Q,01409,"rio, RJ",RJ\n',
    "sellers": "s,01409,franca,SP\n",
    "products": "x,,40,287,1,225,16,10,14\n",
    "product_category_translation": "toys,toys\n",
    "orders": "o,a,delivered,2018-10-07 10:00:00,,,,2018-10-09 00:00:00\n",
    "order_items": "o,1,x,s,2018-10-08 00:00:00,10.00,2.50\n",
    "order_payments": "o,1,voucher,1,12.50\n",
    "order_reviews": 'r,o,4,,"fine",2018-10-09 00:00:00,2018-10-10 00:00:00\n',
}


@pytest.fixture
def delivery(tmp_path):
    paths = {}
    for name, body in CSV.items():
        path = tmp_path / f"{name}.csv"
        path.write_text(",".join(f.name for f in TABLES[name].schema) + "\n" + body)
        paths[name] = str(path)
    return paths


def test_from_files_to_published_features(spark, tmp_path, delivery):
    store = feature_store(spark, str(tmp_path / "store"))
    row = build(spark, delivery, store).first()
    assert (row.customer_unique_id, row.recency_days, str(row.total_spent), row.category_diversity) == (
        "P", 10, "12.50", 1
    )
    assert store.lookup("P").count() == 1 and store.lookup("Q").count() == 0


def test_strict_build_refuses_broken_files(spark, tmp_path, delivery):
    orders = tmp_path / "orders.csv"
    orders.write_text(orders.read_text() + "o2,ghost,delivered,2018-10-07 10:00:00,,,,2018-10-09 00:00:00\n")
    store = feature_store(spark, str(tmp_path / "store"))
    with pytest.raises(IntegrityError, match="ghost|customers"):
        build(spark, delivery, store)
    with pytest.raises(LookupError):
        store.read()
    assert build(spark, delivery, store, strict=False).count() == 1


def test_refresh_does_not_disturb_a_reader(spark, tmp_path):
    store = feature_store(spark, str(tmp_path / "store"))
    columns = "customer_unique_id string, total_spent int"
    store.publish(spark.createDataFrame([("P", 1)], columns))
    before = store.read()
    store.publish(spark.createDataFrame([("P", 2), ("Q", 3)], columns))
    assert [r.total_spent for r in before.collect()] == [1]
    assert sorted(r.total_spent for r in store.read().collect()) == [2, 3]


def test_failed_refresh_leaves_the_current_version(spark, tmp_path):
    store = feature_store(spark, str(tmp_path / "store"))
    columns = "customer_unique_id string, total_spent int"
    store.publish(spark.createDataFrame([("P", 1)], columns))
    broken = spark.createDataFrame([("P", 0)], columns).selectExpr("customer_unique_id", "1 DIV total_spent AS x")
    with pytest.raises(Exception):
        store.publish(broken)
    assert [r.total_spent for r in store.read().collect()] == [1]


def test_repeated_key_is_refused(spark, tmp_path):
    store = feature_store(spark, str(tmp_path / "store"))
    columns = "customer_unique_id string, total_spent int"
    store.publish(spark.createDataFrame([("P", 1)], columns))
    with pytest.raises(ValueError, match="'Q' has several rows"):
        store.publish(spark.createDataFrame([("Q", 1), ("Q", 2)], columns))
    assert [r.total_spent for r in store.read().collect()] == [1]


COLUMNS = "customer_unique_id string, total_spent int"


def people(n, start=0):
    return [(f"c{k:04}", k) for k in range(start, start + n)]


@pytest.fixture
def store(spark, tmp_path):
    found = feature_store(spark, str(tmp_path / "store"))
    found.publish(spark.createDataFrame(people(400), COLUMNS), segments=4)
    return found


def contents(df):
    return {r.customer_unique_id: r.total_spent for r in df.collect()}


def test_refused_versions_and_failed_writes_leave_nothing_behind(spark, store, tmp_path):
    before = sorted(p.name for p in (tmp_path / "store").iterdir())
    with pytest.raises(ValueError):
        store.publish(spark.createDataFrame([(None, 1), (None, 2)], COLUMNS))
    with pytest.raises(Exception):
        store.publish(spark.createDataFrame([("P", 0)], COLUMNS).selectExpr("customer_unique_id", "1 DIV total_spent AS x"))
    assert sorted(p.name for p in (tmp_path / "store").iterdir()) == before


def test_replace_writes_only_the_segments_it_touches(spark, store):
    before = {s.folder for s in store.segments()}
    assert len(before) > 2
    keys = spark.createDataFrame([("c0003",), ("c0004",), ("b",)], "customer_unique_id string")
    store.replace(keys, spark.createDataFrame([("c0003", -1), ("b", -2)], COLUMNS))
    expected = {**dict(people(400)), "c0003": -1, "b": -2}
    del expected["c0004"]
    assert contents(store.read()) == expected
    after = {s.folder for s in store.segments()}
    assert len(after & before) == len(before) - 1 and sum(s.row_count for s in store.segments()) == 400
    assert contents(store.lookup("b")) == {"b": -2} and contents(store.lookup("c0004")) == {}
    assert contents(store.lookup("c0399")) == {"c0399": 399} and contents(store.lookup("zz")) == {}


def test_replace_can_empty_a_table_and_fill_it_again(spark, store):
    store.replace(store.read(), spark.createDataFrame([], COLUMNS))
    assert contents(store.read()) == {} and store.segments() == []
    rows = spark.createDataFrame(people(3), COLUMNS)
    store.replace(rows, rows)
    assert contents(store.read()) == dict(people(3))


def test_replace_refuses_repeated_keys(spark, store):
    rows = spark.createDataFrame([("c0001", 1), ("c0001", 2)], COLUMNS)
    with pytest.raises(ValueError, match="c0001"):
        store.replace(rows, rows)
    assert contents(store.read()) == dict(people(400))


def test_two_publishers_at_once(spark, store, monkeypatch):
    """Another version appears after ``replace`` has read the current one."""
    rows = spark.createDataFrame([("c0001", -1)], COLUMNS)
    write = VersionedTable._write

    def late(self, ranged):
        found = write(self, ranged)
        monkeypatch.undo()
        self.publish(spark.createDataFrame([("other", 1)], COLUMNS))
        return found

    monkeypatch.setattr(VersionedTable, "_write", late)
    with pytest.raises(Conflict):
        store.replace(rows, rows)
    assert contents(store.read()) == {"other": 1}


def test_old_versions_go_but_not_what_is_shared_or_leased(spark, store):
    first = {s.folder for s in store.segments()}
    rows = spark.createDataFrame([("c0000", -1)], COLUMNS)
    with store.lease() as leased:
        for _ in range(3):
            store.replace(rows, rows)
        assert store.expire(keep=1) == [2, 3]
        assert contents(leased) == dict(people(400))
    assert store.expire(keep=1) == [1] and store.expire(keep=1) == []
    files, path = file_system(spark, store.root)
    left = {s.folder for s in store.segments()}
    assert contents(store.read()) == {**dict(people(400)), "c0000": -1}
    assert len(left & first) == len(first) - 1
    gone = next(iter(first - left))
    assert not files.exists(file_system(spark, gone)[1])


def test_a_lease_that_ran_out_holds_nothing(spark, store):
    with store.lease(seconds=-1):
        store.publish(spark.createDataFrame(people(1), COLUMNS))
        assert store.expire(keep=1) == [1]


def test_empty_manifest_means_nothing_published(spark, tmp_path):
    store = feature_store(spark, str(tmp_path / "store"))
    (tmp_path / "store" / "manifest").mkdir(parents=True)
    with pytest.raises(LookupError):
        store.read()


def test_lookup_reaches_the_scan(spark, tmp_path):
    store = feature_store(spark, str(tmp_path / "store"))
    store.publish(spark.range(1000).selectExpr("CAST(id AS STRING) AS customer_unique_id", "id AS total_spent"))
    found = store.lookup("77")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(customer_unique_id,77)" in plan
    assert [r.total_spent for r in found.collect()] == [77]


def test_view_for_sql_users(spark, shop):
    shop.customer("a", "P").product("x", "toys").order("o", "a", "2018-10-07T00:00:00", items=[("x", "1", "0")])
    publish_view(shop.tables(), dt.date(2018, 10, 8))
    assert spark.sql(f"SELECT recency_days FROM {VIEW}").first()[0] == 1


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.sparkContext.getConf().get(CHECKPOINT_SETTING)
    folder = shared_folder(spark)
    assert folder == (named or spark.sparkContext.getCheckpointDir())
    assert spark.sparkContext.getCheckpointDir() is not None
