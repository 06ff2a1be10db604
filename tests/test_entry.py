"""Every registered query against its SQL on the smallest test tables."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

import pytest

import __spark_entry__ as registry
from oracle_queries import ORACLES

FOLDER = Path(registry.SMOKE_DIR)
TABLES = "region nation customer supplier part orders lineitem".split()

pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    own = {name for name in registry.queries() if not (name.startswith("op") or name == "pipeline")} | {
        name for name in registry.queries() if name.startswith("order_")}
    assert own == set(ORACLES)
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    df = registry.queries()[name](spark, str(FOLDER))
    result = duck.execute(registry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    rows = result.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert normal(df.columns, [tuple(r) for r in df.collect()]) == normal(columns, rows)
    assert {f.dataType.simpleString() for f in df.schema} <= {"bigint", "double", "string", "timestamp_ntz"}


def test_entry_returns_the_feature_table(spark):
    df = registry.entry(spark)
    assert df.columns[0] == "customer_unique_id" and len(df.columns) == 10
    assert df.count() > 0
