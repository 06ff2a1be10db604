from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import Row

from buyerlens.operators import sequence
from buyerlens.operators.sequence import order_sequence

SCHEMA = "customer_unique_id string, order_id string, order_purchase_timestamp timestamp_ntz, order_amount decimal(22,2), item_count bigint"


def histories(seed: int, moments: int) -> list[tuple]:
    """400 orders, a third of them by one person, many at the same moment."""
    dice = random.Random(seed)
    rows = []
    for n in range(400):
        person = "hot" if n % 3 == 0 else f"c{dice.randrange(60)}"
        moment = dt.datetime(2018, 1, 1) + dt.timedelta(hours=dice.randrange(moments))
        rows.append((person, f"o{n:04}", moment, Decimal(dice.randrange(1, 10**6)).scaleb(-2), 1))
    dice.shuffle(rows)
    return rows


def brute_force(rows):
    expected, last, number = {}, {}, {}
    for person, order, moment, amount, _ in sorted(rows, key=lambda r: (r[0], r[2], r[1])):
        number[person] = number.get(person, 0) + 1
        expected[order] = (number[person], *last.get(person, (None, None)))
        last[person] = (amount, moment)
    return expected


@pytest.mark.parametrize("chunks", [1, 5, 40])
@pytest.mark.parametrize("moments", [1, 500])
def test_matches_brute_force_however_customers_are_cut(spark, chunks, moments):
    rows = histories(chunks, moments)
    result = order_sequence(spark.createDataFrame(rows, SCHEMA), chunks).collect()
    found = {r.order_id: (r.order_number, r.previous_amount, r.previous_purchase) for r in result}
    assert len(result) == len(rows)
    assert found == brute_force(rows)


def test_a_hot_customer_is_spread_over_tasks(spark):
    df = order_sequence(spark.createDataFrame(histories(7, 500), SCHEMA), 12)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # What is left to do is a scan and a join with at most one row per chunk: no exchange of orders or customers.
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "Window" not in plan


def test_rows_carried_from_chunk_to_chunk():
    def boundary(chunk, first, last, position):
        return Row(**{"__chunk": chunk, "first": first, "last": Row(
            customer_unique_id=last, __position=position, order_amount=chunk * 10, order_purchase_timestamp=chunk)})

    chunks = [boundary(0, "a", "b", 3), boundary(1, "b", "b", 4), boundary(3, "b", "b", 2), boundary(4, "b", "c", 1),
              boundary(5, "d", "d", 5), boundary(6, "d", "e", 1)]
    assert sequence._carried(chunks) == [(1, "b", 3, 0, 0), (3, "b", 7, 10, 1), (4, "b", 9, 30, 3), (6, "d", 5, 50, 5)]


def test_no_orders(spark):
    assert order_sequence(spark.createDataFrame([], SCHEMA)).count() == 0
