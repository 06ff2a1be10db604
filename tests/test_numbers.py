from __future__ import annotations

import math
from decimal import Decimal
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from buyerlens.functions.numbers import from_units, percentage, ratio


def half_away(value: Fraction, digits: int) -> Decimal:
    scaled = abs(value) * 10**digits
    units = math.floor(scaled + Fraction(1, 2))
    return Decimal(units if value >= 0 else -units).scaleb(-digits)


def evaluate(spark, pairs, digits, scale):
    df = spark.createDataFrame([(i, n, d) for i, (n, d) in enumerate(pairs)], "i int, n bigint, d bigint")
    rows = df.selectExpr("i", f"{ratio('n', 'd', digits, scale)} AS r").orderBy("i").collect()
    return [row.r for row in rows]


@settings(max_examples=8, deadline=None)
@given(
    st.lists(st.tuples(st.integers(-10**13, 10**13), st.integers(1, 10**9)), min_size=1, max_size=60),
    st.sampled_from([(2, 2), (1, 0), (0, 0), (2, 0)]),
)
def test_ratio_is_exact(spark, pairs, shape):
    digits, scale = shape
    expected = [half_away(Fraction(n, d * 10**scale), digits) for n, d in pairs]
    assert evaluate(spark, pairs, digits, scale) == expected


def test_half_cents_go_away_from_zero(spark):
    assert evaluate(spark, [(5, 2), (-5, 2), (469, 2), (-469, 2)], 2, 2) == [
        Decimal("0.03"), Decimal("-0.03"), Decimal("2.35"), Decimal("-2.35")
    ]


def test_large_group_does_not_double_round(spark):
    # 0.004999999995 rounds to 0.005 at ten digits, and that to 0.01.
    assert evaluate(spark, [(10**10 - 10, 2 * 10**10)], 2, 2) == [Decimal("0.00")]


def test_zero_and_null_denominators_give_null(spark):
    df = spark.createDataFrame([(1, 0), (1, None), (None, 3)], "n bigint, d bigint")
    assert [r[0] for r in df.selectExpr(ratio("n", "d", 2)).collect()] == [None, None, None]


def test_percentage_and_units(spark):
    row = spark.range(1).selectExpr(f"{percentage('1', '3', 1)} AS p", f"{from_units('-1234', 2)} AS u").first()
    assert (row.p, row.u) == (Decimal("33.3"), Decimal("-12.34"))


def test_sum_out_of_range_stops_the_job(spark):
    df = spark.createDataFrame([(2**62, 1)], "n bigint, d bigint")
    with pytest.raises(Exception, match="OVERFLOW"):
        df.selectExpr(ratio("n", "d", 2)).collect()
