"""Bucket labels and histogram bins."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper edges in days (inclusive) and the labels shown for them.
RECENCY_EDGES = [
    (30, "0-30j"),
    (90, "31-90j"),
    (180, "91-180j"),
    (365, "181-365j"),
]
RECENCY_BEYOND = "> 365j"
FREQUENCY_CAP = 5


def recency_bucket(
    days: Column,
    edges: Sequence[tuple[int, str]] = tuple(RECENCY_EDGES),
    beyond: str = RECENCY_BEYOND,
) -> Column:
    """Label of the first edge not exceeded; ``edges`` ascend."""
    label = F.lit(beyond)
    for edge, name in reversed(edges):
        label = F.when(days <= edge, name).otherwise(label)
    return label


def frequency_bucket(orders: Column, cap: int = FREQUENCY_CAP) -> Column:
    return F.when(orders >= cap, f"{cap}+").otherwise(orders.cast("string"))


def bin_start(value: Column, width: int | Decimal) -> Column:
    """Lower edge of the equal-width bin a decimal falls in."""
    step = F.lit(Decimal(width))
    return F.floor(value / step) * step
