"""Keep one row per key: the newest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def keep_latest(
    df: DataFrame,
    keys: Sequence[str],
    newest_by: Sequence[str],
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """One row per ``keys``: highest ``newest_by`` (NULL counts as newest), then lowest ``tie_break``.

    The rank filter lets Spark cut each key to one row per map task before the
    shuffle, so a key that holds a large share of the rows stays cheap.
    """
    newest_first = [F.col(c).desc_nulls_first() for c in newest_by]
    lowest_first = [F.col(c).asc_nulls_last() for c in tie_break]
    order = Window.partitionBy(*keys).orderBy(*newest_first, *lowest_first)
    return df.withColumn(_RANK, F.row_number().over(order)).where(F.col(_RANK) == 1).drop(_RANK)
