"""Exact distinct counts of categories by bitmaps.

The categories in use are numbered once; a set of them is then a few 64-bit words
whose union is a bitwise or, an aggregate that combines inside map tasks, and
whose size is a count of bits. Bit 0 of the first word only says that
a product was known, which tells "no category" from "no product".
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_CATEGORIES = 1023  # sixteen words
_CATEGORY = "product_category_name"
_NUMBERS = T.StructType([T.StructField(_CATEGORY, T.StringType()), T.StructField("number", T.IntegerType())])


@dataclass(frozen=True)
class CategoryBits:
    """Categories by number, counted from 1; ``room`` is the least number of words, for categories to come."""

    names: tuple[str, ...]
    room: int = 1

    @classmethod
    def of(cls, products: DataFrame, known: Sequence[str] = (), room: int = 1) -> CategoryBits | None:
        """Number the categories of ``products``; those in ``known`` keep their places. None if there are too many."""
        found = products.select(_CATEGORY).where(f"{_CATEGORY} IS NOT NULL").distinct().limit(MAX_CATEGORIES + 1).collect()
        names = [*known, *sorted({r[0] for r in found} - set(known))]
        return cls(tuple(names), room) if len(names) <= MAX_CATEGORIES else None

    @property
    def words(self) -> list[str]:
        return [f"categories_{k}" for k in range(max(self.room, len(self.names) // 64 + 1))]

    @property
    def count(self) -> str:
        """The number of categories in the words of a row; NULL if no product was known."""
        return f"NULLIF({' + '.join(f'BIT_COUNT({w})' for w in self.words)}, 0) - 1"

    def merged(self) -> list[Column]:
        """The union of the words of a group."""
        return [F.expr(f"BIT_OR({w}) AS {w}") for w in self.words]

    def on_products(self, products: DataFrame) -> DataFrame:
        """product_id and the words of each product."""
        spark = products.sparkSession
        numbers = spark.createDataFrame([(name, k) for k, name in enumerate(self.names, start=1)], _NUMBERS)
        numbered = products.select("product_id", _CATEGORY).join(F.broadcast(numbers), _CATEGORY, "left")
        words = [
            f"IF(number DIV 64 = {k}, SHIFTLEFT(1L, number % 64), 0L)" if k else
            "1L | IF(number < 64, SHIFTLEFT(1L, number), 0L)"
            for k in range(len(self.words))
        ]
        return numbered.selectExpr("product_id", *(f"{word} AS {name}" for word, name in zip(words, self.words)))

    def on_items(self, items: DataFrame, products: DataFrame) -> DataFrame:
        """Items with the words of their product; none set where the product is unknown."""
        return items.join(self.on_products(products), "product_id", "left")
