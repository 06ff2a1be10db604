from __future__ import annotations

import datetime as dt
import sys
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from buyerlens.session import build_session
from buyerlens.sources.schemas import TABLES


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "buyerlens-tests",
        master="local[4]",
        settings={
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            # Calendar arithmetic must not depend on the session zone.
            "spark.sql.session.timeZone": "America/Sao_Paulo",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def money(text: str) -> Decimal:
    return Decimal(text)


class Shop:
    """Hand-made tables: name what matters, the rest gets a fixed filler."""

    def __init__(self, spark):
        self.spark = spark
        self.rows: dict[str, list[tuple]] = {name: [] for name in TABLES}

    def customer(self, account, person, state="SP"):
        self.rows["customers"].append((account, person, "01000", "city", state))
        return self

    def product(self, product, category):
        self.rows["products"].append((product, category, None, None, None, None, None, None, None))
        return self

    def order(self, order, account, bought, status="delivered", items=(), scores=(), carrier=None, delivered=None):
        """``items`` holds (product, price, freight)."""
        bought = at(bought)
        self.rows["orders"].append((order, account, status, bought, None, carrier, delivered, bought))
        for n, (product, price, freight) in enumerate(items, start=1):
            self.rows["order_items"].append((order, n, product, "seller", bought, money(price), money(freight)))
        for n, score in enumerate(scores):
            self.rows["order_reviews"].append((f"{order}-r{n}", order, score, None, None, bought, bought))
        return self

    def tables(self):
        frames = {
            name: self.spark.createDataFrame(rows, TABLES[name].schema) for name, rows in self.rows.items()
        }
        frames["sellers"] = self.spark.createDataFrame([("seller", "01000", "city", "SP")], TABLES["sellers"].schema)
        return frames


@pytest.fixture
def shop(spark):
    return Shop(spark)
