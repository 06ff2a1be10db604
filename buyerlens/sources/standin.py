"""The store's tables, built from the star-schema test tables.

The test data has no e-commerce extract of the declared shape, so each table is
derived row by row from the nearest one. Keys keep their numeric type.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from buyerlens.sources.schemas import MONEY, TABLES

# The day of the last order in the test tables, and limits that suit their prices.
AS_OF = dt.date(2001, 8, 1)
RISK_SPEND = 1_000_000
BASKET_CAP = 250_000
BASKET_BIN = 10_000


def _money(column: str) -> str:
    """A double with two decimals as money, through whole cents: the direct cast goes through text."""
    return f"CAST(CAST(CAST(RINT({column} * 100) AS BIGINT) AS DECIMAL(12, 0)) * 0.01BD AS {MONEY.simpleString()})"


def _zip(key: str) -> str:
    return f"LPAD(CAST({key} % 100000 AS STRING), 5, '0')"


# A review per line item: orders have several, one, or none, and some review ids repeat.
_ORDER_REVIEWS = [
    "CONCAT_WS('-', l_orderkey, l_linenumber) AS review_id",
    "l_orderkey AS order_id",
    "CAST(l_linenumber % 5 + 1 AS SMALLINT) AS review_score",
    "l_returnflag AS review_comment_title",
    "CAST(NULL AS STRING) AS review_comment_message",
    "l_shipdate AS review_creation_date",
    "l_shipdate + INTERVAL 1 DAY AS review_answer_timestamp",
]

# Source table and columns of the tables that need one source only.
_COLUMNS: dict[str, tuple[str, list[str]]] = {
    "products": ("part", [
        "p_partkey AS product_id",
        "NULLIF(p_type, 'ECONOMY') AS product_category_name",
        "CAST(LENGTH(p_name) AS SMALLINT) AS product_name_lenght",
        "CAST(LENGTH(p_brand) AS SMALLINT) AS product_description_lenght",
        "CAST(1 AS SMALLINT) AS product_photos_qty",
        "p_size * 100 AS product_weight_g",
        "CAST(p_size AS SMALLINT) AS product_length_cm",
        "CAST(p_size AS SMALLINT) AS product_height_cm",
        "CAST(p_size AS SMALLINT) AS product_width_cm",
    ]),
    "orders": ("orders", [
        "o_orderkey AS order_id",
        "o_custkey AS customer_id",
        "IF(o_orderstatus = 'F', 'delivered', o_orderstatus) AS order_status",
        "o_orderdate AS order_purchase_timestamp",
        "o_orderdate + INTERVAL 1 DAY AS order_approved_at",
        "IF(o_orderkey % 5 <> 0, o_orderdate + INTERVAL 2 DAYS, NULL) AS order_delivered_carrier_date",
        "IF(o_orderkey % 3 <> 0, o_orderdate + INTERVAL 9 DAYS, NULL) AS order_delivered_customer_date",
        "o_orderdate + INTERVAL 20 DAYS AS order_estimated_delivery_date",
    ]),
    "order_items": ("lineitem", [
        "l_orderkey AS order_id",
        "l_linenumber AS order_item_id",
        "l_partkey AS product_id",
        "l_suppkey AS seller_id",
        "l_shipdate AS shipping_limit_date",
        f"{_money('l_extendedprice')} AS price",
        f"{_money('l_quantity')} AS freight_value",
    ]),
    "order_payments": ("lineitem", [
        "l_orderkey AS order_id",
        "l_linenumber AS payment_sequential",
        "l_returnflag AS payment_type",
        "1 AS payment_installments",
        f"{_money('l_discount')} AS payment_value",
    ]),
}


def standin_table(spark: SparkSession, folder: str, name: str, accounts_per_person: int = 1) -> DataFrame:
    """One table from the parquet files in ``folder``."""
    def read(source: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{source}.parquet")

    if name == "customers":
        person = "c_custkey" if accounts_per_person == 1 else f"c_custkey DIV {accounts_per_person}"
        nations = read("nation").withColumnRenamed("n_nationkey", "c_nationkey")
        return read("customer").join(nations, "c_nationkey").selectExpr(
            "c_custkey AS customer_id",
            f"{person} AS customer_unique_id",
            f"{_zip('c_custkey')} AS customer_zip_code_prefix",
            "c_mktsegment AS customer_city",
            "n_name AS customer_state",
        )
    if name == "sellers":
        nations = read("nation").withColumnRenamed("n_nationkey", "s_nationkey")
        return read("supplier").join(nations, "s_nationkey").selectExpr(
            "s_suppkey AS seller_id",
            f"{_zip('s_suppkey')} AS seller_zip_code_prefix",
            "s_name AS seller_city",
            "n_name AS seller_state",
        )
    if name == "product_category_translation":
        return read("part").selectExpr(
            "p_type AS product_category_name", "LOWER(p_type) AS product_category_name_english"
        ).distinct()
    if name == "order_reviews":
        return read("lineitem").selectExpr(*_ORDER_REVIEWS)
    source, columns = _COLUMNS[name]
    return read(source).selectExpr(*columns)


def standin_tables(
    spark: SparkSession, folder: str, names: Iterable[str] = tuple(TABLES), accounts_per_person: int = 1
) -> dict[str, DataFrame]:
    """The named tables, all eight by default."""
    return {name: standin_table(spark, folder, name, accounts_per_person) for name in names}


# Deliveries that break every kind of rule: keys that repeat or miss, parents that are gone, values out of range.
_DAMAGE: dict[str, tuple[str, list[str]]] = {
    "customers": ("customer_id % 11 <> 0", ["IF(customer_id % 17 = 0, NULL, customer_city) AS customer_city"]),
    "sellers": ("seller_id % 5 <> 0", ["IF(seller_id % 7 = 0, NULL, seller_id) AS seller_id"]),
    "products": ("product_id % 13 <> 0", []),
    "orders": ("order_id % 19 <> 0", ["IF(order_id % 23 = 0, 'a status of 21 signs.', order_status) AS order_status"]),
    "order_items": ("TRUE", [
        "CAST(IF(order_item_id = 7, -price, price) AS DECIMAL(10, 2)) AS price",
        "CAST(IF(product_id % 50 = 0, -freight_value, freight_value) AS DECIMAL(10, 2)) AS freight_value",
        "IF(product_id % 60 = 0, NULL, product_id) AS product_id",
    ]),
    "order_payments": ("TRUE", [
        "IF(payment_sequential = 6, CAST(NULL AS INT), payment_sequential DIV 2) AS payment_sequential",
    ]),
    "order_reviews": ("TRUE", [
        "CAST(review_score * 2 - 4 AS SMALLINT) AS review_score",
        "IF(order_id % 29 = 0, NULL, review_creation_date) AS review_creation_date",
    ]),
}


def damaged_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All eight tables with rows that break their rules; the customers come twice where the id ends in 3."""
    found = {}
    for name, df in standin_tables(spark, folder).items():
        kept, changes = _DAMAGE.get(name, ("TRUE", []))
        changed = {c.rsplit(" AS ", 1)[1]: c for c in changes}
        found[name] = df.where(kept).selectExpr(*(changed.get(c, c) for c in df.columns))
    customers = found["customers"]
    found["customers"] = customers.unionByName(customers.where("customer_id % 10 = 3"))
    return found


# Rows that a later delivery brings or corrects, and what they were before (no change: they were not there).
_LATER: dict[str, tuple[str, list[str]]] = {
    "customers": ("customer_id % 97 = 0", ["customer_unique_id + 1 AS customer_unique_id"]),
    "products": ("product_id % 31 = 0", ["CAST(NULL AS STRING) AS product_category_name"]),
    "orders": ("order_id % 8 = 1", []),
    "order_items": ("order_id % 8 = 1 OR order_id % 50 = 3", ["CAST(price + 1 AS DECIMAL(10, 2)) AS price"]),
    "order_reviews": ("order_id % 8 = 1 OR order_id % 41 = 0", ["CAST(1 AS SMALLINT) AS review_score"]),
}


def before_and_delivery(spark: SparkSession, folder: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """The tables of the features as they were before a delivery, and that delivery."""
    before, delivery = {}, {}
    for name, (later, changes) in _LATER.items():
        df = standin_table(spark, folder, name)
        delivery[name] = df.where(later)
        changed = {c.rsplit(" AS ", 1)[1]: c for c in changes}
        was = delivery[name].selectExpr(*(changed.get(c, c) for c in df.columns))
        gone = "order_id % 8 = 1" if "order_id" in df.columns else "FALSE"
        before[name] = df.where(f"NOT ({later})").unionByName(was.where(f"NOT ({gone})"))
    return before, delivery
