"""Differential refresh: a delivery changes only the people it concerns.

What is materialized is the state of each person (``person_state``). Features are row-wise
expressions over it and of the day, so they follow from it when read, for any day.

A delivery holds new and corrected rows of any table. People of whom it only has new orders get
the state of those orders merged into theirs. People with a corrected order, item, review,
account or product are computed again, from their own orders alone. All others keep their rows, and
key ranges without anyone concerned are not rewritten. The result equals a full recomputation.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from buyerlens.operators.categories import CategoryBits
from buyerlens.plans.features import (
    AS_OF,
    NEGATIVE_SCORE,
    customer_features,
    features_of_state,
    merged_states,
    person_state,
)
from buyerlens.session import scratch_path
from buyerlens.sources.schemas import TABLES
from buyerlens.sources.versions import VersionedTable

_PERSON = "customer_unique_id"
_TABLES = ("customers", "orders", "order_items", "order_reviews", "products")
SPARE_WORDS = 1  # for categories that later deliveries bring


def state_store(spark: SparkSession, root: str) -> VersionedTable:
    """The materialized state under ``root``."""
    return VersionedTable(spark, root, _PERSON)


def upserted(rows: DataFrame, delivered: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """``rows`` with those of the delivered keys replaced, and new ones added."""
    return rows.join(delivered.select(*key), list(key), "left_anti").unionByName(delivered.select(*rows.columns))


def merged_tables(tables: Mapping[str, DataFrame], delivery: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All tables after a delivery of new and corrected rows."""
    return {
        name: upserted(df, delivery[name], TABLES[name].primary_key) if name in delivery else df
        for name, df in tables.items()
    }


def publish_state(store: VersionedTable, tables: Mapping[str, DataFrame], negative_score: int = NEGATIVE_SCORE,
                  segments: int | None = None) -> int:
    """Compute and publish the state of everyone.

    Raises ``ValueError`` for more categories than bitmaps hold; such features
    are published as a table (``plans.build.feature_store``), which has no state to merge.
    """
    bits = CategoryBits.of(tables["products"])
    if bits is None:
        raise ValueError("too many categories for a state that can be merged")
    bits = CategoryBits(bits.names, len(bits.words) + SPARE_WORDS)
    state = person_state(*(tables[n] for n in _TABLES), negative_score, bits)
    return store.publish(state, _notes(bits, negative_score), segments)


def _notes(bits: CategoryBits, negative_score: int) -> dict:
    return {"categories": list(bits.names), "room": bits.room, "negative_score": negative_score}


def read_features(store: VersionedTable, as_of: dt.date = AS_OF) -> DataFrame:
    """The features of the current state as of a day."""
    notes = store.notes()
    return features_of_state(store.read(), CategoryBits(tuple(notes["categories"]), notes["room"]).count, as_of)


def _changed_orders(before: Mapping[str, DataFrame], after: Mapping[str, DataFrame], delivery: Mapping[str, DataFrame]) -> DataFrame:
    """(order_id, corrected) of all orders that a delivery has something of; not corrected: all of it is new.

    The reviews in ``before`` are those that delivered ones replace.
    """
    found = []
    if "orders" in delivery:
        found.append(delivery["orders"].select("order_id"))
    if "order_items" in delivery:
        found.append(delivery["order_items"].select("order_id"))
    if "order_reviews" in delivery:
        reviews = delivery["order_reviews"]
        found += [reviews.select("order_id"), before["order_reviews"].select("order_id")]
    if "customers" in delivery:
        accounts = delivery["customers"].select("customer_id").distinct()
        found += [t["orders"].join(accounts, "customer_id", "left_semi").select("order_id") for t in (before, after)]
    if "products" in delivery:
        products = delivery["products"].select("product_id").distinct()
        found.append(before["order_items"].join(products, "product_id", "left_semi").select("order_id"))
    orders = found[0]
    for more in found[1:]:
        orders = orders.unionByName(more)
    known = before["orders"].select("order_id", F.lit(True).alias("known")).distinct()
    return orders.distinct().join(known, "order_id", "left").select("order_id", F.coalesce("known", F.lit(False)).alias("corrected"))


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _met_once(tables: Mapping[str, DataFrame], after: Mapping[str, DataFrame],
              delivery: Mapping[str, DataFrame]) -> tuple[dict[str, DataFrame], dict[str, DataFrame], dict[str, DataFrame]]:
    """The same tables, with what a refresh needs of orders and reviews written where it is needed several times.

    Orders after the delivery are read by several steps, and so are the reviews, of which those before
    the delivery meet the delivered ones once and are told apart by that.
    """
    tables, after, delivery = dict(tables), dict(after), dict(delivery)
    if "orders" in delivery:
        after["orders"] = _written(after["orders"].select(
            "order_id", "customer_id", "order_status", "order_purchase_timestamp"), "orders-after")
    if "order_reviews" in delivery:
        columns = ["review_id", "order_id", "review_score"]
        new = _written(delivery["order_reviews"].select(*columns), "reviews-new")
        ids = new.select("review_id", F.lit(True).alias("replaced")).distinct()
        old = _written(tables["order_reviews"].select(*columns).join(ids, "review_id", "left"), "reviews-before")
        delivery["order_reviews"], tables["order_reviews"] = new, old.where("replaced").select(*columns)
        after["order_reviews"] = old.where("replaced IS NULL").select(*columns).unionByName(new)
    return tables, after, delivery


def refresh_state(store: VersionedTable, tables: Mapping[str, DataFrame], delivery: Mapping[str, DataFrame],
                  segments: int | None = None) -> int:
    """Bring the state up to date with a delivery; ``tables`` are those before it.

    Should the delivery bring more categories than there is room for, everyone is
    computed again. ``segments`` is used then.
    """
    after = merged_tables(tables, delivery)
    notes = store.notes()
    bits = CategoryBits.of(after["products"], notes["categories"], notes["room"])
    if bits is None or len(bits.words) > notes["room"]:
        return publish_state(store, after, notes["negative_score"], segments)
    if not delivery:
        return store.publish(store.read(), notes, segments)

    tables, after, delivery = _met_once(tables, after, delivery)
    changed = _written(_changed_orders(tables, after, delivery), "changed-orders")
    owners = [
        changed.join(t["orders"].select("order_id", "customer_id"), "order_id").join(
            t["customers"].select("customer_id", _PERSON), "customer_id").select(_PERSON, "corrected")
        for t in (tables, after)
    ]
    people = _written(owners[0].unionByName(owners[1]).groupBy(_PERSON).agg(F.max("corrected").alias("corrected")), "people")
    again = people.where("corrected").select(_PERSON)
    only_new = people.where("NOT corrected").select(_PERSON)

    accounts = after["customers"].join(again, _PERSON, "left_semi").select("customer_id")
    orders = after["orders"].join(accounts, "customer_id", "left_semi").unionByName(
        after["orders"].join(accounts, "customer_id", "left_anti").join(changed.select("order_id"), "order_id", "left_semi"))
    orders = _written(orders.select("order_id", "customer_id", "order_status", "order_purchase_timestamp"), "orders-again")
    ids = orders.select("order_id")
    state = person_state(
        after["customers"], orders, after["order_items"].join(ids, "order_id", "left_semi"),
        after["order_reviews"].join(ids, "order_id", "left_semi"), after["products"], notes["negative_score"], bits)
    kept = store.read().join(only_new, _PERSON, "left_semi")
    rows = merged_states(state.unionByName(kept.select(*state.columns)), bits)
    return store.replace(people.select(_PERSON), rows, _notes(bits, notes["negative_score"]))


def refreshed_equals_full(store: VersionedTable, tables: Mapping[str, DataFrame], as_of: dt.date = AS_OF) -> bool:
    """Whether the state gives the features that a full computation over ``tables`` gives; for audits."""
    full = customer_features(*(tables[n] for n in _TABLES), as_of=as_of, negative_score=store.notes()["negative_score"])
    read = read_features(store, as_of)
    return read.exceptAll(full).isEmpty() and full.exceptAll(read).isEmpty()
