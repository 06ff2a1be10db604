"""Customer features: one row per person, nine measures.

Only orders that were delivered and hold items make a customer. Means are exact
sums over counts. The trend and the gap are means of differences between
successive orders, and such a sum telescopes: it is the last value minus the
first. Both are therefore plain aggregates that combine before the shuffle, and
no customer's history has to be sorted in one task.

Distinct categories are counted with bitmaps: categories are numbered once, an
item carries the bit of its product's category, and bits are or-ed along with
the sums, by order and then by person, before either shuffle. So categories
need no shuffle of their own, and all nine measures come out of one pass over each table:
``person_state`` holds what they need, and two states of the same people can be
merged (``merged_states``), as every column of it is a sum, a first, a last or a bitmap.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buyerlens.functions.numbers import cents, from_units, percentage, ratio
from buyerlens.operators.categories import CategoryBits
from buyerlens.operators.cleaning import DELIVERED
from buyerlens.sources.schemas import MONEY

# The day of the last order in the delivered data, and the
# highest score that still counts as negative.
AS_OF = dt.date(2018, 10, 17)
NEGATIVE_SCORE = 2

_CUSTOMER = "customer_unique_id"
_STAMP = "order_purchase_timestamp"
_MONEY = MONEY.simpleString()
# Position of an order in its customer's history.
_MOMENT = f"STRUCT({_STAMP}, order_id)"

FEATURE_COLUMNS = [
    "customer_unique_id",
    "recency_days",
    "frequency",
    "total_spent",
    "avg_basket",
    "basket_trend",
    "avg_days_between_orders",
    "avg_review_score",
    "pct_negative_reviews",
    "category_diversity",
]


def delivered_orders(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Delivered orders with the person behind them."""
    return (
        orders.where(f"order_status = '{DELIVERED}'")
        .join(customers, "customer_id")
        .select(_CUSTOMER, "order_id", _STAMP)
    )


def _order_cents(order_items: DataFrame) -> DataFrame:
    """Amount in whole cents and number of items per order.

    Prices have two decimals by declaration, so cents are exact, and a whole
    number sums and shuffles faster than a wide decimal. Each map task sends one
    row per order, however many items an order has.
    """
    amount = f"CAST(price AS {_MONEY}) + CAST(freight_value AS {_MONEY})"
    return order_items.groupBy("order_id").agg(
        F.expr(f"SUM({cents(amount)}) AS order_cents"),
        F.expr("COUNT(order_item_id) AS item_count"),
    )


def order_amounts(customers: DataFrame, orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Amount and number of items of each delivered order."""
    return delivered_orders(customers, orders).join(_order_cents(order_items), "order_id").selectExpr(
        _CUSTOMER, "order_id", _STAMP, f"{from_units('order_cents', 2)} AS order_amount", "item_count"
    )


def _recency(as_of: dt.date, last_purchase: str) -> str:
    return f"DATEDIFF(DATE'{as_of}', CAST({last_purchase} AS DATE))"


def features_rfm(amounts: DataFrame, as_of: dt.date = AS_OF) -> DataFrame:
    """Recency, frequency, total and mean basket from ``order_amounts``."""
    return (
        amounts.groupBy(_CUSTOMER)
        .agg(
            F.expr(f"MAX({_STAMP}) AS last_purchase"),
            F.expr("COUNT(*) AS frequency"),
            F.expr(f"SUM({cents('order_amount')}) AS cents"),
        )
        .selectExpr(
            _CUSTOMER,
            f"{_recency(as_of, 'last_purchase')} AS recency_days",
            "frequency",
            f"{from_units('cents', 2)} AS total_spent",
            f"{ratio('cents', 'frequency', 2, scale=2)} AS avg_basket",
        )
    )


def features_trend(amounts: DataFrame) -> DataFrame:
    """Mean change of the amount from one order to the next; customers with two orders or more."""
    return (
        amounts.groupBy(_CUSTOMER)
        .agg(
            F.expr(f"{cents(f'MAX_BY(order_amount, {_MOMENT}) - MIN_BY(order_amount, {_MOMENT})')} AS change"),
            F.expr("COUNT(*) - 1 AS steps"),
        )
        .where("steps > 0")
        .selectExpr(_CUSTOMER, f"{ratio('change', 'steps', 2, scale=2)} AS basket_trend")
    )


def features_gap(amounts: DataFrame) -> DataFrame:
    """Mean days from one order to the next, counted in calendar days; customers with two orders or more."""
    return (
        amounts.groupBy(_CUSTOMER)
        .agg(
            F.expr(f"{_days_between(f'MIN({_STAMP})', f'MAX({_STAMP})')} AS days"),
            F.expr("COUNT(*) - 1 AS steps"),
        )
        .where("steps > 0")
        .selectExpr(_CUSTOMER, f"{ratio('days', 'steps', 1)} AS avg_days_between_orders")
    )


def _days_between(start: str, end: str) -> str:
    return f"DATEDIFF(CAST({end} AS DATE), CAST({start} AS DATE))"


def review_totals(order_reviews: DataFrame, negative_score: int = NEGATIVE_SCORE) -> DataFrame:
    """Scores summed per order; an order may have several reviews."""
    return order_reviews.groupBy("order_id").agg(
        F.expr("SUM(review_score) AS score_sum"),
        F.expr("COUNT(review_score) AS score_count"),
        F.expr(f"COUNT_IF(review_score <= {negative_score}) AS negative_count"),
    )


_SATISFACTION = [
    f"{ratio('score_sum', 'score_count', 2)} AS avg_review_score",
    f"{percentage('negative_count', 'score_count', 1)} AS pct_negative_reviews",
]


def features_satisfaction(
    customers: DataFrame, orders: DataFrame, order_reviews: DataFrame, negative_score: int = NEGATIVE_SCORE
) -> DataFrame:
    """Mean score and share of negative scores, over delivered orders with or without items."""
    return (
        delivered_orders(customers, orders)
        .join(review_totals(order_reviews, negative_score), "order_id", "left")
        .groupBy(_CUSTOMER)
        .agg(*_review_sums())
        .selectExpr(_CUSTOMER, *_SATISFACTION)
    )


def _review_sums() -> list[Column]:
    return [F.expr(f"SUM({name}) AS {name}") for name in ("score_sum", "score_count", "negative_count")]


def features_diversity(
    customers: DataFrame, orders: DataFrame, order_items: DataFrame, products: DataFrame,
    bits: CategoryBits | None = None,
) -> DataFrame:
    """Distinct product categories bought, for people with an item whose product is known."""
    bits = bits or CategoryBits.of(products)
    if bits is None:
        return diversity_by_distinct(customers, orders, order_items, products)
    per_order = bits.on_items(order_items.select("order_id", "product_id"), products).groupBy("order_id").agg(*bits.merged())
    return (
        delivered_orders(customers, orders)
        .join(per_order, "order_id")
        .groupBy(_CUSTOMER)
        .agg(*bits.merged())
        .selectExpr(_CUSTOMER, f"{bits.count} AS category_diversity")
        .where("category_diversity IS NOT NULL")
    )


def diversity_by_distinct(
    customers: DataFrame, orders: DataFrame, order_items: DataFrame, products: DataFrame
) -> DataFrame:
    """The same count without bitmaps, for more categories than those can hold.

    Products, then categories are made distinct per order first: an order with very
    many items then reaches each join as a few rows. Its items would compress so well that
    adaptive execution, which goes by bytes, might not see it as skewed. The
    rows of one product or account differ in the order id, so there it does.
    The count is spread over (person, category) before it is reduced to the person.
    """
    items = order_items.select("order_id", "product_id").distinct()
    bought = items.join(products, "product_id").select("order_id", "product_category_name").distinct()
    return (
        delivered_orders(customers, orders)
        .join(bought, "order_id")
        .groupBy(_CUSTOMER)
        .agg(F.expr("COUNT(DISTINCT product_category_name) AS category_diversity"))
    )


def order_totals(order_items: DataFrame, products: DataFrame, bits: CategoryBits | None) -> DataFrame:
    """Cents, number of items and, if given, category bits of each order, in one pass over the items.

    The sums ride along with the bits, so the items meet the products once and leave
    each map task as one row per order.
    """
    amount = f"CAST(price AS {_MONEY}) + CAST(freight_value AS {_MONEY})"
    items = order_items.selectExpr("order_id", "order_item_id", "product_id", f"{cents(amount)} AS item_cents")
    sums = [F.expr("SUM(item_cents) AS order_cents"), F.expr("COUNT(order_item_id) AS item_count")]
    if bits is None:
        return items.groupBy("order_id").agg(*sums)
    return bits.on_items(items, products).groupBy("order_id").agg(*sums, *bits.merged())


_WITH_ITEMS = "FILTER (WHERE item_count IS NOT NULL)"

#: Columns of a state besides the person and the category bits, and how two of them merge.
STATE = {
    "frequency": "SUM(frequency)",
    "cents": "SUM(cents)",
    "first_order": "MIN(first_order)",
    "last_order": "MAX(last_order)",
    "score_sum": "SUM(score_sum)",
    "score_count": "SUM(score_count)",
    "negative_count": "SUM(negative_count)",
}


def person_state(
    customers: DataFrame,
    orders: DataFrame,
    order_items: DataFrame,
    order_reviews: DataFrame,
    products: DataFrame,
    negative_score: int = NEGATIVE_SCORE,
    bits: CategoryBits | None = None,
) -> DataFrame:
    """What the features of each person need, with or without orders that hold items.

    Items and reviews are reduced to one row per order before they meet the
    orders, and the three share one partitioning on the order. The first and the last
    order are structs of moment, id and cents, so that a plain minimum and maximum find them.
    """
    per_order = (
        delivered_orders(customers, orders)
        .join(order_totals(order_items, products, bits), "order_id", "left")
        .join(review_totals(order_reviews, negative_score), "order_id", "left")
    )
    order = "STRUCT({0} AS at, order_id AS id, order_cents AS cents)".format(_STAMP)
    return per_order.groupBy(_CUSTOMER).agg(
        F.expr("COUNT(item_count) AS frequency"),
        F.expr("SUM(order_cents) AS cents"),
        F.expr(f"MIN({order}) {_WITH_ITEMS} AS first_order"),
        F.expr(f"MAX({order}) {_WITH_ITEMS} AS last_order"),
        *_review_sums(),
        *(bits.merged() if bits else ()),
    )


def merged_states(states: DataFrame, bits: CategoryBits) -> DataFrame:
    """One state per person of several over different orders."""
    return states.groupBy(_CUSTOMER).agg(
        *(F.expr(f"{merge} AS {name}") for name, merge in STATE.items()), *bits.merged())


def features_of_state(state: DataFrame, diversity: str, as_of: dt.date = AS_OF) -> DataFrame:
    """The nine features; ``diversity`` is the expression for the last one."""
    return state.where("frequency > 0").selectExpr(
        _CUSTOMER,
        f"{_recency(as_of, 'last_order.at')} AS recency_days",
        "frequency",
        f"{from_units('cents', 2)} AS total_spent",
        f"{ratio('cents', 'frequency', 2, scale=2)} AS avg_basket",
        f"{ratio('last_order.cents - first_order.cents', 'frequency - 1', 2, scale=2)} AS basket_trend",
        f"{ratio(_days_between('first_order.at', 'last_order.at'), 'frequency - 1', 1)} AS avg_days_between_orders",
        *_SATISFACTION,
        f"{diversity} AS category_diversity",
    )


def customer_features(
    customers: DataFrame,
    orders: DataFrame,
    order_items: DataFrame,
    order_reviews: DataFrame,
    products: DataFrame,
    as_of: dt.date = AS_OF,
    negative_score: int = NEGATIVE_SCORE,
) -> DataFrame:
    """All nine features; equals the left join of the separate feature tables.

    The categories are numbered when this is called. With more of them than bitmaps
    hold, they are counted apart and joined on the person.
    """
    bits = CategoryBits.of(products)
    state = person_state(customers, orders, order_items, order_reviews, products, negative_score, bits)
    if bits is not None:
        return features_of_state(state, bits.count, as_of)
    diversity = diversity_by_distinct(customers, orders, order_items, products)
    return features_of_state(state.join(diversity, _CUSTOMER, "left"), "category_diversity", as_of)


def top_customers(features: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` customers who spent most."""
    return features.orderBy(F.desc("total_spent"), F.asc(_CUSTOMER)).limit(n)


def preview(features: DataFrame, n: int = 10) -> DataFrame:
    """``n`` rows, those of the smallest ids."""
    return features.orderBy(_CUSTOMER).limit(n)


def features_summary(features: DataFrame) -> DataFrame:
    """Clients, repeat clients, mean recency and mean spend."""
    return features.selectExpr(
        "COUNT(*) AS nb_clients",
        "COUNT_IF(frequency > 1) AS clients_recurrents",
        f"{ratio('SUM(recency_days)', 'COUNT(recency_days)', 1)} AS recency_moyenne",
        f"{ratio(cents('SUM(total_spent)'), 'COUNT(total_spent)', 2, scale=2)} AS depense_moyenne",
    )
