"""DuckDB SQL for the registered queries, over the given parquet tables.

Written apart from the library: successive orders are compared with windows
instead of first and last values, and means are taken as whole-number division,
because DuckDB's own ``avg`` and ``round`` go through doubles.
"""

from __future__ import annotations

from buyerlens.sources.schemas import TABLES

AS_OF = "DATE '2001-08-01'"


def half_up(numerator: str, denominator: str, digits: int) -> str:
    """numerator·10^-digits / denominator, rounded half away from zero, as DOUBLE."""
    n, d = f"CAST({numerator} AS HUGEINT)", f"({denominator})"
    return f"CAST(sign({n}) * ((2 * abs({n}) + {d}) // nullif(2 * {d}, 0)) AS DOUBLE) / {10 ** digits}"


def money(column: str) -> str:
    return f"CAST({column} AS DECIMAL(10, 2))"


# The stand-in tables, one SELECT each.
STANDIN = {
    "customers": """
        SELECT c_custkey AS customer_id, c_custkey AS customer_unique_id,
               lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
               c_mktsegment AS customer_city, n_name AS customer_state
        FROM customer JOIN nation ON n_nationkey = c_nationkey""",
    "sellers": """
        SELECT s_suppkey AS seller_id,
               lpad(CAST(s_suppkey % 100000 AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
               s_name AS seller_city, n_name AS seller_state
        FROM supplier JOIN nation ON n_nationkey = s_nationkey""",
    "products": """
        SELECT p_partkey AS product_id, nullif(p_type, 'ECONOMY') AS product_category_name,
               length(p_name) AS product_name_lenght, length(p_brand) AS product_description_lenght,
               CAST(1 AS BIGINT) AS product_photos_qty, CAST(p_size * 100 AS BIGINT) AS product_weight_g,
               CAST(p_size AS BIGINT) AS product_length_cm, CAST(p_size AS BIGINT) AS product_height_cm,
               CAST(p_size AS BIGINT) AS product_width_cm
        FROM part""",
    "product_category_translation": """
        SELECT DISTINCT p_type AS product_category_name, lower(p_type) AS product_category_name_english
        FROM part""",
    "orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               CASE WHEN o_orderstatus = 'F' THEN 'delivered' ELSE o_orderstatus END AS order_status,
               o_orderdate AS order_purchase_timestamp,
               o_orderdate + INTERVAL 1 DAY AS order_approved_at,
               CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate + INTERVAL 2 DAY END AS order_delivered_carrier_date,
               CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate + INTERVAL 9 DAY END AS order_delivered_customer_date,
               o_orderdate + INTERVAL 20 DAY AS order_estimated_delivery_date
        FROM orders""",
    "order_items": f"""
        SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS order_item_id, l_partkey AS product_id,
               l_suppkey AS seller_id, l_shipdate AS shipping_limit_date,
               {money('l_extendedprice')} AS price, {money('l_quantity')} AS freight_value
        FROM lineitem""",
    "order_payments": f"""
        SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS payment_sequential,
               l_returnflag AS payment_type, CAST(1 AS BIGINT) AS payment_installments,
               {money('l_discount')} AS payment_value
        FROM lineitem""",
    "order_reviews": """
        SELECT l_orderkey || '-' || l_linenumber AS review_id, l_orderkey AS order_id,
               CAST(l_linenumber % 5 + 1 AS BIGINT) AS review_score,
               l_returnflag AS review_comment_title, CAST(NULL AS VARCHAR) AS review_comment_message,
               l_shipdate AS review_creation_date, l_shipdate + INTERVAL 1 DAY AS review_answer_timestamp
        FROM lineitem""",
}


def shop(name: str) -> str:
    """A stand-in table as a FROM item."""
    return f"({STANDIN[name]}) AS shop_{name}"


def union_all(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def loaded(name: str, renamed: dict[str, str] | None = None) -> str:
    """A stand-in table as the CSV loader returns it: ids as text, money as double."""
    def column(field) -> str:
        kind = field.dataType.simpleString()
        source = (renamed or {}).get(field.name, field.name)
        if kind == "string":
            return f"CAST({source} AS VARCHAR) AS {field.name}"
        if kind.startswith("decimal"):
            return f"CAST({source} AS DOUBLE) AS {field.name}"
        return f"{source} AS {field.name}"

    return f"SELECT {', '.join(column(f) for f in TABLES[name].schema)} FROM {shop(name)}"


def features(person: str = "c_custkey") -> str:
    """WITH clauses up to ``features``; ``units`` holds the same row in whole numbers."""
    return f"""
WITH people AS (
    SELECT c_custkey, {person} AS customer_unique_id, n_name AS state
    FROM customer JOIN nation ON n_nationkey = c_nationkey
),
done AS (
    SELECT customer_unique_id, o_orderkey AS order_id, o_orderdate AS bought_at
    FROM orders JOIN people ON c_custkey = o_custkey
    WHERE o_orderstatus = 'F'
),
basket AS (
    SELECT l_orderkey AS order_id, count(*) AS item_count,
           CAST(100 * sum({money('l_extendedprice')} + {money('l_quantity')}) AS HUGEINT) AS cents
    FROM lineitem GROUP BY l_orderkey
),
history AS (
    SELECT customer_unique_id, order_id, bought_at, cents, item_count,
           row_number() OVER steps AS order_number,
           lag(cents) OVER steps AS cents_before,
           lag(bought_at) OVER steps AS bought_before
    FROM done JOIN basket USING (order_id)
    WINDOW steps AS (PARTITION BY customer_unique_id ORDER BY bought_at, order_id)
),
buying AS (
    SELECT customer_unique_id,
           date_diff('day', CAST(max(bought_at) AS DATE), {AS_OF}) AS recency_days,
           count(*) AS frequency,
           sum(cents) AS spent,
           count(cents_before) AS step_count,
           sum(cents - cents_before) AS change,
           sum(date_diff('day', CAST(bought_before AS DATE), CAST(bought_at AS DATE))) AS days
    FROM history GROUP BY customer_unique_id
),
opinion AS (
    SELECT customer_unique_id, sum(score) AS score_sum, count(score) AS score_count,
           count(*) FILTER (WHERE score <= 2) AS negatives
    FROM done LEFT JOIN (
        SELECT DISTINCT l_orderkey AS order_id, l_linenumber, CAST(l_linenumber % 5 + 1 AS INTEGER) AS score FROM lineitem
    ) AS scores USING (order_id)
    GROUP BY customer_unique_id
),
variety AS (
    SELECT customer_unique_id, count(DISTINCT p_type) AS category_diversity
    FROM done JOIN lineitem ON l_orderkey = order_id JOIN part ON p_partkey = l_partkey
    GROUP BY customer_unique_id
),
features AS (
    SELECT customer_unique_id, recency_days, frequency,
           CAST(spent AS DOUBLE) / 100 AS total_spent,
           {half_up('spent', 'frequency', 2)} AS avg_basket,
           {half_up('change', 'step_count', 2)} AS basket_trend,
           {half_up('10 * days', 'step_count', 1)} AS avg_days_between_orders,
           {half_up('100 * score_sum', 'score_count', 2)} AS avg_review_score,
           {half_up('1000 * negatives', 'score_count', 1)} AS pct_negative_reviews,
           category_diversity
    FROM buying LEFT JOIN opinion USING (customer_unique_id) LEFT JOIN variety USING (customer_unique_id)
),
units AS (
    SELECT *, CAST(round(total_spent * 100) AS HUGEINT) AS spent,
           CAST(round(avg_basket * 100) AS HUGEINT) AS basket,
           CAST(round(avg_review_score * 100) AS HUGEINT) AS score,
           CAST(round(pct_negative_reviews * 10) AS HUGEINT) AS negative
    FROM features
)
"""


FEATURES = features()
ALL_FEATURES = f"{FEATURES} SELECT * FROM features"
AT_RISK = "recency_days > 180 AND spent > 100 * 1000000"

TOP_AT_RISK = f"""{FEATURES}
    SELECT customer_unique_id, recency_days, frequency, total_spent, avg_review_score, pct_negative_reviews
    FROM units WHERE {AT_RISK} ORDER BY spent DESC, customer_unique_id LIMIT 20"""

BY_STATE = f"""{features('c_custkey // 3')},
by_state AS (
    SELECT state, count(DISTINCT customer_unique_id) AS nb_clients,
           {half_up('sum(spent)', 'count(*)', 2)} AS panier_moyen
    FROM units JOIN people USING (customer_unique_id)
    GROUP BY state
)
"""

REVIEW_VERSIONS = """
    SELECT l_orderkey || '-' || l_linenumber AS review_id,
           CAST(l_orderkey AS VARCHAR) AS order_id,
           CAST(l_linenumber % 5 + 1 AS BIGINT) AS review_score,
           'He said "ok", ' || l_returnflag || chr(10) || 'and left' AS review_comment_title,
           CASE l_suppkey % 3 WHEN 0 THEN l_linestatus WHEN 1 THEN '' END AS review_comment_message,
           l_shipdate AS review_creation_date,
           l_shipdate + INTERVAL 1 DAY AS review_answer_timestamp
    FROM lineitem"""


def _row_counts() -> str:
    return union_all([
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {shop(name)}" for name in STANDIN
    ])


# Deliveries that break rules, as the registered checks get them.
DAMAGED = {
    "customers": f"""
        SELECT * REPLACE (CASE WHEN customer_id % 17 <> 0 THEN customer_city END AS customer_city)
        FROM ({STANDIN['customers']}) AS c, (VALUES (1), (2)) AS copies(copy)
        WHERE customer_id % 11 <> 0 AND (copy = 1 OR customer_id % 10 = 3)""",
    "sellers": f"""
        SELECT * REPLACE (CASE WHEN seller_id % 7 <> 0 THEN seller_id END AS seller_id)
        FROM ({STANDIN['sellers']}) AS s WHERE seller_id % 5 <> 0""",
    "products": f"SELECT * FROM ({STANDIN['products']}) AS p WHERE product_id % 13 <> 0",
    "product_category_translation": STANDIN["product_category_translation"],
    "orders": f"""
        SELECT * REPLACE (CASE WHEN order_id % 23 = 0 THEN 'a status of 21 signs.' ELSE order_status END AS order_status)
        FROM ({STANDIN['orders']}) AS o WHERE order_id % 19 <> 0""",
    "order_items": f"""
        SELECT * REPLACE (CASE WHEN order_item_id = 7 THEN -price ELSE price END AS price,
                          CASE WHEN product_id % 50 = 0 THEN -freight_value ELSE freight_value END AS freight_value,
                          CASE WHEN product_id % 60 <> 0 THEN product_id END AS product_id)
        FROM ({STANDIN['order_items']}) AS i""",
    "order_payments": f"""
        SELECT * REPLACE (CASE WHEN payment_sequential <> 6 THEN payment_sequential // 2 END AS payment_sequential)
        FROM ({STANDIN['order_payments']}) AS p""",
    "order_reviews": f"""
        SELECT * REPLACE (review_score * 2 - 4 AS review_score,
                          CASE WHEN order_id % 29 <> 0 THEN review_creation_date END AS review_creation_date)
        FROM ({STANDIN['order_reviews']}) AS r""",
}

# The declared keys, references, required columns, length limits and value rules.
PRIMARY_KEYS = {
    "customers": ["customer_id"],
    "sellers": ["seller_id"],
    "products": ["product_id"],
    "product_category_translation": ["product_category_name"],
    "orders": ["order_id"],
    "order_items": ["order_id", "order_item_id"],
    "order_payments": ["order_id", "payment_sequential"],
    "order_reviews": ["review_id"],
}
FOREIGN_KEYS = [
    ("orders", "customer_id", "customers"),
    ("order_items", "order_id", "orders"),
    ("order_items", "product_id", "products"),
    ("order_items", "seller_id", "sellers"),
    ("order_payments", "order_id", "orders"),
    ("order_reviews", "order_id", "orders"),
]
NOT_NULL = {
    "customers": ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"],
    "sellers": ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
    "products": ["product_id"],
    "product_category_translation": ["product_category_name", "product_category_name_english"],
    "orders": ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_estimated_delivery_date"],
    "order_items": ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value"],
    "order_payments": ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"],
    "order_reviews": ["review_id", "order_id", "review_score", "review_creation_date", "review_answer_timestamp"],
}
LENGTHS = {
    "customers": {"customer_id": 32, "customer_unique_id": 32, "customer_zip_code_prefix": 5, "customer_city": 100, "customer_state": 2},
    "sellers": {"seller_id": 32, "seller_zip_code_prefix": 5, "seller_city": 100, "seller_state": 2},
    "products": {"product_id": 32, "product_category_name": 100},
    "product_category_translation": {"product_category_name": 100, "product_category_name_english": 100},
    "orders": {"order_id": 32, "customer_id": 32, "order_status": 20},
    "order_items": {"order_id": 32, "product_id": 32, "seller_id": 32},
    "order_payments": {"order_id": 32, "payment_type": 20},
    "order_reviews": {"review_id": 32, "order_id": 32},
}
CHECKS = {
    "order_items": {"price_not_negative": "price >= 0", "freight_not_negative": "freight_value >= 0"},
    "order_reviews": {"score_in_range": "review_score BETWEEN 1 AND 5"},
}


def damaged(name: str) -> str:
    return f"({DAMAGED[name]}) AS damaged_{name}"


def _key_violations() -> str:
    def one(name: str, keys: list[str]) -> str:
        missing = " OR ".join(f"{k} IS NULL" for k in keys)
        return f"""
            SELECT '{name}' AS table_name, '{', '.join(keys)}' AS key_columns,
                   count(*) FILTER (WHERE n > 1 AND NOT missing) AS duplicate_keys,
                   CAST(coalesce(sum(n - 1) FILTER (WHERE NOT missing), 0) AS BIGINT) AS surplus_rows,
                   CAST(coalesce(sum(n) FILTER (WHERE missing), 0) AS BIGINT) AS null_key_rows
            FROM (SELECT ({missing}) AS missing, count(*) AS n FROM {damaged(name)} GROUP BY {', '.join(keys)}, 1)"""

    return union_all([one(name, keys) for name, keys in PRIMARY_KEYS.items()])


def _orphans() -> str:
    return union_all([
        f"""
            SELECT '{name}' AS table_name, '{column}' AS column_name, '{parent}' AS parent_table,
                   count(DISTINCT {column}) AS orphan_keys, count(*) AS orphan_rows
            FROM {damaged(name)}
            WHERE {column} IS NOT NULL
              AND {column} NOT IN (SELECT {column} FROM {damaged(parent)} WHERE {column} IS NOT NULL)"""
        for name, column, parent in FOREIGN_KEYS
    ])


def _key_report() -> str:
    return f"""
        SELECT table_name, 'key ' || key_columns AS rule, surplus_rows + null_key_rows AS violations FROM ({_key_violations()})
        UNION ALL SELECT table_name, column_name || ' -> ' || parent_table, orphan_rows FROM ({_orphans()})"""


def _row_rules(name: str) -> list[tuple[str, str, str]]:
    """Column, rule, and the condition under which a row breaks it."""
    rules = [(c, "not null", f"{c} IS NULL") for c in NOT_NULL[name]]
    rules += [(c, f"length <= {n}", f"length(rtrim(CAST({c} AS VARCHAR), ' ')) > {n}") for c, n in LENGTHS[name].items()]
    return rules + [(c, rule, f"NOT ({rule})") for c, rule in CHECKS.get(name, {}).items()]


def _violations(values: bool) -> str:
    label = "check_name" if values else "column_name"
    return union_all([
        f"SELECT '{name}' AS table_name, '{column}' AS {label}, '{rule}' AS rule, "
        f"count(*) FILTER (WHERE {broken}) AS violations FROM {damaged(name)}"
        for name in DAMAGED for column, rule, broken in _row_rules(name)
        if (column in CHECKS.get(name, {})) == values
    ])


def _set_aside() -> str:
    def one(name: str) -> str:
        key = " || '/' || ".join(f"coalesce(CAST({k} AS VARCHAR), '?')" for k in PRIMARY_KEYS[name])
        names = ", ".join(f"CASE WHEN {broken} THEN '{c}: {rule}' END" for c, rule, broken in _row_rules(name))
        return f"SELECT '{name}' AS table_name, {key} AS row_key, concat_ws('; ', {names}) AS broken_rules FROM {damaged(name)}"

    return f"SELECT * FROM ({union_all([one(name) for name in DAMAGED])}) WHERE broken_rules <> ''"


def _kept_by_quarantine() -> str:
    return union_all([
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {damaged(name)} "
        f"WHERE NOT coalesce({' OR '.join(f'({broken})' for *_, broken in _row_rules(name))}, FALSE)"
        for name in DAMAGED
    ])


def _latest(rows: str, keys: str, order: str) -> str:
    return f"""
        SELECT * EXCLUDE (place) FROM (
            SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS place FROM ({rows}) AS versions
        ) WHERE place = 1"""


# The added translations, the totals of the summary, and the recency buckets with their days.
TRANSLATIONS = [
    ("portateis_cozinha_e_preparadores_de_alimentos", "portable_kitchen_food_processors"),
    ("pc_gamer", "pc_gamer"),
    ("sem_categoria", "no_category"),
]
TOTALS = {
    "total_customers": "customer",
    "total_orders": "orders",
    "total_order_items": "lineitem",
    "total_reviews": "(SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)",
    "total_products": "part",
    "delivered_orders": "orders WHERE o_orderstatus = 'F'",
}
RECENCY = [
    ("0-30j", -1_000_000, 30),
    ("31-90j", 31, 90),
    ("91-180j", 91, 180),
    ("181-365j", 181, 365),
    ("> 365j", 366, 1_000_000),
]


ORACLES: dict[str, str] = {
    "row_counts": _row_counts(),
    "pk_violations": _key_violations(),
    "fk_orphans": _orphans(),
    "key_report": _key_report(),
    "null_and_length_violations": _violations(values=False),
    "check_violations": _violations(values=True),
    "quarantined_rows": _set_aside(),
    "quarantine_row_counts": _kept_by_quarantine(),
    "duplicate_count": f"""
        SELECT 'reviews_doublons_restants' AS check_name, count(*) - count(DISTINCT review_id) AS duplicates
        FROM ({REVIEW_VERSIONS}) AS versions""",
    "dedup_latest": _latest(
        f"""SELECT * REPLACE (CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value)
            FROM {shop('order_items')}""",
        "order_id, order_item_id",
        "shipping_limit_date DESC, product_id, seller_id, price, freight_value",
    ),
    "impute_delivery_date": f"""
        SELECT * REPLACE (
            CASE WHEN order_status = 'delivered'
                 THEN coalesce(order_delivered_customer_date,
                               order_delivered_carrier_date + INTERVAL 7 DAY,
                               order_purchase_timestamp + INTERVAL 14 DAY)
                 ELSE order_delivered_customer_date END AS order_delivered_customer_date)
        FROM {shop('orders')}""",
    "delivered_without_date": """
        SELECT 'delivered_sans_date' AS check_name, count(*) AS remaining
        FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 3 = 0""",
    "fill_category": f"""
        SELECT * REPLACE (coalesce(product_category_name, 'sem_categoria') AS product_category_name)
        FROM {shop('products')}""",
    "products_without_category": """
        SELECT 'produits_sans_categorie' AS check_name, count(*) AS remaining FROM part WHERE p_type = 'ECONOMY'""",
    "insert_missing_translations": f"""
        WITH existing AS (
            SELECT * FROM ({STANDIN['product_category_translation']}) AS t
            WHERE product_category_name NOT IN ('LARGE', 'PROMO')
        ),
        offered AS (
            SELECT * FROM (VALUES {', '.join(map(str, TRANSLATIONS))}) AS fixed(product_category_name, product_category_name_english)
            UNION
            SELECT p_type, upper(p_type[1]) || lower(p_type[2:]) FROM part WHERE p_type <> 'ECONOMY'
        )
        SELECT * FROM existing
        UNION ALL
        SELECT * FROM offered WHERE product_category_name NOT IN (SELECT product_category_name FROM existing)""",
    "untranslated_categories": """
        SELECT 'categories_sans_traduction' AS check_name, count(DISTINCT p_type) AS missing
        FROM part WHERE p_type IN ('LARGE', 'PROMO')""",
    "zero_value_report": f"""
        SELECT payment_type, order_status, count(*) AS payments
        FROM {shop('order_payments')} JOIN {shop('orders')} USING (order_id)
        WHERE payment_value = 0 GROUP BY payment_type, order_status""",
    "cleaning_summary": union_all([
        f"SELECT '{metric}' AS metric, CAST(count(*) AS VARCHAR) AS value FROM {source}" for metric, source in TOTALS.items()
    ]),
    "strip_bom": "SELECT p_partkey AS product_id, p_name AS product_name FROM part",
    "order_amounts": f"""{FEATURES}
        SELECT customer_unique_id, order_id, bought_at AS order_purchase_timestamp,
               CAST(cents AS DOUBLE) / 100 AS order_amount, item_count
        FROM history""",
    "order_sequence": f"""{FEATURES}
        SELECT customer_unique_id, order_id, bought_at AS order_purchase_timestamp,
               CAST(cents AS DOUBLE) / 100 AS order_amount, item_count, order_number,
               CAST(cents_before AS DOUBLE) / 100 AS previous_amount, bought_before AS previous_purchase
        FROM history""",
    "features_rfm": f"{FEATURES} SELECT customer_unique_id, recency_days, frequency, total_spent, avg_basket FROM features",
    "features_trend": f"""{FEATURES}
        SELECT customer_unique_id, basket_trend FROM features WHERE basket_trend IS NOT NULL""",
    "features_gap": f"""{FEATURES}
        SELECT customer_unique_id, avg_days_between_orders FROM features WHERE avg_days_between_orders IS NOT NULL""",
    "features_satisfaction": f"""{FEATURES}
        SELECT customer_unique_id,
               {half_up('100 * score_sum', 'score_count', 2)} AS avg_review_score,
               {half_up('1000 * negatives', 'score_count', 1)} AS pct_negative_reviews
        FROM opinion""",
    "features_diversity": f"{FEATURES} SELECT customer_unique_id, category_diversity FROM variety",
    "customer_features": ALL_FEATURES,
    "features_view": ALL_FEATURES,
    "materialized_read": ALL_FEATURES,
    "features_refresh": ALL_FEATURES,
    "features_refresh_differential": ALL_FEATURES,
    "customer_lookup": f"{ALL_FEATURES} WHERE customer_unique_id = (SELECT max(customer_unique_id) FROM features)",
    "features_preview": f"{ALL_FEATURES} ORDER BY customer_unique_id LIMIT 10",
    "top_customers": f"{FEATURES} SELECT * FROM features ORDER BY total_spent DESC, customer_unique_id LIMIT 20",
    "features_summary": f"""{FEATURES}
        SELECT count(*) AS nb_clients, count(*) FILTER (WHERE frequency > 1) AS clients_recurrents,
               {half_up('10 * sum(recency_days)', 'count(*)', 1)} AS recency_moyenne,
               {half_up('sum(spent)', 'count(*)', 2)} AS depense_moyenne
        FROM units""",
    "kpis": f"""{FEATURES}
        SELECT count(*) AS nb_clients, count(*) FILTER (WHERE frequency > 1) AS nb_recurrents,
               {half_up('1000 * count(*) FILTER (WHERE frequency > 1)', 'count(*)', 1)} AS pct_recurrents,
               CAST((sum(spent) + 50) // 100 AS DOUBLE) AS revenue_total,
               {half_up('sum(score)', 'count(score)', 2)} AS score_moyen
        FROM units""",
    "recency_buckets": f"""{FEATURES}
        SELECT bucket, count(*) AS nb_clients
        FROM features JOIN (VALUES {', '.join(map(str, RECENCY))}) AS edges(bucket, low, high)
            ON recency_days BETWEEN low AND high
        GROUP BY bucket""",
    "frequency_buckets": f"""{FEATURES}
        SELECT CASE WHEN frequency < 5 THEN CAST(frequency AS VARCHAR) ELSE '5+' END AS freq,
               count(*) AS nb_clients
        FROM features GROUP BY 1""",
    "basket_histogram": f"""{FEATURES}
        SELECT CAST(basket // 1000000 * 10000 AS DOUBLE) AS bin_start, count(*) AS nb_clients
        FROM units WHERE basket < 25000000 GROUP BY 1
        UNION ALL SELECT CAST(250000 AS DOUBLE), count(*) FROM units WHERE basket >= 25000000 HAVING count(*) > 0""",
    "basket_histogram_capped": f"""{FEATURES}
        SELECT CAST(basket // 1000000 * 10000 AS DOUBLE) AS bin_start, count(*) AS nb_clients
        FROM units WHERE basket < 25000000 GROUP BY 1""",
    "score_distribution": f"""{FEATURES}
        SELECT CAST((score + 50) // 100 AS BIGINT) AS note, count(*) AS nb_clients
        FROM units WHERE score IS NOT NULL GROUP BY 1""",
    "negative_pct_histogram": f"""{FEATURES}
        SELECT CAST(negative // 50 * 5 AS DOUBLE) AS bin_start, count(*) AS nb_clients
        FROM units WHERE negative IS NOT NULL GROUP BY 1""",
    "risk_kpis": f"""{FEATURES},
        groups AS (
            SELECT count(*) AS clients, count(*) FILTER (WHERE {AT_RISK}) AS risky,
                   (sum(spent) FILTER (WHERE {AT_RISK}) + 50) // 100 AS lost,
                   (sum(spent) + 50) // 100 AS total,
                   sum(recency_days) FILTER (WHERE {AT_RISK}) AS days
            FROM units
        )
        SELECT risky AS nb_a_risque, CAST(lost AS DOUBLE) AS revenue_perdu,
               {half_up('days', 'risky', 0)} AS recence_moyenne,
               CAST(total AS DOUBLE) AS revenue_total_global,
               {half_up('1000 * risky', 'clients', 1)} AS pct_clients,
               {half_up('100 * lost', 'total', 0)} AS pct_revenue
        FROM groups""",
    "top_at_risk": TOP_AT_RISK,
    "top_at_risk_headings": f"""
        SELECT customer_unique_id AS "ID client", recency_days AS "Recence (j)", frequency AS "Commandes",
               total_spent AS "Depense totale (R$)", avg_review_score AS "Note moyenne",
               pct_negative_reviews AS "% reviews neg"
        FROM ({TOP_AT_RISK}) AS top""",
    "geo_all_states": f"{BY_STATE} SELECT * FROM by_state",
    "geo_by_state": f"{BY_STATE} SELECT * FROM by_state ORDER BY nb_clients DESC, state LIMIT 10",
    "geo_by_spend": f"""{BY_STATE}
        SELECT * FROM (SELECT * FROM by_state ORDER BY nb_clients DESC, state LIMIT 10)
        ORDER BY panier_moyen DESC, state""",
    "load_customers": loaded("customers"),
    "load_sellers": loaded("sellers"),
    "load_products": loaded("products"),
    "load_category_translation": loaded("product_category_translation"),
    "load_orders": loaded("orders"),
    "load_order_items": loaded("order_items"),
    "load_order_payments": loaded("order_payments"),
    "load_order_reviews": _latest(
        REVIEW_VERSIONS,
        "review_id",
        "review_creation_date DESC, review_answer_timestamp DESC, order_id, review_score, "
        "review_comment_title, review_comment_message NULLS LAST",
    ),
}

# Reports from the roll-up have to equal those from the features.
ORACLES.update({
    f"rollup_{name}": ORACLES[name]
    for name in (
        "kpis", "features_summary", "risk_kpis", "recency_buckets", "frequency_buckets", "score_distribution",
        "basket_histogram", "basket_histogram_capped", "negative_pct_histogram",
    )
})
