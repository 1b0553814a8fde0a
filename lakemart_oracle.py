"""ANSI SQL for DuckDB, one statement per query, written apart from the Spark code.

``_CTE`` holds the tables as common table expressions; ``_sql`` puts the ones a statement needs in
front of it. Averages and quotients are computed on whole numbers, rounded half up, and scaled.
"""

from __future__ import annotations

import re


def _meta(name: str) -> str:
    return (
        "TIMESTAMP '2024-01-01 00:00:00' AS _ingested_at, 'batch-1' AS _batch_id, "
        f"'{name}.csv' AS _source_file, 'csv' AS _source_system"
    )


def _days(column: str, days: str) -> str:
    return f"{column} + to_days(CAST({days} AS INTEGER))"


def _title(column: str) -> str:
    return f"upper(substr(trim({column}), 1, 1)) || lower(substr(trim({column}), 2))"


def _newest(source: str, key: str, *order: str) -> str:
    ranked = ", ".join(f"{column} DESC NULLS LAST" for column in order)
    return f"SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {ranked}) = 1"


def _half_up(numerator: str, denominator: str) -> str:
    return f"((2 * ({numerator}) + ({denominator})) // (2 * ({denominator})))"


def _scaled(whole: str, digits: int, width: int) -> str:
    unit = "0." + "0" * (digits - 1) + "1"
    return (
        f"CAST(CAST({whole} AS DECIMAL(28,0)) * CAST({unit} AS DECIMAL({digits + 1},{digits})) "
        f"AS DECIMAL({width},{digits}))"
    )


def _whole(column: str, digits: int) -> str:
    return f"CAST({column} * {10 ** digits} AS HUGEINT)"


def _daily(orders: str, items: str = "items_per_order") -> str:
    return f"""
        SELECT order_purchase_date AS order_date, count(DISTINCT order_id) AS order_count,
               CAST(sum(coalesce(items, 0)) AS BIGINT) AS item_count,
               CAST(sum(coalesce(value, 0)) AS DECIMAL(32,2)) AS gross_item_value,
               CAST(sum(coalesce(freight, 0)) AS DECIMAL(32,2)) AS gross_freight_value,
               CAST(sum(coalesce(paid, 0)) AS DECIMAL(32,2)) AS payment_value,
               {_scaled(_half_up(_whole('sum(coalesce(paid, 0))', 2) + ' * 10000', 'count(*)'), 6, 26)}
                   AS avg_order_payment_value,
               strftime(order_purchase_date, '%Y-%m-%d') AS gold_key
        FROM {orders} LEFT JOIN {items} USING (order_id) LEFT JOIN paid_per_order USING (order_id)
        GROUP BY order_purchase_date"""


def _fingerprint(*columns: str) -> str:
    parts = " || ".join(f"coalesce(CAST(length({c}) AS VARCHAR) || ':' || {c}, '-')" for c in columns)
    return f"md5({parts})"


_PRICE = "CAST(l_extendedprice AS DECIMAL(12,2))"
_REVIEW = (
    "review_id",
    "order_id",
    "score_text",
    "title_text",
    "review_comment_message",
    "creation_text",
    "answer_text",
)
_PLACE = ("zip", "lat_text", "lng_text", "city", "state")

_CTE = {
    # ---- bronze ----
    "b_orders": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
               lower(trim(o_orderstatus)) AS order_status, o_orderdate AS order_purchase_timestamp,
               {_days('o_orderdate', '1')} AS order_approved_at,
               {_days('o_orderdate', '2')} AS order_delivered_carrier_date,
               CASE WHEN o_orderstatus <> 'O' THEN {_days('o_orderdate', 'o_custkey % 30')} END
                   AS order_delivered_customer_date,
               {_days('o_orderdate', 'o_orderkey % 20')} AS order_estimated_delivery_date,
               CAST(o_orderdate AS DATE) AS dt, {_meta('orders')}
        FROM orders""",
    "b_items": f"""
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_item_id,
               CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
               l_shipdate AS shipping_limit_date, {_PRICE} AS price,
               CAST(round({_PRICE} * CAST(l_tax AS DECIMAL(4,2)), 2) AS DECIMAL(12,2)) AS freight_value,
               CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) AS order_item_key,
               CAST(l_shipdate AS DATE) AS dt, {_meta('order_items')}
        FROM lineitem""",
    "places": """
        SELECT n_nationkey, n_name AS city, lower(substr(r_name, 1, 2)) AS state
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "b_customers": f"""
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_unique_id,
               lpad(CAST(c_custkey % 1000 AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
               {_title('city')} AS customer_city, upper(state) AS customer_state, {_meta('customers')}
        FROM customer LEFT JOIN places ON c_nationkey = n_nationkey""",
    "b_sellers": f"""
        SELECT CAST(s_suppkey AS VARCHAR) AS seller_id,
               lpad(CAST(s_suppkey % 1000 AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
               {_title('city')} AS seller_city, upper(state) AS seller_state, {_meta('sellers')}
        FROM supplier LEFT JOIN places ON s_nationkey = n_nationkey""",
    "parts_paid": """
        SELECT o_orderkey, o_orderpriority, 1 AS payment_sequential,
               CAST(CAST(o_totalprice AS DECIMAL(12,2)) - CASE WHEN o_orderkey % 3 = 0 THEN 100 ELSE 0 END
                    AS DECIMAL(12,2)) AS payment_value
        FROM orders
        UNION ALL
        SELECT o_orderkey, o_orderpriority, 2, CAST(100 AS DECIMAL(12,2)) FROM orders WHERE o_orderkey % 3 = 0""",
    "b_payments": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, payment_sequential,
               lower(trim(o_orderpriority)) AS payment_type,
               CAST(o_orderkey % 7 AS INTEGER) AS payment_installments, payment_value,
               CAST(o_orderkey AS VARCHAR) || '_' || CAST(payment_sequential AS VARCHAR) AS payment_key,
               {_meta('payments')}
        FROM parts_paid""",
    "b_products": f"""
        SELECT CAST(p_partkey AS VARCHAR) AS product_id, lower(trim(p_type)) AS product_category_name,
               CAST(length(p_name) AS INTEGER) AS product_name_lenght,
               CAST(length(p_type) AS INTEGER) AS product_description_lenght,
               nullif(p_size % 5, 0) AS product_photos_qty, p_size * 100 AS product_weight_g,
               p_size AS product_length_cm, p_size AS product_height_cm,
               nullif(p_size % 3, 0) AS product_width_cm, {_meta('products')}
        FROM part""",
    "b_translation": f"""
        SELECT lower(trim(p_type)) AS product_category_name,
               lower(trim(p_type || ' Goods ')) AS product_category_name_english,
               {_meta('product_category_translation')}
        FROM part WHERE p_type <> 'PROMO'""",
    "review_rows": """
        SELECT md5(text) AS review_id, CAST(doc_id AS VARCHAR) AS order_id,
               CAST(1 + 4 * quality AS INTEGER) AS review_score, ' ' || lang AS review_comment_title,
               text AS review_comment_message,
               DATE '2017-01-01' + to_days(CAST(doc_id % 1000 AS INTEGER)) AS review_creation_date,
               DATE '2017-01-01' + to_days(CAST(doc_id % 1000 + n_chars % 10 AS INTEGER)) AS review_answer_timestamp
        FROM documents LEFT JOIN labels USING (doc_id)""",
    "review_texts": """
        SELECT *, CAST(review_score AS VARCHAR) AS score_text, review_comment_title AS title_text,
               CAST(review_creation_date AS VARCHAR) AS creation_text,
               CAST(review_answer_timestamp AS VARCHAR) AS answer_text
        FROM review_rows""",
    "b_reviews": f"""
        SELECT review_id, order_id, review_score, review_comment_title, review_comment_message,
               review_creation_date, review_answer_timestamp,
               review_id || '_' || order_id || '_' || {_fingerprint(*_REVIEW)} || '_' ||
               CAST(row_number() OVER (PARTITION BY {', '.join(_REVIEW)}) AS VARCHAR) AS bronze_record_key,
               {_meta('reviews')}
        FROM review_texts""",
    "place_rows": """
        SELECT lpad(CAST(c_custkey % 1000 AS VARCHAR), 5, '0') AS zip,
               CAST(n_nationkey * 3.0 - 36.0 + 0.25 AS DOUBLE) AS lat,
               CAST(n_nationkey * -1.5 - 0.5 AS DOUBLE) AS lng, city, state
        FROM customer LEFT JOIN places ON c_nationkey = n_nationkey""",
    "place_texts": """
        SELECT *, CAST(lat AS VARCHAR) AS lat_text, CAST(lng AS VARCHAR) AS lng_text FROM place_rows""",
    "b_geolocation": f"""
        SELECT zip AS geolocation_zip_code_prefix, lat AS geolocation_lat, lng AS geolocation_lng,
               {_title('city')} AS geolocation_city, upper(state) AS geolocation_state,
               zip || '_' || lat_text || '_' || lng_text || '_' || {_fingerprint(*_PLACE)} || '_' ||
               CAST(row_number() OVER (PARTITION BY {', '.join(_PLACE)}) AS VARCHAR) AS bronze_record_key,
               zip || '_' || lat_text || '_' || lng_text AS geolocation_key, {_meta('geolocation')}
        FROM place_texts""",
    # ---- silver ----
    "orders_latest": _newest("b_orders", "order_id", "order_purchase_timestamp", "customer_id", "order_status"),
    "s_orders": """
        SELECT *, CAST(order_purchase_timestamp AS DATE) AS order_purchase_date,
               CAST(date_diff('day', CAST(order_estimated_delivery_date AS DATE),
                              CAST(order_delivered_customer_date AS DATE)) AS INTEGER) AS delivery_delay_days
        FROM orders_latest""",
    "s_items": _newest(
        "b_items", "order_item_key", "shipping_limit_date", "product_id", "seller_id", "price", "freight_value"
    ),
    "s_customers": _newest("b_customers", "customer_id", "customer_unique_id"),
    "payments_latest": _newest("b_payments", "payment_key", "payment_type", "payment_installments", "payment_value"),
    "s_payments": """
        SELECT * REPLACE (CASE WHEN payment_installments <= 0 THEN 1 ELSE payment_installments END
                          AS payment_installments)
        FROM payments_latest WHERE payment_value >= 0""",
    "s_products_base": f"""
        SELECT * REPLACE (coalesce(product_photos_qty, 0) AS product_photos_qty,
                          coalesce(product_width_cm, 0) AS product_width_cm)
        FROM ({_newest('b_products', 'product_id', 'product_category_name')})""",
    "s_translation": _newest("b_translation", "product_category_name", "product_category_name_english"),
    "s_products": """
        SELECT b.*, coalesce(t.product_category_name_english, b.product_category_name)
                        AS product_category_name_english
        FROM s_products_base b LEFT JOIN s_translation t USING (product_category_name)""",
    "s_sellers": _newest("b_sellers", "seller_id", "seller_city"),
    "s_reviews": f"""
        SELECT * REPLACE (trim(review_comment_title) AS review_comment_title,
                          trim(review_comment_message) AS review_comment_message)
        FROM ({_newest('b_reviews', 'review_id', 'review_answer_timestamp', 'order_id', 'review_score',
                       'bronze_record_key')})""",
    "s_geolocation": _newest("b_geolocation", "geolocation_key", "bronze_record_key"),
    # ---- gold ----
    "items_per_order": """
        SELECT order_id, count(DISTINCT order_item_key) AS items, sum(price) AS value, sum(freight_value) AS freight
        FROM s_items GROUP BY order_id""",
    "paid_per_order": """
        SELECT order_id, sum(payment_value) AS paid, count(*) AS parts, max(payment_installments) AS installments
        FROM s_payments GROUP BY order_id""",
    "g_daily": _daily("s_orders"),
    # Dates rounded to the year, as in the two loads of the append queries.
    "orders_by_year": """
        SELECT * REPLACE (CAST(date_trunc('year', order_purchase_date) AS DATE) AS order_purchase_date) FROM s_orders""",
    "raw_items_by_year": """
        SELECT * REPLACE (date_trunc('year', shipping_limit_date) AS shipping_limit_date) FROM b_items""",
    "newest_items_by_year": _newest(
        "raw_items_by_year", "order_item_key", "shipping_limit_date", "product_id", "seller_id", "price", "freight_value"
    ),
    "items_by_year": """
        SELECT order_id, count(*) AS items, sum(price) AS value, sum(freight_value) AS freight
        FROM newest_items_by_year GROUP BY order_id""",
    "categories": """
        SELECT product_id,
               coalesce(product_category_name_english, product_category_name, 'unknown') AS category_name
        FROM s_products""",
    "g_category": """
        SELECT order_purchase_date, coalesce(category_name, 'unknown') AS category_name,
               count(DISTINCT order_id) AS order_count, count(DISTINCT order_item_key) AS item_count,
               CAST(sum(price) AS DECIMAL(22,2)) AS gross_item_value,
               CAST(sum(freight_value) AS DECIMAL(22,2)) AS gross_freight_value,
               concat_ws('_', strftime(order_purchase_date, '%Y-%m-%d'), coalesce(category_name, 'unknown'))
                   AS gold_key
        FROM s_items LEFT JOIN categories USING (product_id)
             LEFT JOIN (SELECT order_id, order_purchase_date FROM s_orders) USING (order_id)
        GROUP BY 1, 2""",
    "values_per_customer": """
        SELECT customer_id, customer_unique_id, customer_city, customer_state,
               count(DISTINCT order_id) AS order_count,
               CAST(sum(coalesce(paid, 0)) AS DECIMAL(32,2)) AS lifetime_value,
               min(order_purchase_date) AS first_order_date, max(order_purchase_date) AS last_order_date
        FROM s_orders
             LEFT JOIN (SELECT customer_id, customer_unique_id, customer_city, customer_state FROM s_customers)
                 USING (customer_id)
             LEFT JOIN paid_per_order USING (order_id)
        GROUP BY 1, 2, 3, 4""",
    "g_ltv": f"""
        SELECT *, CAST(date_diff('day', first_order_date, last_order_date) AS INTEGER) AS customer_lifespan_days,
               {_scaled(_half_up(_whole('lifetime_value', 2) + ' * 1000000', 'order_count'), 8, 38)}
                   AS avg_order_value,
               CAST(row_number() OVER (ORDER BY lifetime_value DESC, customer_id) AS INTEGER) AS ltv_rank
        FROM values_per_customer""",
    # ---- change log ----
    "log": """
        SELECT user_id, ts, event_id, event_type, value, props, strftime(ts, '%Y%m%d') AS _commit_time FROM events""",
    # ---- further tables ----
    "order_columns": """
        SELECT order_id, customer_id, order_status, order_purchase_date, delivery_delay_days FROM s_orders""",
    "facts": """
        SELECT order_id, order_item_key, product_id, seller_id, price, freight_value, customer_id, order_status,
               order_purchase_date, delivery_delay_days
        FROM s_items LEFT JOIN order_columns USING (order_id)""",
    "feed": """
        SELECT * REPLACE (product_length_cm + 1 AS product_length_cm,
                          TIMESTAMP '2024-02-01 00:00:00' AS _ingested_at, 'feed' AS _batch_id,
                          'products.json' AS _source_file, 'api' AS _source_system)
        FROM s_products WHERE product_category_name = 'promo'""",
    "touched_dates": """
        SELECT DISTINCT order_purchase_date FROM s_orders
        WHERE order_id IN (SELECT order_id FROM s_items WHERE shipping_limit_date >= TIMESTAMP '2001-06-01')""",
}


def _sql(statement: str) -> str:
    """``statement`` behind the tables it names, directly or through other tables, in their order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in _CTE:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(_CTE[name])

    visit(statement)
    tables = ",\n".join(f"{name} AS ({_CTE[name].strip()})" for name in _CTE if name in needed)
    return f"WITH {tables}\n{statement}" if tables else statement


def _rule(table: str, source: str, check: str, bad: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{check}' AS check_name, "
        f"CAST(count(*) FILTER (WHERE {bad}) AS BIGINT) AS violations FROM {source}"
    )


def _unique(table: str, source: str, columns: str) -> str:
    return (
        f"SELECT '{table}', 'unique.{columns}', CAST((SELECT count(*) FROM {source}) - "
        f"(SELECT count(*) FROM (SELECT DISTINCT {columns} FROM {source})) AS BIGINT)"
    )


_QUALITY = {
    ("orders_silver", "s_orders"): (
        ["order_id", "customer_id", "order_purchase_date"],
        ["order_id"],
        {"order_status_trimmed_lowercase": "order_status <> lower(trim(order_status))"},
    ),
    ("customers_silver", "s_customers"): (
        ["customer_id", "customer_unique_id", "customer_state"],
        ["customer_id"],
        {"customer_state_has_len_2": "length(customer_state) <> 2"},
    ),
    ("payments_silver", "s_payments"): (
        ["payment_key", "order_id", "payment_type"],
        ["payment_key"],
        {
            "payment_value_non_negative": "payment_value < 0",
            "payment_installments_positive": "payment_installments <= 0",
        },
    ),
    ("reviews_silver", "s_reviews"): (
        ["review_id", "order_id", "review_score"],
        ["review_id"],
        {"review_score_between_1_and_5": "review_score < 1 OR review_score > 5"},
    ),
    ("geolocation_silver", "s_geolocation"): (
        ["geolocation_key", "geolocation_zip_code_prefix", "geolocation_state"],
        ["geolocation_key"],
        {"geolocation_state_has_len_2": "length(geolocation_state) <> 2"},
    ),
    ("products_silver", "s_products"): (["product_id"], ["product_id"], {}),
    ("daily_sales_gold", "g_daily"): (
        ["order_date"],
        ["order_date"],
        {
            "order_count_positive": "order_count <= 0",
            "payment_value_non_negative": "payment_value < 0",
            "gross_item_value_non_negative": "gross_item_value < 0",
        },
    ),
    ("category_sales_gold", "g_category"): (
        ["order_purchase_date", "category_name"],
        ["order_purchase_date,category_name"],
        {
            "gross_values_non_negative": "gross_item_value < 0 OR gross_freight_value < 0",
            "counts_positive": "order_count <= 0 OR item_count <= 0",
        },
    ),
    ("customer_ltv_gold", "g_ltv"): (
        ["customer_id", "customer_unique_id", "order_count", "lifetime_value", "ltv_rank"],
        ["customer_id", "ltv_rank"],
        {
            "order_count_positive": "order_count <= 0",
            "lifetime_value_non_negative": "lifetime_value < 0",
            "first_order_before_last_order": "first_order_date > last_order_date",
        },
    ),
}


def _quality() -> str:
    parts = []
    for (table, source), (not_null, unique, bad) in _QUALITY.items():
        parts += [_rule(table, source, f"not_null.{c}", f"{c} IS NULL") for c in not_null]
        parts += [_unique(table, source, columns) for columns in unique]
        parts += [_rule(table, source, name, condition) for name, condition in bad.items()]
    return "SELECT *, violations = 0 AS passed FROM (" + "\nUNION ALL ".join(parts) + ")"


def _compared(rows: list[tuple[str, str, str]], kind: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS check_name, CAST(({actual}) AS {kind}) AS actual, CAST(({expected}) AS {kind}) AS expected"
        for name, actual, expected in rows
    )


_FRESHNESS = _compared(
    [
        (
            "freshness.max_date.orders_vs_daily",
            "SELECT max(order_purchase_date) FROM s_orders",
            "SELECT max(order_date) FROM g_daily",
        ),
        (
            "freshness.max_date.orders_with_items_vs_category",
            "SELECT max(order_purchase_date) FROM s_orders WHERE order_id IN (SELECT order_id FROM s_items)",
            "SELECT max(order_purchase_date) FROM g_category",
        ),
        (
            "freshness.max_date.orders_vs_customer_ltv",
            "SELECT max(order_purchase_date) FROM s_orders",
            "SELECT max(last_order_date) FROM g_ltv",
        ),
        (
            "freshness.min_date.orders_vs_daily",
            "SELECT min(order_purchase_date) FROM s_orders",
            "SELECT min(order_date) FROM g_daily",
        ),
    ],
    "DATE",
)

_COUNTS = _compared(
    [
        (
            "reconcile.order_count.orders_vs_daily",
            "SELECT sum(order_count) FROM g_daily",
            "SELECT count(DISTINCT order_id) FROM s_orders",
        ),
        (
            "reconcile.order_count.orders_vs_customer_ltv",
            "SELECT sum(order_count) FROM g_ltv",
            "SELECT count(DISTINCT order_id) FROM s_orders",
        ),
        (
            "reconcile.item_count.order_items_vs_category",
            "SELECT sum(item_count) FROM g_category",
            "SELECT count(DISTINCT order_item_key) FROM s_items",
        ),
    ],
    "BIGINT",
)

_VALUES = _compared(
    [
        (
            f"reconcile.{measured}.{source}_vs_{mart}",
            f"SELECT sum({mart_column}) FROM {mart_table}",
            f"SELECT sum({column}) FROM {table}",
        )
        for measured, source, mart, mart_column, mart_table, column, table in [
            ("payment_value", "payments", "daily", "payment_value", "g_daily", "payment_value", "s_payments"),
            ("payment_value", "payments", "customer_ltv", "lifetime_value", "g_ltv", "payment_value", "s_payments"),
            ("gross_item_value", "order_items", "daily", "gross_item_value", "g_daily", "price", "s_items"),
            ("gross_item_value", "order_items", "category", "gross_item_value", "g_category", "price", "s_items"),
            ("gross_freight_value", "order_items", "daily", "gross_freight_value", "g_daily", "freight_value", "s_items"),
            (
                "gross_freight_value",
                "order_items",
                "category",
                "gross_freight_value",
                "g_category",
                "freight_value",
                "s_items",
            ),
        ]
    ],
    "DECIMAL(38,2)",
)


def _row_counts() -> str:
    rows = [
        ("bronze", "orders_bronze", "b_orders", "orders"),
        ("bronze", "order_items_bronze", "b_items", "lineitem"),
        ("bronze", "customers_bronze", "b_customers", "customer"),
        ("bronze", "payments_bronze", "b_payments", "parts_paid"),
        ("bronze", "products_bronze", "b_products", "part"),
        ("bronze", "sellers_bronze", "b_sellers", "supplier"),
        ("bronze", "reviews_bronze", "b_reviews", "documents"),
        ("bronze", "geolocation_bronze", "b_geolocation", "customer"),
        (
            "bronze",
            "product_category_translation_bronze",
            "b_translation",
            "(SELECT * FROM part WHERE p_type <> 'PROMO')",
        ),
        ("silver", "orders_silver", "s_orders", "(SELECT DISTINCT o_orderkey FROM orders)"),
        ("silver", "order_items_silver", "s_items", "(SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)"),
        ("silver", "customers_silver", "s_customers", "(SELECT DISTINCT c_custkey FROM customer)"),
        ("silver", "payments_silver", "s_payments", "(SELECT DISTINCT o_orderkey, payment_sequential FROM parts_paid)"),
        ("silver", "products_silver_base", "s_products_base", "(SELECT DISTINCT p_partkey FROM part)"),
        ("silver", "products_silver", "s_products", "(SELECT DISTINCT p_partkey FROM part)"),
        ("silver", "sellers_silver", "s_sellers", "(SELECT DISTINCT s_suppkey FROM supplier)"),
        ("silver", "reviews_silver", "s_reviews", "(SELECT DISTINCT text FROM documents)"),
        ("silver", "geolocation_silver", "s_geolocation", "(SELECT DISTINCT zip, lat, lng FROM place_rows)"),
        (
            "silver",
            "product_category_translation_silver",
            "s_translation",
            "(SELECT DISTINCT p_type FROM part WHERE p_type <> 'PROMO')",
        ),
        ("gold", "daily_sales_gold", "g_daily", "(SELECT DISTINCT CAST(o_orderdate AS DATE) FROM orders)"),
        (
            "gold",
            "category_sales_gold",
            "g_category",
            "(SELECT DISTINCT order_purchase_date, category_name FROM s_items "
            "LEFT JOIN categories USING (product_id) LEFT JOIN s_orders USING (order_id))",
        ),
        ("gold", "customer_ltv_gold", "g_ltv", "(SELECT DISTINCT o_custkey FROM orders)"),
    ]
    counted = "\nUNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{name}' AS table_name, (SELECT count(*) FROM {actual}) AS actual_rows, "
        f"(SELECT count(*) FROM {expected}) AS expected_rows"
        for layer, name, actual, expected in rows
    )
    return f"SELECT *, actual_rows = expected_rows AS passed FROM ({counted})"


def _rejected(columns: dict[str, tuple[str, str]]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS column_name, CAST(count(*) FILTER (WHERE {value} IS NOT NULL AND "
        f"TRY_CAST(CAST({value} AS VARCHAR) AS {kind}) IS NULL) AS BIGINT) AS rejected FROM lineitem"
        for name, (value, kind) in columns.items()
    )


_MONTH = "CAST(date_trunc('month', {}) AS DATE)"
_STATE = _newest("log", "user_id", "ts", "_commit_time", "event_id")


def _state(condition: str) -> str:
    return _newest(f"(SELECT * FROM log WHERE {condition})", "user_id", "ts", "_commit_time", "event_id")


_TOP_CATEGORIES = """
    SELECT category_name, CAST(sum(order_count) AS BIGINT) AS order_count, {more}
           CAST(round(sum(gross_item_value), 2) AS DECIMAL(33,2)) AS gross_item_value {freight}
    FROM g_category GROUP BY category_name ORDER BY {order} DESC, category_name LIMIT 15"""

_STATEMENTS = {
    "bronze_orders": "SELECT * FROM b_orders",
    "bronze_order_items": "SELECT * FROM b_items",
    "bronze_customers": "SELECT * FROM b_customers",
    "bronze_payments": "SELECT * FROM b_payments",
    "bronze_products": "SELECT * FROM b_products",
    "bronze_sellers": "SELECT * FROM b_sellers",
    "bronze_reviews": "SELECT * FROM b_reviews",
    "bronze_geolocation": "SELECT * FROM b_geolocation",
    "bronze_category_translation": "SELECT * FROM b_translation",
    "silver_orders": "SELECT * FROM s_orders",
    "silver_order_items": "SELECT * FROM s_items",
    "silver_customers": "SELECT * FROM s_customers",
    "silver_payments": "SELECT * FROM s_payments",
    "silver_products_base": "SELECT * FROM s_products_base",
    "silver_products": "SELECT * FROM s_products",
    "silver_sellers": "SELECT * FROM s_sellers",
    "silver_reviews": "SELECT * FROM s_reviews",
    "silver_geolocation": "SELECT * FROM s_geolocation",
    "silver_category_translation": "SELECT * FROM s_translation",
    "gold_daily_sales": "SELECT * FROM g_daily",
    "append_build_parquet": _daily("orders_by_year", "items_by_year"),
    "append_build_log": _daily("orders_by_year", "items_by_year"),
    "refresh_after_delete": """
        SELECT strftime(order_purchase_date, '%Y-%m-%d') AS gold_key, count(*) AS order_count,
               CAST(sum(coalesce(items, 0)) AS BIGINT) AS item_count,
               CAST(sum(coalesce(value, 0)) AS DECIMAL(32,2)) AS gross_item_value,
               CAST(sum(CASE WHEN CAST(order_id AS BIGINT) % 5 = 0 THEN 0 ELSE coalesce(paid, 0) END)
                    AS DECIMAL(32,2)) AS payment_value
        FROM s_orders LEFT JOIN items_per_order USING (order_id) LEFT JOIN paid_per_order USING (order_id)
        WHERE CAST(order_id AS BIGINT) % 7 <> 0 GROUP BY order_purchase_date
        UNION ALL
        SELECT concat_ws('_', strftime(order_purchase_date, '%Y-%m-%d'), category), count(DISTINCT order_id),
               count(DISTINCT order_item_key), CAST(sum(price) AS DECIMAL(32,2)), CAST(NULL AS DECIMAL(32,2))
        FROM (SELECT s_items.*, CASE WHEN CAST(product_id AS BIGINT) % 3 = 0 THEN 'unknown'
                                     ELSE coalesce(category_name, 'unknown') END AS category
              FROM s_items LEFT JOIN categories USING (product_id))
             LEFT JOIN (SELECT order_id, order_purchase_date FROM s_orders
                        WHERE CAST(order_id AS BIGINT) % 7 <> 0) USING (order_id)
        GROUP BY order_purchase_date, category""",
    "gold_category_sales": "SELECT * FROM g_category",
    "gold_customer_ltv": "SELECT * FROM g_ltv",
    "report_daily_trend": """
        SELECT order_date, order_count, item_count, payment_value, avg_order_payment_value
        FROM g_daily ORDER BY order_date""",
    "report_monthly_sales": f"""
        SELECT {_MONTH.format('order_date')} AS sales_month, CAST(sum(order_count) AS BIGINT) AS order_count,
               CAST(sum(item_count) AS BIGINT) AS item_count, sum(payment_value) AS total_payment_value,
               {_scaled(_half_up(_half_up(
                   f"sum({_whole('avg_order_payment_value', 6)}) * 10000", 'count(*)'), '10000'), 6, 26)}
                   AS avg_daily_order_payment_value
        FROM g_daily GROUP BY 1 ORDER BY 1""",
    "report_top_categories_value": _TOP_CATEGORIES.format(
        more="CAST(sum(item_count) AS BIGINT) AS item_count,",
        freight=", CAST(round(sum(gross_freight_value), 2) AS DECIMAL(33,2)) AS gross_freight_value",
        order="gross_item_value",
    ),
    "report_top_categories_orders": _TOP_CATEGORIES.format(more="", freight="", order="order_count"),
    "report_top_customers": f"""
        SELECT customer_id, customer_unique_id, customer_city, customer_state, order_count,
               CAST(round(lifetime_value, 2) AS DECIMAL(33,2)) AS lifetime_value,
               {_scaled(_half_up(_whole('avg_order_value', 8), '1000000'), 2, 33)} AS avg_order_value,
               first_order_date, last_order_date, ltv_rank
        FROM g_ltv ORDER BY lifetime_value DESC, customer_id LIMIT 20""",
    "report_top_states": f"""
        SELECT customer_state, count(*) AS customer_count, CAST(sum(order_count) AS BIGINT) AS order_count,
               round(sum(lifetime_value), 2) AS lifetime_value,
               {_scaled(_half_up(_half_up(_half_up(
                   f"sum({_whole('avg_order_value', 8)}) * 10000", 'count(*)'), '10000'), '1000000'), 2, 33)}
                   AS avg_order_value
        FROM g_ltv GROUP BY customer_state ORDER BY lifetime_value DESC, customer_state LIMIT 15""",
    "report_monthly_category_leaders": f"""
        SELECT sales_month, category_name, gross_item_value FROM (
            SELECT {_MONTH.format('order_purchase_date')} AS sales_month, category_name,
                   CAST(round(sum(gross_item_value), 2) AS DECIMAL(33,2)) AS gross_item_value
            FROM g_category GROUP BY 1, 2)
        QUALIFY row_number() OVER (PARTITION BY sales_month ORDER BY gross_item_value DESC, category_name) <= 3""",
    "report_freight_efficiency": f"""
        SELECT order_date, payment_value, gross_item_value, gross_freight_value,
               CAST(round(payment_value - gross_freight_value, 2) AS DECIMAL(34,2)) AS payment_minus_freight,
               CASE WHEN payment_value <> 0 THEN {_scaled(_half_up(_half_up(
                   _whole('gross_freight_value', 2) + ' * 1000000', _whole('payment_value', 2)), '100'), 4, 37)}
               END AS freight_ratio
        FROM g_daily ORDER BY order_date""",
    "report_gold_counts": """
        SELECT 'daily_sales_gold' AS table_name, count(*) AS row_count FROM g_daily
        UNION ALL SELECT 'category_sales_gold', count(*) FROM g_category
        UNION ALL SELECT 'customer_ltv_gold', count(*) FROM g_ltv""",
    "report_latest_rows_daily": "SELECT * FROM g_daily ORDER BY order_date DESC LIMIT 10",
    "report_latest_rows_category": """
        SELECT * FROM g_category ORDER BY order_purchase_date DESC, gross_item_value DESC, category_name LIMIT 10""",
    "report_latest_rows_ltv": "SELECT * FROM g_ltv ORDER BY lifetime_value DESC, customer_id LIMIT 10",
    "check_quality": _quality(),
    "check_freshness": f"SELECT *, actual IS NOT DISTINCT FROM expected AS passed FROM ({_FRESHNESS})",
    "check_reconcile_counts": f"SELECT *, actual IS NOT DISTINCT FROM expected AS passed FROM ({_COUNTS})",
    "check_reconcile_values": f"""
        SELECT *, abs(actual - expected) AS diff, abs(actual - expected) <= 0.01 AS passed FROM ({_VALUES})""",
    "check_row_counts": _row_counts(),
    "check_accepted_values": """
        SELECT order_status AS value, count(*) AS row_count, order_status IN ('f', 'o') AS accepted,
               order_status IN ('f', 'o') AS passed
        FROM s_orders GROUP BY order_status""",
    "check_partition_completeness": """
        SELECT CAST(d.day AS DATE) AS day, count(o.order_id) AS row_count, count(o.order_id) > 0 AS complete,
               count(o.order_id) > 0 AS passed
        FROM (SELECT unnest(generate_series(min(dt), max(dt), INTERVAL 1 DAY)) AS day FROM b_orders) d
             LEFT JOIN b_orders o ON o.dt = CAST(d.day AS DATE)
        GROUP BY 1""",
    "check_drift_history": """
        SELECT day, 'orders_bronze' AS table_name, row_count, CAST(len(earlier) AS INTEGER) AS earlier_loads,
               round(usual, 6) AS usual, round(spread, 6) AS spread,
               coalesce(abs(row_count - usual) <= greatest(4 * spread, 0.25 * usual), true) AS passed
        FROM (SELECT *, CASE WHEN usual IS NOT NULL
                        THEN list_median(list_transform(earlier, lambda x: abs(x - usual))) * 1.4826 END AS spread
              FROM (SELECT *, CASE WHEN len(earlier) >= 3 THEN list_median(earlier) END AS usual
                    FROM (SELECT day, row_count,
                                 coalesce(list(CAST(row_count AS DOUBLE)) OVER (PARTITION BY dayofweek(day) ORDER BY day
                                          ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING), []) AS earlier
                          FROM (SELECT dt AS day, count(*) AS row_count FROM b_orders WHERE dt IS NOT NULL GROUP BY dt))))""",
    "check_row_count_drift": """
        SELECT day, row_count, previous_count, CAST(row_count - previous_count AS DOUBLE) / previous_count AS drift,
               previous_count IS NULL OR abs(CAST(row_count - previous_count AS DOUBLE) / previous_count) <= 0.5 AS passed
        FROM (SELECT dt AS day, count(*) AS row_count, lag(count(*)) OVER (ORDER BY dt) AS previous_count
              FROM b_orders GROUP BY dt)""",
    "rejected_values": _rejected(
        {
            "order_item_id": ("l_linenumber", "INTEGER"),
            "shipping_limit_date": ("l_shipdate", "TIMESTAMP"),
            "price": ("l_extendedprice", "DECIMAL(12,2)"),
            "freight_value": (f"round({_PRICE} * CAST(l_tax AS DECIMAL(4,2)), 2)", "DECIMAL(12,2)"),
        }
    ),
    "orphan_items": """
        SELECT order_item_key, order_id, price FROM s_items
        WHERE order_id NOT IN (SELECT order_id FROM s_orders WHERE order_status <> 'o')""",
    "semi_join_orders_with_items": """
        SELECT order_id, order_purchase_date FROM s_orders WHERE order_id IN (SELECT order_id FROM s_items)""",
    "smoke_orders": """
        SELECT order_id, customer_id, order_status, dt, (SELECT count(*) FROM b_orders) AS total_rows
        FROM b_orders ORDER BY order_id LIMIT 5""",
    "upsert_snapshot": _STATE,
    "snapshot": _STATE,
    "as_of": _state("_commit_time <= '20240115'"),
    "instants": "SELECT DISTINCT _commit_time FROM log ORDER BY _commit_time",
    "latest_instant": "SELECT max(_commit_time) AS _commit_time FROM log",
    "previous_instant": "SELECT DISTINCT _commit_time FROM log ORDER BY _commit_time DESC LIMIT 1 OFFSET 1",
    "version_diff": f"""
        SELECT user_id,
               CASE WHEN a.ts IS NULL THEN 'inserted' WHEN b.ts IS NULL THEN 'deleted'
                    WHEN a.event_type IS NOT DISTINCT FROM b.event_type AND a.value IS NOT DISTINCT FROM b.value
                    THEN 'unchanged' ELSE 'updated' END AS change_type,
               a.event_type AS event_type_before, b.event_type AS event_type_after,
               a.value AS value_before, b.value AS value_after
        FROM ({_state("_commit_time <= '20240110'")}) a
             FULL JOIN ({_state("_commit_time <= '20240111'")}) b USING (user_id)""",
    "changes_since": _state("_commit_time > '20240129'"),
    "delete_snapshot": f"SELECT * FROM ({_STATE}) WHERE event_type <> 'error'",
    "latest_per_key": _newest(
        "lineitem",
        "l_orderkey, l_linenumber",
        "l_shipdate",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "l_returnflag",
        "l_linestatus",
    ),
    "number_equal_rows": """
        SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey, l_linenumber) AS ordinal
        FROM lineitem""",
    "global_row_number": """
        SELECT o_orderkey, o_totalprice,
               row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS price_rank
        FROM orders""",
    "top_n_per_group": """
        SELECT o_custkey, o_orderkey, o_totalprice,
               CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER)
                   AS place
        FROM orders QUALIFY place <= 3""",
    "order_facts": "SELECT * FROM facts",
    "order_payment_facts": """
        SELECT facts.*, CAST(paid AS DECIMAL(22,2)) AS order_payment_value, parts AS order_payment_count,
               installments AS max_installments
        FROM facts LEFT JOIN paid_per_order USING (order_id)""",
    "customer_orders": """
        SELECT o.*, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state
        FROM order_columns o LEFT JOIN s_customers USING (customer_id)""",
    "sales_enriched": """
        SELECT order_id, order_item_key, product_id, seller_id, price, freight_value, category_name,
               seller_city, seller_state
        FROM s_items LEFT JOIN categories USING (product_id) LEFT JOIN s_sellers USING (seller_id)""",
    "order_reviews": """
        SELECT review_id, order_id, review_score, review_creation_date, review_answer_timestamp, customer_id,
               order_status, order_purchase_date, delivery_delay_days
        FROM s_reviews LEFT JOIN order_columns USING (order_id)""",
    "products_api_silver": "SELECT * FROM feed",
    "products_current": """
        SELECT * FROM feed
        UNION ALL SELECT * FROM s_products WHERE product_id NOT IN (SELECT product_id FROM feed)""",
    "delivery_performance": """
        SELECT order_purchase_date, order_status, count(*) AS order_count,
               count(delivery_delay_days) AS delivered_count,
               CAST(count(*) FILTER (WHERE delivery_delay_days > 0) AS BIGINT) AS late_count,
               CAST(count(*) FILTER (WHERE delivery_delay_days <= 0) AS BIGINT) AS on_time_count,
               max(delivery_delay_days) AS max_delay_days,
               CAST(count(*) FILTER (WHERE delivery_delay_days > 0) AS DOUBLE)
                   / nullif(count(delivery_delay_days), 0) AS delayed_ratio
        FROM s_orders GROUP BY 1, 2""",
    "seller_performance": """
        SELECT seller_id, count(DISTINCT order_id) AS order_count, count(DISTINCT order_item_key) AS item_count,
               CAST(sum(price) AS DECIMAL(22,2)) AS gross_item_value,
               CAST(sum(freight_value) AS DECIMAL(22,2)) AS gross_freight_value, seller_city, seller_state
        FROM s_items LEFT JOIN s_sellers USING (seller_id) GROUP BY seller_id, seller_city, seller_state""",
    "customer_satisfaction": f"""
        SELECT {_MONTH.format('review_creation_date')} AS review_month, count(*) AS review_count,
               count(review_score) AS scored_count,
               CAST(sum(review_score) AS DOUBLE) / nullif(count(review_score), 0) AS avg_review_score,
               CAST(count(*) FILTER (WHERE review_score <= 2) AS BIGINT) AS low_score_count,
               CAST(count(*) FILTER (WHERE review_score >= 4) AS BIGINT) AS high_score_count
        FROM s_reviews GROUP BY 1""",
    "payment_type_summary": """
        SELECT payment_type, count(*) AS payment_count, CAST(sum(payment_value) AS DECIMAL(22,2)) AS payment_value,
               CAST(sum(payment_value) AS DOUBLE) / count(*) AS avg_payment_value,
               CAST(sum(payment_installments) AS DOUBLE) / count(payment_installments) AS avg_installments,
               max(payment_installments) AS max_installments
        FROM s_payments GROUP BY payment_type""",
    "refresh_daily_sales": """
        SELECT * FROM g_daily WHERE order_date IN (SELECT order_purchase_date FROM touched_dates)""",
    "refresh_category_sales": """
        SELECT * FROM g_category WHERE order_purchase_date IN (SELECT order_purchase_date FROM touched_dates)""",
    "refresh_customer_ltv": "SELECT * FROM g_ltv",
    "csv_round_trip": "SELECT * EXCLUDE (_ingested_at, _batch_id, _source_file, _source_system) FROM b_items",
    "multi_line_csv_round_trip": "SELECT review_id, order_id, review_score, review_comment_message FROM b_reviews",
    "json_feed_round_trip": """
        SELECT product_id, p_type AS product_category_name,
               CAST(product_name_lenght AS VARCHAR) AS product_name_lenght,
               CAST(product_description_lenght AS VARCHAR) AS product_description_lenght,
               CAST(product_photos_qty AS VARCHAR) AS product_photos_qty,
               CAST(product_weight_g AS VARCHAR) AS product_weight_g,
               CAST(product_length_cm + 1 AS VARCHAR) AS product_length_cm,
               CAST(product_height_cm AS VARCHAR) AS product_height_cm,
               CAST(product_width_cm AS VARCHAR) AS product_width_cm, '2024-02-01' AS dt
        FROM b_products JOIN part ON product_id = CAST(p_partkey AS VARCHAR) WHERE p_type = 'PROMO'""",
    "partition_overwrite": """
        SELECT order_id, CASE WHEN order_status = 'f' THEN 'changed' ELSE customer_id END AS customer_id, order_status
        FROM s_orders""",
    "refresh_all": """
        SELECT 'daily' AS mart, gold_key, order_count, item_count, CAST(gross_item_value AS DECIMAL(32,2)) AS value,
               avg_order_payment_value AS average FROM g_daily
        UNION ALL
        SELECT 'category', gold_key, order_count, item_count, CAST(gross_item_value AS DECIMAL(32,2)), NULL FROM g_category
        UNION ALL
        SELECT 'customer', customer_id, order_count, CAST(ltv_rank AS BIGINT), CAST(lifetime_value AS DECIMAL(32,2)), NULL
        FROM g_ltv""",
    "change_feed": """
        SELECT _commit_time, change_type, order_item_key, CAST(now AS DECIMAL(12,2)) AS price, before AS price_before
        FROM (SELECT *, CASE WHEN t % 5 = 2 THEN '3' ELSE '2' END AS _commit_time,
                     CASE t % 5 WHEN 0 THEN 'insert' WHEN 1 THEN 'update' ELSE 'delete' END AS change_type,
                     CASE WHEN t % 5 = 1 THEN price + 1 ELSE price END AS now,
                     CASE WHEN t % 5 <> 0 THEN price END AS before
              FROM (SELECT order_item_key, price, CAST(split_part(order_item_key, '_', 1) AS BIGINT) * 3
                           + CAST(split_part(order_item_key, '_', 2) AS BIGINT) AS t FROM s_items)
              WHERE t % 5 <= 2 AND NOT (t % 5 = 1 AND t % 7 = 0))""",
    "change_log_round_trip": """
        SELECT order_item_key, order_id, product_id, seller_id, shipping_limit_date, price, freight_value,
               CASE WHEN shipping_limit_date < TIMESTAMP '1998-01-01' THEN '20240101000000000'
                    ELSE '20240102000000000' END AS _commit_time
        FROM s_items""",
}

ORACLE = {name: _sql(statement) for name, statement in _STATEMENTS.items()}
