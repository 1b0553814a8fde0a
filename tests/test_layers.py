"""Silver and gold on small tables with all edge cases, against results worked out by hand."""

import datetime
from decimal import Decimal

import pytest

from lakemart.operators.checks import ChecksFailed, check_rules, enforce
from lakemart.operators.dedupe import latest_per_key
from lakemart.plans import extended, gold, quality, reports, silver
from tests.compare import missing_last, rows

D = datetime.date


@pytest.fixture(scope="module")
def orders(spark):
    data = [
        ("o1", "c1", " Delivered ", "2018-01-01 10:00:00", "2018-01-05 00:00:00", "2018-01-03 23:00:00"),
        ("o2", "c1", "shipped", "2018-01-01 23:59:59", None, "2018-01-09 00:00:00"),
        ("o3", "c2", "delivered", "2018-02-02 00:00:00", "2018-02-03 00:00:00", "2018-02-07 00:00:00"),
        ("o4", None, "canceled", None, None, None),
        ("o3", "c9", "delivered", "2018-01-31 00:00:00", None, None),
    ]
    names = (
        "order_id string, customer_id string, order_status string, order_purchase_timestamp string, "
        "order_delivered_customer_date string, order_estimated_delivery_date string"
    )
    df = spark.createDataFrame(data, names)
    stamps = [c for c in df.columns if c.endswith(("_timestamp", "_date"))]
    return silver.orders(df.withColumns({c: df[c].cast("timestamp") for c in stamps}))


@pytest.fixture(scope="module")
def items(spark):
    data = [
        ("o1", 1, "p1", "s1", "2018-01-02 00:00:00", "10.00", "1.00", "o1_1"),
        ("o1", 2, "p2", "s1", "2018-01-02 00:00:00", "20.00", "2.00", "o1_2"),
        ("o1", 3, "p1", "s2", "2018-01-02 00:00:00", "30.00", "3.00", "o1_3"),
        ("o1", 3, "p1", "s2", "2018-01-01 00:00:00", "99.00", "9.00", "o1_3"),
        ("o3", 1, "p3", "s1", "2018-02-04 00:00:00", "40.00", None, "o3_1"),
        ("o3", 2, "gone", None, "2018-02-04 00:00:00", "50.00", "5.00", "o3_2"),
        ("zz", 1, "p1", "s1", "2018-02-04 00:00:00", "60.00", "6.00", "zz_1"),
    ]
    names = (
        "order_id string, order_item_id int, product_id string, seller_id string, shipping_limit_date string, "
        "price string, freight_value string, order_item_key string"
    )
    return silver.order_items(spark.createDataFrame(data, names))


@pytest.fixture(scope="module")
def payments(spark):
    data = [
        ("o1", 1, " Credit_Card", 0, "60.00", "o1_1"),
        ("o1", 2, "voucher", -1, "6.00", "o1_2"),
        ("o3", 1, "boleto", None, "95.00", "o3_1"),
        ("o3", 2, "boleto", 2, "-1.00", "o3_2"),
        ("o3", 3, "boleto", 2, None, "o3_3"),
    ]
    names = (
        "order_id string, payment_sequential int, payment_type string, payment_installments int, "
        "payment_value string, payment_key string"
    )
    df = spark.createDataFrame(data, names).selectExpr(
        "* except(payment_value)", "cast(payment_value as decimal(12,2)) payment_value",
        "timestamp'2024-01-01' _ingested_at",
    )
    return silver.payments(df)


@pytest.fixture(scope="module")
def products(spark):
    base = spark.createDataFrame(
        [("p1", " Beleza ", 3), ("p2", "sem_nome", None), ("p3", None, 1)],
        "product_id string, product_category_name string, product_photos_qty int",
    ).selectExpr(
        "*",
        *[
            f"cast(null as int) {c}"
            for c in (
                "product_name_lenght",
                "product_description_lenght",
                "product_weight_g",
                "product_length_cm",
                "product_height_cm",
                "product_width_cm",
            )
        ],
        "timestamp'2024-01-01' _ingested_at",
    )
    words = spark.createDataFrame(
        [("Beleza", "Beauty"), (" beleza ", "beauty"), ("x", "y")],
        "product_category_name string, product_category_name_english string",
    ).selectExpr("*", "timestamp'2024-01-01' _ingested_at")
    return silver.products(silver.products_base(base), silver.category_translation(words))


def test_silver_orders(orders):
    assert rows(orders, "order_id", "order_status", "order_purchase_date", "delivery_delay_days") == [
        ("o1", "delivered", D(2018, 1, 1), 2),
        ("o2", "shipped", D(2018, 1, 1), None),
        ("o3", "delivered", D(2018, 2, 2), -4),
        ("o4", "canceled", None, None),
    ]


def test_silver_items_keep_the_newest(items):
    assert rows(items.where("order_item_key = 'o1_3'"), "price") == [(Decimal("30.00"),)]


def test_silver_payments_clamp_and_filter(payments):
    assert rows(payments, "payment_key", "payment_type", "payment_installments", "payment_value") == [
        ("o1_1", "credit_card", 1, Decimal("60.00")),
        ("o1_2", "voucher", 1, Decimal("6.00")),
        ("o3_1", "boleto", None, Decimal("95.00")),
    ]


def test_silver_products_fall_back_to_the_source_name(products):
    assert rows(products, "product_id", "product_category_name_english", "product_photos_qty", "product_weight_g") == [
        ("p1", "beauty", 3, 0),
        ("p2", "sem_nome", 0, 0),
        ("p3", None, 1, 0),
    ]


def test_equal_ordering_keeps_the_same_row_whatever_the_partitions(spark):
    data = [("k", 1, v) for v in "abcdef"] + [(None, 1, "x"), (None, 2, "y"), ("n", None, "z"), ("n", 0, "w")]
    df = spark.createDataFrame(data, "k string, o int, v string")
    for parts in (1, 2, 7):
        kept = latest_per_key(df.repartition(parts), "k", "o")
        assert rows(kept, "k", "o", "v") == [("k", 1, "f"), ("n", 0, "w"), (None, 2, "y")]


def test_daily_sales(orders, items, payments):
    daily = gold.daily_sales(orders, items, payments)
    assert rows(daily, *daily.columns) == [
        (D(2018, 1, 1), 2, 3, Decimal("60.00"), Decimal("6.00"), Decimal("66.00"), Decimal("33.000000"), "2018-01-01"),
        (D(2018, 2, 2), 1, 2, Decimal("90.00"), Decimal("5.00"), Decimal("95.00"), Decimal("95.000000"), "2018-02-02"),
        (None, 1, 0, Decimal("0.00"), Decimal("0.00"), Decimal("0.00"), Decimal("0.000000"), None),
    ]
    kinds = dict(daily.dtypes)
    assert kinds["gross_item_value"] == "decimal(32,2)" and kinds["payment_value"] == "decimal(32,2)"
    assert kinds["avg_order_payment_value"] == "decimal(26,6)" and kinds["order_count"] == "bigint"


def test_category_sales(orders, items, products):
    category = gold.category_sales(items, products, orders)
    assert rows(category, *category.columns) == [
        (D(2018, 1, 1), "beauty", 1, 2, Decimal("40.00"), Decimal("4.00"), "2018-01-01_beauty"),
        (D(2018, 1, 1), "sem_nome", 1, 1, Decimal("20.00"), Decimal("2.00"), "2018-01-01_sem_nome"),
        (D(2018, 2, 2), "unknown", 1, 2, Decimal("90.00"), Decimal("5.00"), "2018-02-02_unknown"),
        (None, "beauty", 1, 1, Decimal("60.00"), Decimal("6.00"), "beauty"),
    ]
    assert dict(category.dtypes)["gross_item_value"] == "decimal(22,2)"


def test_customer_ltv(spark, orders, payments):
    customers = spark.createDataFrame(
        [("c1", "u1", "Rio", "RJ"), ("c3", "u3", "Rio", "RJ")],
        "customer_id string, customer_unique_id string, customer_city string, customer_state string",
    )
    ltv = gold.customer_ltv(orders, customers, payments)
    assert rows(ltv, *ltv.columns) == sorted(
        [
            ("c2", None, None, None, 1, Decimal("95.00"), D(2018, 2, 2), D(2018, 2, 2), 0, Decimal("95.00000000"), 1),
            ("c1", "u1", "Rio", "RJ", 2, Decimal("66.00"), D(2018, 1, 1), D(2018, 1, 1), 0, Decimal("33.00000000"), 2),
            (None, None, None, None, 1, Decimal("0.00"), None, None, None, Decimal("0E-8"), 3),
        ],
        key=missing_last,
    )
    kinds = dict(ltv.dtypes)
    assert (kinds["lifetime_value"], kinds["avg_order_value"], kinds["ltv_rank"]) == (
        "decimal(32,2)",
        "decimal(38,8)",
        "int",
    )
    unranked = gold.customer_values(orders, customers, payments)
    assert reports.top_customers(ltv, 2).collect() == reports.top_customers(unranked, 2).collect()


def test_orphans_and_orders_with_items(orders, items):
    assert rows(quality.orphan_items(items, orders), "order_item_key") == [("zz_1",)]
    assert rows(quality.orders_with_items(orders, items), "order_id") == [("o1",), ("o3",)]


def test_freight_share_is_missing_where_nothing_was_paid(orders, items, payments):
    found = reports.freight_efficiency(gold.daily_sales(orders, items, payments))
    assert rows(found, "order_date", "payment_minus_freight", "freight_ratio") == [
        (D(2018, 1, 1), Decimal("60.00"), Decimal("0.0909")),
        (D(2018, 2, 2), Decimal("90.00"), Decimal("0.0526")),
        (None, Decimal("0.00"), None),
    ]


def test_checks_find_what_is_wrong(spark, orders, items, payments, products):
    daily = gold.daily_sales(orders, items, payments)
    found = check_rules(daily, next(r for r in quality.rules() if r.table == "daily_sales_gold"))
    assert dict(rows(found, "check_name", "violations")) == {
        "not_null.order_date": 1,
        "unique.order_date": 0,
        "order_count_positive": 0,
        "payment_value_non_negative": 0,
        "gross_item_value_non_negative": 0,
    }
    with pytest.raises(ChecksFailed, match="not_null.order_date"):
        enforce(found)
    enforce(found.where("passed"))
    # The item without an order is in the category mart but not in the daily one.
    category = gold.category_sales(items, products, orders)
    values = gold.customer_values(
        orders, spark.createDataFrame([], "customer_id string, customer_unique_id string, customer_city string, customer_state string"), payments
    )
    compared = quality.reconcile_values(items, payments, daily, category, values)
    failed = rows(compared.where("not passed"), "check_name", "diff")
    assert failed == [
        ("reconcile.gross_freight_value.order_items_vs_daily", Decimal("6.00")),
        ("reconcile.gross_item_value.order_items_vs_daily", Decimal("60.00")),
    ]
    fresh = quality.freshness(orders, items, daily, category, values)
    assert all(r.passed for r in fresh.collect())
    counted = quality.reconcile_counts(orders, items, daily, category, values)
    assert all(r.passed for r in counted.collect())


def test_checks_of_an_empty_table_pass(spark, orders, items, payments):
    empty = gold.daily_sales(orders, items, payments).limit(0)
    found = check_rules(empty, next(r for r in quality.rules() if r.table == "daily_sales_gold"))
    assert found.count() == 5 and found.where("passed and violations = 0").count() == 5


def test_unique_counts_missing_keys(spark):
    from lakemart.operators.checks import TableRules

    df = spark.createDataFrame([(None, 1), (None, 1), ("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    found = check_rules(df, TableRules("t", unique=(("k",), ("k", "v")), not_null=("k",)))
    assert dict(rows(found, "check_name", "violations")) == {"not_null.k": 2, "unique.k": 2, "unique.k,v": 1}


def test_there_are_48_rules(spark):
    found = quality.rules()
    assert sum(len(r.not_null) for r in found) == 24
    assert sum(len(r.unique) for r in found) == 10
    assert sum(len(r.bad) for r in found) == 14


def test_extended_tables(orders, items, payments):
    facts = extended.order_payment_facts(extended.order_facts(orders, items), payments)
    assert facts.count() == items.count()
    assert rows(facts.where("order_id = 'o1'").select("order_payment_value").distinct(), "order_payment_value") == [
        (Decimal("66.00"),)
    ]
    late = extended.delivery_performance(orders).where("order_status = 'delivered'")
    assert rows(late, "late_count", "on_time_count", "delayed_ratio") == [(0, 1, 0.0), (1, 0, 1.0)]
