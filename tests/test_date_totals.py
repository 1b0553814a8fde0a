"""Both date marts from one pass over the items."""

import pytest

from lakemart.plans import catalog, gold
from tests.compare import rows

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def shuffled(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def facts(spark):
    """Orders without a date, an id, items or payments; items of no known order; a missing price."""
    orders = spark.sql(
        "select * from values ('a', date'2024-01-01'), ('b', date'2024-01-01'), ('c', cast(null as date)), "
        "('d', date'2024-01-02'), (null, date'2024-01-03'), ('f', date'2024-01-04') t(order_id, order_purchase_date)"
    )
    items = spark.sql(
        "select order_id, order_item_key, product_id, cast(price as decimal(12,2)) price, "
        "cast(price as decimal(12,2)) / 10 freight from values ('a', 'a_1', 'p', 10), ('a', 'a_2', 'q', 5), "
        "('a', 'a_3', 'p', 1), ('b', 'b_1', 'p', 2), ('c', 'c_1', 'q', 3), ('x', 'x_1', 'p', 7), (null, null, 'q', 9), "
        "('d', 'd_1', null, null) t(order_id, order_item_key, product_id, price)"
    ).selectExpr("* except(freight)", "cast(freight as decimal(12,2)) freight_value")
    payments = spark.sql(
        "select order_id, cast(v as decimal(12,2)) payment_value from values ('a', 16), ('a', 4), ('c', 3), (null, 8) t(order_id, v)"
    )
    products = spark.sql("select 'p' product_id, 'C' product_category_name, cast(null as string) product_category_name_english")
    return orders, items, payments, products


def test_daily_sales_are_the_totals_of_the_categories(facts):
    orders, items, payments, products = facts
    totals = gold.date_category_totals(items, products, orders)
    found, expected = gold.daily_from_totals(orders, payments, totals), gold.daily_sales(orders, items, payments)
    assert found.dtypes == expected.dtypes
    assert rows(found, *expected.columns) == rows(expected, *expected.columns)


def test_category_sales_put_undated_and_unknown_orders_together(facts):
    orders, items, _, products = facts
    found = gold.category_sales(items, products, orders).where("order_purchase_date is null")
    assert rows(found, "category_name", "order_count", "item_count", "gross_item_value") == [
        ("C", 1, 1, 7), ("unknown", 1, 1, 12)
    ]


def test_items_are_shuffled_by_order_once(facts, shuffled):
    orders, items, _, products = facts
    text = gold.category_sales(items, products, orders)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning(order_id") == 2  # items and orders
    assert "hashpartitioning(order_id#" in text and ", category_name#" not in text.split("hashpartitioning(order_id#")[1][:30]


def test_quality_reads_the_items_once_and_stores_none(spark, monkeypatch):
    kept = []
    plain = catalog.stored
    monkeypatch.setattr(catalog, "stored", lambda df, name: kept.append(name) or plain(df, name))
    found = catalog.check_quality(spark, FOLDER)
    assert sorted(kept) == ["date_category_totals", "orders_silver", "payments_silver"]
    assert "lineitem.parquet" not in found._jdf.queryExecution().executedPlan().toString()
