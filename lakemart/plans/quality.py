"""The rules every run has to meet: quality, freshness, reconciliation, row counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.contracts import CONTRACTS, EXPECTED_ROWS
from lakemart.functions import clean
from lakemart.operators.checks import (
    TableRules,
    accepted_values,
    check_rules,
    close_values,
    count_rows,
    enforce,
    equal_values,
    measure,
    partition_completeness,
    row_count_drift,
    union_all,
)
from lakemart.operators.joins import unknown_rows


def rules() -> list[TableRules]:
    """48 rules on nine tables: 24 not-null, 10 unique and 14 row conditions."""
    # The names of tables, checks and columns.
    col = F.col
    return [
        TableRules(
            "orders_silver",
            not_null=("order_id", "customer_id", "order_purchase_date"),
            unique=(("order_id",),),
            bad={"order_status_trimmed_lowercase": col("order_status") != clean("order_status", "lower")},
        ),
        TableRules(
            "customers_silver",
            not_null=("customer_id", "customer_unique_id", "customer_state"),
            unique=(("customer_id",),),
            bad={"customer_state_has_len_2": F.length("customer_state") != 2},
        ),
        TableRules(
            "payments_silver",
            not_null=("payment_key", "order_id", "payment_type"),
            unique=(("payment_key",),),
            bad={
                "payment_value_non_negative": col("payment_value") < 0,
                "payment_installments_positive": col("payment_installments") <= 0,
            },
        ),
        TableRules(
            "reviews_silver",
            not_null=("review_id", "order_id", "review_score"),
            unique=(("review_id",),),
            bad={"review_score_between_1_and_5": ~col("review_score").between(1, 5)},
        ),
        TableRules(
            "geolocation_silver",
            not_null=("geolocation_key", "geolocation_zip_code_prefix", "geolocation_state"),
            unique=(("geolocation_key",),),
            bad={"geolocation_state_has_len_2": F.length("geolocation_state") != 2},
        ),
        TableRules("products_silver", not_null=("product_id",), unique=(("product_id",),)),
        TableRules(
            "daily_sales_gold",
            not_null=("order_date",),
            unique=(("order_date",),),
            bad={
                "order_count_positive": col("order_count") <= 0,
                "payment_value_non_negative": col("payment_value") < 0,
                "gross_item_value_non_negative": col("gross_item_value") < 0,
            },
        ),
        TableRules(
            "category_sales_gold",
            not_null=("order_purchase_date", "category_name"),
            unique=(("order_purchase_date", "category_name"),),
            bad={
                "gross_values_non_negative": F.least("gross_item_value", "gross_freight_value") < 0,
                "counts_positive": F.least("order_count", "item_count") <= 0,
            },
        ),
        TableRules(
            "customer_ltv_gold",
            not_null=("customer_id", "customer_unique_id", "order_count", "lifetime_value", "ltv_rank"),
            unique=(("customer_id",), ("ltv_rank",)),
            bad={
                "order_count_positive": col("order_count") <= 0,
                "lifetime_value_non_negative": col("lifetime_value") < 0,
                "first_order_before_last_order": col("first_order_date") > col("last_order_date"),
            },
        ),
    ]


def quality(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All rules on the stored tables: ``table_name, check_name, violations, passed``."""
    return union_all([check_rules(tables[rule.table], rule) for rule in rules()])


def freshness(
    orders: DataFrame, order_items: DataFrame, daily: DataFrame, category: DataFrame, ltv: DataFrame
) -> DataFrame:
    """Newest and oldest dates of the marts against the orders they were built from."""
    newest_daily = "freshness.max_date.orders_vs_daily"
    newest_category = "freshness.max_date.orders_with_items_vs_category"
    newest_ltv = "freshness.max_date.orders_vs_customer_ltv"
    oldest_daily = "freshness.min_date.orders_vs_daily"
    with_items = orders_with_items(orders, order_items)
    return equal_values(
        [
            measure(
                orders,
                {"newest": F.max("order_purchase_date"), "oldest": F.min("order_purchase_date")},
                {
                    "newest": [(newest_daily, "actual"), (newest_ltv, "actual")],
                    "oldest": [(oldest_daily, "actual")],
                },
            ),
            measure(
                with_items,
                {"newest": F.max("order_purchase_date")},
                {"newest": [(newest_category, "actual")]},
            ),
            measure(
                daily,
                {"newest": F.max("order_date"), "oldest": F.min("order_date")},
                {"newest": [(newest_daily, "expected")], "oldest": [(oldest_daily, "expected")]},
            ),
            measure(
                category,
                {"newest": F.max("order_purchase_date")},
                {"newest": [(newest_category, "expected")]},
            ),
            measure(ltv, {"newest": F.max("last_order_date")}, {"newest": [(newest_ltv, "expected")]}),
        ]
    )


def reconcile_counts(
    orders: DataFrame, order_items: DataFrame, daily: DataFrame, category: DataFrame, ltv: DataFrame
) -> DataFrame:
    """Distinct orders and items against the counts the marts add up to."""
    by_day = "reconcile.order_count.orders_vs_daily"
    by_customer = "reconcile.order_count.orders_vs_customer_ltv"
    by_category = "reconcile.item_count.order_items_vs_category"

    def total(column: str):
        return F.coalesce(F.sum(column), F.lit(0)).cast("long")

    return equal_values(
        [
            measure(
                orders.select("order_id").distinct(),
                {"n": F.count("*")},
                {"n": [(by_day, "expected"), (by_customer, "expected")]},
            ),
            measure(
                order_items.select("order_item_key").distinct(),
                {"n": F.count("*")},
                {"n": [(by_category, "expected")]},
            ),
            measure(daily, {"n": total("order_count")}, {"n": [(by_day, "actual")]}),
            measure(ltv, {"n": total("order_count")}, {"n": [(by_customer, "actual")]}),
            measure(category, {"n": total("item_count")}, {"n": [(by_category, "actual")]}),
        ]
    )


def reconcile_values(
    order_items: DataFrame, payments: DataFrame, daily: DataFrame, category: DataFrame, ltv: DataFrame
) -> DataFrame:
    """Money in the marts against money in silver, within a cent."""

    def total(column: str):
        return F.sum(column).cast("decimal(38,2)")

    def name(measured: str, source: str, mart: str) -> str:
        return f"reconcile.{measured}.{source}_vs_{mart}"

    paid_daily = name("payment_value", "payments", "daily")
    paid_ltv = name("payment_value", "payments", "customer_ltv")
    item_daily, item_category = (name("gross_item_value", "order_items", m) for m in ("daily", "category"))
    freight_daily, freight_category = (
        name("gross_freight_value", "order_items", m) for m in ("daily", "category")
    )
    return close_values(
        [
            measure(
                payments,
                {"paid": total("payment_value")},
                {"paid": [(paid_daily, "expected"), (paid_ltv, "expected")]},
            ),
            measure(
                order_items,
                {"items": total("price"), "freight": total("freight_value")},
                {
                    "items": [(item_daily, "expected"), (item_category, "expected")],
                    "freight": [(freight_daily, "expected"), (freight_category, "expected")],
                },
            ),
            measure(
                daily,
                {
                    "paid": total("payment_value"),
                    "items": total("gross_item_value"),
                    "freight": total("gross_freight_value"),
                },
                {
                    "paid": [(paid_daily, "actual")],
                    "items": [(item_daily, "actual")],
                    "freight": [(freight_daily, "actual")],
                },
            ),
            measure(
                category,
                {"items": total("gross_item_value"), "freight": total("gross_freight_value")},
                {"items": [(item_category, "actual")], "freight": [(freight_category, "actual")]},
            ),
            measure(ltv, {"paid": total("lifetime_value")}, {"paid": [(paid_ltv, "actual")]}),
        ]
    )


def row_counts(tables: Mapping[str, DataFrame], expected: DataFrame | Mapping[str, int] = EXPECTED_ROWS) -> DataFrame:
    """Rows of every table against ``expected``, a mapping or a frame ``table_name, expected_rows``."""
    spark = next(iter(tables.values())).sparkSession
    if not isinstance(expected, DataFrame):
        expected = spark.createDataFrame(list(expected.items()), "table_name string, expected_rows long")
    layers = spark.createDataFrame(
        [(contract.name, contract.layer) for contract in CONTRACTS.values()], "table_name string, layer string"
    )
    return (
        count_rows(tables)
        .withColumnRenamed("row_count", "actual_rows")
        .join(expected, "table_name", "left")
        .join(layers, "table_name")
        .withColumn("passed", F.col("actual_rows").eqNullSafe(F.col("expected_rows")))
        .select("layer", "table_name", "actual_rows", "expected_rows", "passed")
    )


def orphan_items(order_items: DataFrame, orders: DataFrame) -> DataFrame:
    """Items whose order does not exist; the value checks hold only when there are none."""
    return unknown_rows(order_items, orders, "order_id")


def orders_with_items(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Orders that have items; the item side is reduced to one row per order before it is shuffled."""
    return orders.join(order_items.select("order_id").distinct(), "order_id", "left_semi")


def gate(
    tables: Mapping[str, DataFrame],
    expected: DataFrame | Mapping[str, int] | None = None,
    *,
    accepted_status: Sequence[str] | None = None,
    every_day: bool = False,
    drift_tolerance: float | None = None,
) -> None:
    """All checks of a finished build, each a hard stop: row counts where expected, quality, freshness, totals.

    The three checks of a table's values and days stop a run only where they are asked for: order statuses
    off the list, days without orders, and a daily number of orders that changes by more than the tolerance.
    """
    orders, items, payments = (tables[f"{n}_silver"] for n in ("orders", "order_items", "payments"))
    marts = [tables[f"{n}_gold"] for n in ("daily_sales", "category_sales", "customer_ltv")]
    if expected is not None:
        enforce(row_counts(tables, expected))
    enforce(quality(tables))
    enforce(freshness(orders, items, *marts))
    enforce(reconcile_counts(orders, items, *marts))
    enforce(reconcile_values(items, payments, *marts))
    day = CONTRACTS["orders_silver"].partition
    if accepted_status is not None:
        enforce(accepted_values(orders, "order_status", accepted_status))
    if every_day:
        enforce(partition_completeness(orders, day))
    if drift_tolerance is not None:
        enforce(row_count_drift(orders, day, drift_tolerance))
