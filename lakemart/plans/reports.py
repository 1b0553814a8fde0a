"""Business reports over the three marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.functions import sales_month
from lakemart.operators.checks import count_rows
from lakemart.operators.ranking import top_n_per_group
from lakemart.sources.files import export_csv


def daily_trend(daily: DataFrame) -> DataFrame:
    return daily.select(
        "order_date", "order_count", "item_count", "payment_value", "avg_order_payment_value"
    ).orderBy("order_date")


def monthly_sales(daily: DataFrame, *, with_average: bool = True) -> DataFrame:
    """Sales per month; the average is the plain mean of the daily averages."""
    measures = [
        F.sum("order_count").alias("order_count"),
        F.sum("item_count").alias("item_count"),
        F.sum("payment_value").alias("total_payment_value"),
    ]
    if with_average:
        mean = F.avg("avg_order_payment_value").cast("decimal(26,6)")
        measures.append(mean.alias("avg_daily_order_payment_value"))
    return daily.groupBy(sales_month("order_date").alias("sales_month")).agg(*measures).orderBy("sales_month")


def top_categories_by_value(category: DataFrame, n: int = 15) -> DataFrame:
    return (
        category.groupBy("category_name")
        .agg(
            F.sum("order_count").alias("order_count"),
            F.sum("item_count").alias("item_count"),
            F.round(F.sum("gross_item_value"), 2).alias("gross_item_value"),
            F.round(F.sum("gross_freight_value"), 2).alias("gross_freight_value"),
        )
        .orderBy(F.desc("gross_item_value"), "category_name")
        .limit(n)
    )


def top_categories_by_orders(category: DataFrame, n: int = 15) -> DataFrame:
    """An order with items of two categories counts in both."""
    return (
        category.groupBy("category_name")
        .agg(
            F.sum("order_count").alias("order_count"),
            F.round(F.sum("gross_item_value"), 2).alias("gross_item_value"),
        )
        .orderBy(F.desc("order_count"), "category_name")
        .limit(n)
    )


def best_customers(customers: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` customers by lifetime value, from the mart or from its rows before ranking.

    Within the first ``n`` the rank is the place, so a frame without ``ltv_rank`` needs no ranking of
    all customers.
    """
    best_first = [F.desc("lifetime_value"), F.asc("customer_id")]
    best = customers.orderBy(*best_first).limit(n)
    if "ltv_rank" not in customers.columns:
        best = best.withColumn("ltv_rank", F.row_number().over(Window.orderBy(*best_first)))
    return best.orderBy("ltv_rank")


def top_customers(customers: DataFrame, n: int = 20) -> DataFrame:
    return best_customers(customers, n).select(
        "customer_id",
        "customer_unique_id",
        "customer_city",
        "customer_state",
        "order_count",
        F.round("lifetime_value", 2).alias("lifetime_value"),
        F.round("avg_order_value", 2).alias("avg_order_value"),
        "first_order_date",
        "last_order_date",
        "ltv_rank",
    )


def top_states(customers: DataFrame, n: int = 15) -> DataFrame:
    mean = F.avg("avg_order_value").cast("decimal(38,8)")
    return (
        customers.groupBy("customer_state")
        .agg(
            F.count("*").alias("customer_count"),
            F.sum("order_count").alias("order_count"),
            F.round(F.sum("lifetime_value"), 2).alias("lifetime_value"),
            F.round(mean, 2).alias("avg_order_value"),
        )
        .orderBy(F.desc("lifetime_value"), "customer_state")
        .limit(n)
    )


def monthly_category_leaders(category: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` categories with the greatest item value in each month."""
    per_month = category.groupBy(
        sales_month("order_purchase_date").alias("sales_month"), "category_name"
    ).agg(F.sum("gross_item_value").alias("value"))
    leaders = top_n_per_group(
        per_month, ["sales_month"], [F.desc("value"), F.asc("category_name")], n, "category_rank"
    )
    return leaders.orderBy("sales_month", "category_rank").select(
        "sales_month", "category_name", F.round("value", 2).alias("gross_item_value")
    )


def freight_efficiency(daily: DataFrame) -> DataFrame:
    """Payments less freight, and freight as a share of payments; no share where nothing was paid."""
    share = F.col("gross_freight_value") / F.nullif(F.col("payment_value"), F.lit(0))
    return daily.select(
        "order_date",
        "payment_value",
        "gross_item_value",
        "gross_freight_value",
        F.round(F.col("payment_value") - F.col("gross_freight_value"), 2).alias("payment_minus_freight"),
        F.round(share, 4).alias("freight_ratio"),
    ).orderBy("order_date")


def gold_counts(daily: DataFrame, category: DataFrame, ltv: DataFrame) -> DataFrame:
    return count_rows(
        {"daily_sales_gold": daily, "category_sales_gold": category, "customer_ltv_gold": ltv}
    )


def latest_daily(daily: DataFrame, n: int = 10) -> DataFrame:
    return daily.orderBy(F.desc("order_date")).limit(n)


def latest_categories(category: DataFrame, n: int = 10) -> DataFrame:
    return category.orderBy(F.desc("order_purchase_date"), F.desc("gross_item_value"), "category_name").limit(n)


def export_reports(daily: DataFrame, category: DataFrame, customers: DataFrame, folder: str) -> None:
    """Four reports as CSV files with a header, one folder each."""
    categories = top_categories_by_value(category).drop("gross_freight_value")
    exports = {
        "daily_sales_trend": daily_trend(daily),
        "monthly_sales_summary": monthly_sales(daily, with_average=False),
        "top_categories_by_revenue": categories,
        "top_customers_by_ltv": top_customers(customers),
    }
    for name, report in exports.items():
        export_csv(report, f"{folder.rstrip('/')}/{name}")
