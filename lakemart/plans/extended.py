"""Further silver joins and marts: facts, enriched views, feed merge, delivery, sellers, reviews, payments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions import sales_month
from lakemart.operators.joins import lookup_join
from lakemart.operators.versions import upsert
from lakemart.plans import bronze, silver

ORDER_COLUMNS = ("order_id", "customer_id", "order_status", "order_purchase_date", "delivery_delay_days")


def order_facts(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """One row per item with the columns of its order."""
    items = order_items.select(
        "order_id", "order_item_key", "product_id", "seller_id", "price", "freight_value"
    )
    return lookup_join(items, orders.select(*ORDER_COLUMNS), "order_id")


def order_payment_facts(facts: DataFrame, payments: DataFrame) -> DataFrame:
    """Item facts with what was paid for the whole order, summed per order first."""
    per_order = payments.groupBy("order_id").agg(
        F.sum("payment_value").alias("order_payment_value"),
        F.count("payment_key").alias("order_payment_count"),
        F.max("payment_installments").alias("max_installments"),
    )
    return lookup_join(facts, per_order, "order_id")


def customer_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    known = customers.select(
        "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"
    )
    return lookup_join(orders.select(*ORDER_COLUMNS), known, "customer_id")


def items_with_category(order_items: DataFrame, products: DataFrame) -> DataFrame:
    """Items with the category of their product."""
    items = order_items.select(
        "order_id", "order_item_key", "product_id", "seller_id", "price", "freight_value"
    )
    label = F.coalesce("product_category_name_english", "product_category_name", F.lit("unknown"))
    return lookup_join(items, products.select("product_id", label.alias("category_name")), "product_id")


def sales_enriched(order_items: DataFrame, products: DataFrame, sellers: DataFrame) -> DataFrame:
    """Items with category and seller place."""
    places = sellers.select("seller_id", "seller_city", "seller_state")
    return lookup_join(items_with_category(order_items, products), places, "seller_id")


def order_reviews(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """One row per review with the columns of its order."""
    written = reviews.select(
        "review_id", "order_id", "review_score", "review_creation_date", "review_answer_timestamp"
    )
    return lookup_join(written, orders.select(*ORDER_COLUMNS), "order_id")


def products_api(feed: DataFrame, translation: DataFrame) -> DataFrame:
    """The product feed in the shape of the products table; its day is its load time."""
    loaded = bronze.add_ingestion_metadata(
        bronze.products(feed),
        batch_id="feed",
        source_file="products.json",
        source_system="api",
        ingested_at=F.col("dt").try_cast("timestamp"),
    )
    return silver.products(silver.products_base(loaded.drop("dt")), translation)


def products_current(products: DataFrame, feed: DataFrame) -> DataFrame:
    """Products with newer rows of the feed merged in by product."""
    return upsert(products, feed, "product_id", "_ingested_at")


def delivery_performance(orders: DataFrame) -> DataFrame:
    """Per purchase date and status: delivered, late and on-time orders, and the late share."""
    delivered = F.col("delivery_delay_days").isNotNull()
    counts = orders.groupBy("order_purchase_date", "order_status").agg(
        F.count("*").alias("order_count"),
        F.count_if(delivered).alias("delivered_count"),
        F.count_if(F.col("delivery_delay_days") > 0).alias("late_count"),
        F.count_if(F.col("delivery_delay_days") <= 0).alias("on_time_count"),
        F.max("delivery_delay_days").alias("max_delay_days"),
    )
    return counts.withColumn(
        "delayed_ratio", F.col("late_count") / F.nullif(F.col("delivered_count"), F.lit(0))
    )


def seller_performance(order_items: DataFrame, sellers: DataFrame) -> DataFrame:
    """Sales per seller; distinct orders are counted by grouping to (seller, order) first."""
    per_order = order_items.groupBy("seller_id", "order_id").agg(
        F.count("order_item_key").alias("items"),
        F.sum("price").alias("item_value"),
        F.sum("freight_value").alias("freight"),
    )
    per_seller = per_order.groupBy("seller_id").agg(
        F.count("order_id").alias("order_count"),
        F.sum("items").alias("item_count"),
        F.sum("item_value").cast("decimal(22,2)").alias("gross_item_value"),
        F.sum("freight").cast("decimal(22,2)").alias("gross_freight_value"),
    )
    return per_seller.join(sellers.select("seller_id", "seller_city", "seller_state"), "seller_id", "left")


def customer_satisfaction(reviews: DataFrame) -> DataFrame:
    """Review scores per month of the review."""
    score = F.col("review_score")
    return reviews.groupBy(sales_month("review_creation_date").alias("review_month")).agg(
        F.count("*").alias("review_count"),
        F.count("review_score").alias("scored_count"),
        (F.sum(score).cast("double") / F.nullif(F.count(score), F.lit(0))).alias("avg_review_score"),
        F.count_if(score <= 2).alias("low_score_count"),
        F.count_if(score >= 4).alias("high_score_count"),
    )


def payment_type_summary(payments: DataFrame) -> DataFrame:
    """Payments, value and instalments per payment type."""
    return payments.groupBy("payment_type").agg(
        F.count("*").alias("payment_count"),
        F.sum("payment_value").alias("payment_value"),
        (F.sum("payment_value").cast("double") / F.count("*")).alias("avg_payment_value"),
        (F.sum("payment_installments").cast("double") / F.count("payment_installments")).alias(
            "avg_installments"
        ),
        F.max("payment_installments").alias("max_installments"),
    )
