"""The star-schema test tables read as raw e-commerce extracts.

Every frame has the raw columns of its contract, derived from whole tables. Values keep their source
types unless ``as_text`` asks for what a CSV file would hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakemart.contracts import RAW_FILES
from lakemart.plans.bronze import BRONZE, add_ingestion_metadata

LOADED_AT = "2024-01-01 00:00:00"


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A test table; its schema is read from the file once."""
    path = f"{folder.rstrip('/')}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _text(name: str):
    return F.col(name).cast("string")


def _days_after(column: str, days: str):
    return F.expr(f"{column} + make_dt_interval(CAST({days} AS INT))")


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    """Open orders are not delivered; the others come up to 30 days late or early."""
    delivered = _days_after("o_orderdate", "o_custkey % 30")
    return table(spark, folder, "orders").select(
        _text("o_orderkey").alias("order_id"),
        _text("o_custkey").alias("customer_id"),
        F.concat(F.lit(" "), "o_orderstatus", F.lit(" ")).alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        _days_after("o_orderdate", "1").alias("order_approved_at"),
        _days_after("o_orderdate", "2").alias("order_delivered_carrier_date"),
        F.when(F.col("o_orderstatus") != "O", delivered).alias("order_delivered_customer_date"),
        _days_after("o_orderdate", "o_orderkey % 20").alias("order_estimated_delivery_date"),
    )


def _order_items(spark: SparkSession, folder: str) -> DataFrame:
    """Order and line repeat in the source, so items have several versions by ship date."""
    freight = F.col("l_extendedprice").cast("decimal(12,2)") * F.col("l_tax").cast("decimal(4,2)")
    return table(spark, folder, "lineitem").select(
        _text("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        _text("l_partkey").alias("product_id"),
        _text("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        F.round(freight, 2).alias("freight_value"),
    )


def _payments(spark: SparkSession, folder: str) -> DataFrame:
    """Every third order is paid in two parts, the second of 100."""
    total = F.col("o_totalprice").cast("decimal(12,2)")
    second = F.lit("100.00").cast("decimal(12,2)")

    def part(number: int, value):
        return F.struct(F.lit(number).alias("number"), value.cast("decimal(12,2)").alias("value"))

    parts = F.when(
        F.col("o_orderkey") % 3 == 0, F.array(part(1, total - second), part(2, second))
    ).otherwise(F.array(part(1, total)))
    return (
        table(spark, folder, "orders")
        .withColumn("part", F.explode(parts))
        .select(
            _text("o_orderkey").alias("order_id"),
            F.col("part.number").alias("payment_sequential"),
            F.concat("o_orderpriority", F.lit(" ")).alias("payment_type"),
            (F.col("o_orderkey") % 7).alias("payment_installments"),
            F.col("part.value").alias("payment_value"),
        )
    )


def _places(spark: SparkSession, folder: str) -> DataFrame:
    regions = table(spark, folder, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return (
        table(spark, folder, "nation")
        .join(regions, "n_regionkey")
        .select(
            "n_nationkey",
            F.col("n_name").alias("city"),
            F.lower(F.substring("r_name", 1, 2)).alias("state"),
        )
    )


def _zip(key: str):
    return F.lpad((F.col(key) % 1000).cast("string"), 5, "0")


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    placed = table(spark, folder, "customer").withColumnRenamed("c_nationkey", "n_nationkey")
    return placed.join(_places(spark, folder), "n_nationkey", "left").select(
        _text("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        _zip("c_custkey").alias("customer_zip_code_prefix"),
        F.col("city").alias("customer_city"),
        F.col("state").alias("customer_state"),
    )


def _sellers(spark: SparkSession, folder: str) -> DataFrame:
    placed = table(spark, folder, "supplier").withColumnRenamed("s_nationkey", "n_nationkey")
    return placed.join(_places(spark, folder), "n_nationkey", "left").select(
        _text("s_suppkey").alias("seller_id"),
        _zip("s_suppkey").alias("seller_zip_code_prefix"),
        F.col("city").alias("seller_city"),
        F.col("state").alias("seller_state"),
    )


def _products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        _text("p_partkey").alias("product_id"),
        F.col("p_type").alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        F.length("p_type").alias("product_description_lenght"),
        F.expr("nullif(p_size % 5, 0)").alias("product_photos_qty"),
        (F.col("p_size") * 100).alias("product_weight_g"),
        F.col("p_size").alias("product_length_cm"),
        F.col("p_size").alias("product_height_cm"),
        F.expr("nullif(p_size % 3, 0)").alias("product_width_cm"),
    )


def _translation(spark: SparkSession, folder: str) -> DataFrame:
    """Category names as the parts repeat them; one category has no English name."""
    return (
        table(spark, folder, "part")
        .where("p_type <> 'PROMO'")
        .select(
            F.col("p_type").alias("product_category_name"),
            F.concat("p_type", F.lit(" Goods ")).alias("product_category_name_english"),
        )
    )


def _reviews(spark: SparkSession, folder: str) -> DataFrame:
    """A review is known by its text, so copies of a text are versions of one review."""
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    created = F.date_add(F.lit("2017-01-01").cast("date"), (F.col("doc_id") % 1000).cast("int"))
    return (
        table(spark, folder, "documents")
        .join(labels, "doc_id", "left")
        .select(
            F.md5("text").alias("review_id"),
            _text("doc_id").alias("order_id"),
            (1 + 4 * F.col("quality")).alias("review_score"),
            F.concat(F.lit(" "), "lang").alias("review_comment_title"),
            F.col("text").alias("review_comment_message"),
            created.cast("timestamp_ntz").alias("review_creation_date"),
            F.date_add(created, (F.col("n_chars") % 10).cast("int"))
            .cast("timestamp_ntz")
            .alias("review_answer_timestamp"),
        )
    )


def _geolocation(spark: SparkSession, folder: str) -> DataFrame:
    """Customers of one nation and zip share a place, so equal rows occur."""
    placed = table(spark, folder, "customer").withColumnRenamed("c_nationkey", "n_nationkey")
    return placed.join(_places(spark, folder), "n_nationkey", "left").select(
        _zip("c_custkey").alias("geolocation_zip_code_prefix"),
        (F.col("n_nationkey") * 3.0 - 36.0 + 0.25).cast("double").alias("geolocation_lat"),
        (F.col("n_nationkey") * -1.5 - 0.5).cast("double").alias("geolocation_lng"),
        F.col("city").alias("geolocation_city"),
        F.col("state").alias("geolocation_state"),
    )


_RAW = {
    "orders": _orders,
    "order_items": _order_items,
    "customers": _customers,
    "payments": _payments,
    "products": _products,
    "sellers": _sellers,
    "reviews": _reviews,
    "geolocation": _geolocation,
    "product_category_translation": _translation,
}


def raw(spark: SparkSession, folder: str, name: str, *, as_text: bool = False) -> DataFrame:
    df = _RAW[name](spark, folder)
    return df.select(*[_text(c).alias(c) for c in RAW_FILES[name].columns]) if as_text else df


def bronze(spark: SparkSession, folder: str, name: str, *, as_text: bool = False) -> DataFrame:
    """The bronze table of ``name`` with fixed ingestion metadata."""
    typed = BRONZE[name](raw(spark, folder, name, as_text=as_text))
    return add_ingestion_metadata(
        typed, batch_id="batch-1", source_file=f"{name}.csv", ingested_at=LOADED_AT
    )


def product_feed(spark: SparkSession, folder: str) -> DataFrame:
    """A later snapshot of the promoted parts, one centimetre longer, as text with its day."""
    feed = _products(spark, folder).where("product_category_name = 'PROMO'")
    longer = feed.withColumn("product_length_cm", F.col("product_length_cm") + 1)
    return longer.select(*[_text(c).alias(c) for c in RAW_FILES["products"].columns]).withColumn(
        "dt", F.lit("2024-02-01")
    )


def event_log(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a change log: the newest event is a user's state, each day is a commit."""
    return table(spark, folder, "events").select(
        "user_id",
        "ts",
        "event_id",
        "event_type",
        "value",
        "props",
        F.date_format("ts", "yyyyMMdd").alias("_commit_time"),
    )
