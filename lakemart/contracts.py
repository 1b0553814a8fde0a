"""Table contracts: what each table is keyed, ordered and partitioned by, and how raw columns are read."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import StringType, StructField, StructType

METADATA_COLUMNS = ("_ingested_at", "_batch_id", "_source_file", "_source_system")


@dataclass(frozen=True)
class TableContract:
    """One row per ``key``; of several rows with one key the one with the greatest ``ordering`` is kept."""

    name: str
    layer: str
    key: str
    ordering: str
    partition: str | None = None


@dataclass(frozen=True)
class RawFile:
    """A raw file: its columns in order (all text), the types to read and the values to normalise."""

    columns: tuple[str, ...]
    types: dict[str, str] = field(default_factory=dict)
    styles: dict[str, str] = field(default_factory=dict)
    multi_line: bool = False

    @property
    def schema(self) -> StructType:
        return StructType([StructField(name, StringType()) for name in self.columns])


PRODUCT_NUMBERS = (
    "product_name_lenght",
    "product_description_lenght",
    "product_photos_qty",
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
)

# Column names of the raw files, in file order, the types they hold and their letter case.
RAW_FILES = {
    "orders": RawFile(
        columns=(
            "order_id",
            "customer_id",
            "order_status",
            "order_purchase_timestamp",
            "order_approved_at",
            "order_delivered_carrier_date",
            "order_delivered_customer_date",
            "order_estimated_delivery_date",
        ),
        types=dict.fromkeys(
            (
                "order_purchase_timestamp",
                "order_approved_at",
                "order_delivered_carrier_date",
                "order_delivered_customer_date",
                "order_estimated_delivery_date",
            ),
            "timestamp",
        ),
        styles={"order_status": "lower"},
    ),
    "order_items": RawFile(
        columns=(
            "order_id",
            "order_item_id",
            "product_id",
            "seller_id",
            "shipping_limit_date",
            "price",
            "freight_value",
        ),
        types={
            "order_item_id": "int",
            "shipping_limit_date": "timestamp",
            "price": "decimal(12,2)",
            "freight_value": "decimal(12,2)",
        },
    ),
    "customers": RawFile(
        columns=(
            "customer_id",
            "customer_unique_id",
            "customer_zip_code_prefix",
            "customer_city",
            "customer_state",
        ),
        styles={"customer_city": "title", "customer_state": "upper"},
    ),
    "payments": RawFile(
        columns=("order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"),
        types={
            "payment_sequential": "int",
            "payment_installments": "int",
            "payment_value": "decimal(12,2)",
        },
        styles={"payment_type": "lower"},
    ),
    "products": RawFile(
        columns=("product_id", "product_category_name", *PRODUCT_NUMBERS),
        types=dict.fromkeys(PRODUCT_NUMBERS, "int"),
        styles={"product_category_name": "lower"},
    ),
    "sellers": RawFile(
        columns=("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"),
        styles={"seller_city": "title", "seller_state": "upper"},
    ),
    "reviews": RawFile(
        columns=(
            "review_id",
            "order_id",
            "review_score",
            "review_comment_title",
            "review_comment_message",
            "review_creation_date",
            "review_answer_timestamp",
        ),
        types={
            "review_score": "int",
            "review_creation_date": "timestamp",
            "review_answer_timestamp": "timestamp",
        },
        multi_line=True,
    ),
    "geolocation": RawFile(
        columns=(
            "geolocation_zip_code_prefix",
            "geolocation_lat",
            "geolocation_lng",
            "geolocation_city",
            "geolocation_state",
        ),
        types={"geolocation_lat": "double", "geolocation_lng": "double"},
        styles={"geolocation_city": "title", "geolocation_state": "upper"},
    ),
    "product_category_translation": RawFile(
        columns=("product_category_name", "product_category_name_english"),
        styles={"product_category_name": "lower", "product_category_name_english": "lower"},
    ),
}

# Record key, ordering and partition column of the 22 tables.
CONTRACTS = {
    contract.name: contract
    for contract in (
        TableContract("orders_bronze", "bronze", "order_id", "order_purchase_timestamp", "dt"),
        TableContract("order_items_bronze", "bronze", "order_item_key", "shipping_limit_date", "dt"),
        TableContract("customers_bronze", "bronze", "customer_id", "_ingested_at"),
        TableContract("payments_bronze", "bronze", "payment_key", "_ingested_at"),
        TableContract("products_bronze", "bronze", "product_id", "_ingested_at"),
        TableContract("sellers_bronze", "bronze", "seller_id", "_ingested_at"),
        TableContract("reviews_bronze", "bronze", "bronze_record_key", "review_answer_timestamp"),
        TableContract("geolocation_bronze", "bronze", "bronze_record_key", "_ingested_at"),
        TableContract("product_category_translation_bronze", "bronze", "product_category_name", "_ingested_at"),
        TableContract("orders_silver", "silver", "order_id", "order_purchase_timestamp", "order_purchase_date"),
        TableContract("order_items_silver", "silver", "order_item_key", "shipping_limit_date", "dt"),
        TableContract("customers_silver", "silver", "customer_id", "_ingested_at"),
        TableContract("payments_silver", "silver", "payment_key", "_ingested_at"),
        TableContract("products_silver_base", "silver", "product_id", "_ingested_at"),
        TableContract("products_silver", "silver", "product_id", "_ingested_at"),
        TableContract("sellers_silver", "silver", "seller_id", "_ingested_at"),
        TableContract("reviews_silver", "silver", "review_id", "review_answer_timestamp"),
        TableContract("geolocation_silver", "silver", "geolocation_key", "_ingested_at"),
        TableContract("product_category_translation_silver", "silver", "product_category_name", "_ingested_at"),
        TableContract("daily_sales_gold", "gold", "gold_key", "order_date", "order_date"),
        TableContract("category_sales_gold", "gold", "gold_key", "order_purchase_date", "order_purchase_date"),
        TableContract("customer_ltv_gold", "gold", "customer_id", "last_order_date"),
    )
}

# Row counts of the 22 tables on the public e-commerce extracts.
EXPECTED_ROWS = {
    "orders_bronze": 99441,
    "order_items_bronze": 112650,
    "customers_bronze": 99441,
    "payments_bronze": 103886,
    "products_bronze": 32951,
    "sellers_bronze": 3095,
    "reviews_bronze": 99224,
    "geolocation_bronze": 1000163,
    "product_category_translation_bronze": 71,
    "orders_silver": 99441,
    "order_items_silver": 112650,
    "customers_silver": 99441,
    "payments_silver": 103886,
    "products_silver_base": 32951,
    "sellers_silver": 3095,
    "reviews_silver": 98410,
    "geolocation_silver": 720154,
    "product_category_translation_silver": 71,
    "products_silver": 32951,
    "daily_sales_gold": 634,
    "category_sales_gold": 18990,
    "customer_ltv_gold": 99441,
}
