"""Bronze tables to one trusted row per business key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.contracts import CONTRACTS, PRODUCT_NUMBERS, RAW_FILES
from lakemart.functions import clean
from lakemart.operators.dedupe import latest_per_key
from lakemart.operators.joins import lookup_join


def _conform(bronze: DataFrame, table: str) -> DataFrame:
    """The normalised values of ``table`` again, for bronze rows that came from elsewhere."""
    styles = RAW_FILES[table].styles
    return bronze.withColumns({name: clean(name, style) for name, style in styles.items()}) if styles else bronze


def _latest(df: DataFrame, table: str, keyed: bool = False) -> DataFrame:
    """The newest row per key; ``keyed`` rows hold every key of the table once already and are left as they are."""
    contract = CONTRACTS[table]
    return df if keyed else latest_per_key(df, contract.key, contract.ordering)


def orders(bronze: DataFrame, *, keyed: bool = False) -> DataFrame:
    """``delivery_delay_days`` counts calendar days, positive when the order came late."""
    return _latest(_conform(bronze, "orders"), "orders_silver", keyed).withColumns(
        {
            "order_purchase_date": F.to_date("order_purchase_timestamp"),
            "delivery_delay_days": F.datediff("order_delivered_customer_date", "order_estimated_delivery_date"),
        }
    )


def order_items(bronze: DataFrame, *, keyed: bool = False) -> DataFrame:
    typed = bronze.withColumns(
        {
            "price": F.col("price").try_cast("decimal(12,2)"),
            "freight_value": F.col("freight_value").try_cast("decimal(12,2)"),
            "shipping_limit_date": F.col("shipping_limit_date").try_cast("timestamp"),
        }
    )
    return _latest(typed, "order_items_silver", keyed)


def customers(bronze: DataFrame, *, keyed: bool = False) -> DataFrame:
    return _latest(_conform(bronze, "customers"), "customers_silver", keyed)


def all_payments(bronze: DataFrame, *, keyed: bool = False) -> DataFrame:
    """The newest row of every payment, valid or not; instalments below 1 count as 1."""
    at_least_one = F.when(F.col("payment_installments") < 1, 1).otherwise(F.col("payment_installments"))
    conformed = _conform(bronze, "payments").withColumn("payment_installments", at_least_one)
    return _latest(conformed, "payments_silver", keyed)


def payments(bronze: DataFrame, *, keyed: bool = False) -> DataFrame:
    """A payment whose newest row has no value of at least 0 is left out."""
    return all_payments(bronze, keyed=keyed).where(F.col("payment_value") >= 0)


def products_base(bronze: DataFrame, *, keyed: bool = False) -> DataFrame:
    return _latest(_conform(bronze, "products"), "products_silver_base", keyed).fillna(0, list(PRODUCT_NUMBERS))


def category_translation(bronze: DataFrame) -> DataFrame:
    """Names are normalised before the dedupe, so that two spellings of a name become one row."""
    return _latest(
        _conform(bronze, "product_category_translation"), "product_category_translation_silver"
    )


def products(base: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with the English category name, or the source name where there is no translation."""
    names = translation.select("product_category_name", "product_category_name_english")
    joined = lookup_join(base, names, "product_category_name")
    english = F.coalesce("product_category_name_english", "product_category_name")
    return joined.withColumn("product_category_name_english", english)


def sellers(bronze: DataFrame, *, keyed: bool = False) -> DataFrame:
    return _latest(_conform(bronze, "sellers"), "sellers_silver", keyed)


def reviews(bronze: DataFrame) -> DataFrame:
    trimmed = {
        name: clean(name, "trim") for name in ("review_comment_title", "review_comment_message")
    }
    typed = bronze.withColumns({"review_score": F.col("review_score").try_cast("int"), **trimmed})
    return _latest(typed, "reviews_silver")


def geolocation(bronze: DataFrame) -> DataFrame:
    return _latest(_conform(bronze, "geolocation"), "geolocation_silver")


# Silver tables made from one bronze table each; products joins two silver tables.
SILVER = {
    "orders_silver": (orders, "orders_bronze"),
    "order_items_silver": (order_items, "order_items_bronze"),
    "customers_silver": (customers, "customers_bronze"),
    "payments_silver": (payments, "payments_bronze"),
    "products_silver_base": (products_base, "products_bronze"),
    "sellers_silver": (sellers, "sellers_bronze"),
    "reviews_silver": (reviews, "reviews_bronze"),
    "geolocation_silver": (geolocation, "geolocation_bronze"),
    "product_category_translation_silver": (category_translation, "product_category_translation_bronze"),
}


def sources(name: str) -> tuple[str, ...]:
    """The tables the silver table ``name`` is made from."""
    if name == "products_silver":
        return "products_silver_base", "product_category_translation_silver"
    return (SILVER[name][1],)


# Tables whose key is that of their bronze table, value for value: rows of a versioned bronze table, which holds
# every key once, need no second dedupe. The others have a key of their own or normalise it.
SAME_KEY = frozenset(
    ("orders_silver", "order_items_silver", "customers_silver", "payments_silver", "products_silver_base", "sellers_silver")
)


def make(name: str, bronze: DataFrame, *, keyed: bool = False) -> DataFrame:
    """The silver table ``name``; ``keyed`` tells that ``bronze`` holds every key of its contract once."""
    build, _ = SILVER[name]
    return build(bronze, keyed=True) if keyed and name in SAME_KEY else build(bronze)
