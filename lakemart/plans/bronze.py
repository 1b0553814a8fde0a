"""Raw files to typed bronze tables. Bronze never drops or merges a row."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.contracts import RAW_FILES
from lakemart.functions import clean, composite_key, fingerprint, parse
from lakemart.operators.dedupe import number_equal_rows


def add_ingestion_metadata(
    df: DataFrame,
    *,
    batch_id: str = "manual",
    source_file: str | None = None,
    source_system: str = "csv",
    ingested_at: Column | datetime | str | None = None,
) -> DataFrame:
    """The four ingestion columns; ``ingested_at`` makes a run repeatable, otherwise it is now."""
    loaded = F.current_timestamp() if ingested_at is None else F.lit(ingested_at).cast("timestamp")
    return df.withColumns(
        {
            "_ingested_at": loaded,
            "_batch_id": F.lit(batch_id),
            "_source_file": F.lit(source_file).cast("string"),
            "_source_system": F.lit(source_system),
        }
    )


def read_types(raw: DataFrame, table: str) -> DataFrame:
    """The raw columns of ``table`` in order, read as their types and normalised."""
    spec, schema = RAW_FILES[table], raw.schema
    present = schema.fieldNames()
    missing = [name for name in spec.columns if name not in present]
    if missing:
        raise ValueError(f"{table}: missing columns {missing}")

    def read(name: str) -> Column:
        if name in spec.types:
            return parse(name, spec.types[name], schema[name].dataType)
        text = F.col(name).cast("string")
        return clean(text, spec.styles[name]) if name in spec.styles else text

    extra = [name for name in present if name not in spec.columns]
    return raw.select(*[read(name).alias(name) for name in spec.columns], *extra)


def rejected_values(raw: DataFrame, table: str) -> DataFrame:
    """Per typed column, the number of values present in the raw text that could not be read."""
    schema = raw.schema
    bad = {
        name: F.count_if(F.col(name).isNotNull() & parse(name, kind, schema[name].dataType).isNull())
        for name, kind in RAW_FILES[table].types.items()
    }
    counts = raw.agg(*[count.alias(name) for name, count in bad.items()])
    return counts.unpivot([], list(bad), "column_name", "rejected")


def orders(raw: DataFrame) -> DataFrame:
    return read_types(raw, "orders").withColumn("dt", F.to_date("order_purchase_timestamp"))


def order_items(raw: DataFrame) -> DataFrame:
    return read_types(raw, "order_items").withColumns(
        {
            "order_item_key": composite_key("order_id", "order_item_id"),
            "dt": F.to_date("shipping_limit_date"),
        }
    )


def customers(raw: DataFrame) -> DataFrame:
    return read_types(raw, "customers")


def payments(raw: DataFrame) -> DataFrame:
    return read_types(raw, "payments").withColumn(
        "payment_key", composite_key("order_id", "payment_sequential")
    )


def products(raw: DataFrame) -> DataFrame:
    return read_types(raw, "products")


def sellers(raw: DataFrame) -> DataFrame:
    return read_types(raw, "sellers")


def category_translation(raw: DataFrame) -> DataFrame:
    return read_types(raw, "product_category_translation")


def _with_record_key(raw: DataFrame, table: str, *prefix: str) -> DataFrame:
    """A key for every raw row that stays the same when the file is read again."""
    columns = RAW_FILES[table].columns
    numbered = number_equal_rows(raw.select(*columns), "_ordinal")
    named = [F.coalesce(F.col(name).cast("string"), F.lit("null")) for name in prefix]
    return numbered.withColumn(
        "bronze_record_key", composite_key(*named, fingerprint(*columns), "_ordinal")
    ).drop("_ordinal")


def reviews(raw: DataFrame) -> DataFrame:
    return read_types(_with_record_key(raw, "reviews", "review_id", "order_id"), "reviews")


def geolocation(raw: DataFrame) -> DataFrame:
    place = ("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng")
    keyed = read_types(_with_record_key(raw, "geolocation", *place), "geolocation")
    return keyed.withColumn("geolocation_key", composite_key(*place))


BRONZE = {
    "orders": orders,
    "order_items": order_items,
    "customers": customers,
    "payments": payments,
    "products": products,
    "sellers": sellers,
    "reviews": reviews,
    "geolocation": geolocation,
    "product_category_translation": category_translation,
}
