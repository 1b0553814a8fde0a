"""Files in and out: raw CSV and JSON, Parquet tables, CSV exports, SQL views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakemart.contracts import RAW_FILES
from lakemart.session import lean


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    *,
    schema: StructType | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """CSV with a header row and doubled quotes; without a schema every column is text.

    Records span one line, so large files are split. ``options`` override the defaults.
    """
    reader = spark.read.options(header="true", quote='"', escape='"', multiLine="false")
    reader = reader.options(**(options or {}))
    if schema is not None:
        # The header must name the columns of the schema: a changed file fails instead of shifting columns.
        reader = reader.schema(schema).option("enforceSchema", "false")
    return reader.csv(path if isinstance(path, str) else list(path))


def read_raw(spark: SparkSession, table: str, path: str | Sequence[str]) -> DataFrame:
    """The raw file of ``table`` as text columns.

    Reviews hold line breaks inside quotes. Such a file cannot be split, so land many files of
    moderate size rather than one; each is one task.
    """
    spec = RAW_FILES[table]
    options = {"multiLine": "true"} if spec.multi_line else {}
    return read_csv(spark, path, schema=spec.schema, options=options)


PRODUCT_FEED_SCHEMA = StructType(
    [StructField(name, StringType()) for name in RAW_FILES["products"].columns]
    + [StructField("dt", StringType())]
)


def read_product_feed(spark: SparkSession, path: str, schema: StructType = PRODUCT_FEED_SCHEMA) -> DataFrame:
    """Product snapshots under ``dt=.../`` folders, one JSON object per line."""
    return spark.read.schema(schema).json(path)


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_parquet(
    df: DataFrame,
    path: str,
    *,
    mode: str = "overwrite",
    partition: str | None = None,
    replace_touched_only: bool = False,
) -> None:
    """Write a table, in ``column=value`` folders when it has a partition column.

    REBALANCE gathers each partition value in few files and splits a value that holds a large share
    of the rows. With ``replace_touched_only`` an overwrite leaves the other partitions as they are.
    """
    with lean(df.sparkSession):
        if partition is None:
            df.write.mode(mode).parquet(path)
            return
        overwrite = "dynamic" if replace_touched_only else "static"
        (
            df.hint("rebalance", F.col(partition))
            .write.mode(mode)
            .option("partitionOverwriteMode", overwrite)
            .partitionBy(partition)
            .parquet(path)
        )


def export_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header. For reports: a row per day or month, or a top list."""
    df.coalesce(1).write.mode("overwrite").option("header", "true").csv(path)


def show_rows(df: DataFrame, n: int = 20) -> None:
    df.show(n, truncate=False)


def register_external_tables(spark: SparkSession, paths: Mapping[str, str]) -> None:
    """Put stored Parquet tables into the session's catalog under their names, with all their partitions."""
    for name, path in paths.items():
        table = spark.catalog.createTable(name, path=path, source="parquet")
        if "PARTITIONED BY" in spark.sql(f"SHOW CREATE TABLE {name}").first()[0]:
            spark.catalog.recoverPartitions(name)


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make tables available to ``spark.sql`` under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
