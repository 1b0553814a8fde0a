"""One row per key, and stable numbers for rows that are equal in every column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_first(df: DataFrame, key: Sequence[str], ordering: Sequence[str | Column]) -> list[Column]:
    """A total order for the rows of one key: ``ordering`` descending, then every other column.

    Two rows that still tie are equal in every column, so the survivor never depends on partitioning.
    """
    named = {name for name in ordering if isinstance(name, str)}
    rest = [name for name in df.columns if name not in named and name not in key]
    leading = [F.desc_nulls_last(name) if isinstance(name, str) else name for name in ordering]
    return leading + [F.desc_nulls_last(name) for name in rest]


def latest_per_key(df: DataFrame, key: str | Sequence[str], ordering: str | Sequence[str | Column]) -> DataFrame:
    """The newest row of every key; rows with a NULL key count as one key.

    The rank filter becomes a group limit that runs before the shuffle as well, so each task sends at
    most one row of a key on: a key that holds a third of the rows is no hot spot.
    """
    keys = [key] if isinstance(key, str) else list(key)
    orders = [ordering] if isinstance(ordering, str | Column) else list(ordering)
    window = Window.partitionBy(*keys).orderBy(*newest_first(df, keys, orders))
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") == 1).drop("_rank")


def number_equal_rows(df: DataFrame, ordinal: str, *, chunk: int = 100_000) -> DataFrame:
    """Every row of ``df`` with a number 1..n inside the group of rows equal to it.

    Equal rows are interchangeable, so they are counted (combined before the shuffle) and written out
    again from the count. Groups of more than ``chunk`` copies are spread over the cluster in chunks.
    """
    counted = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    step = F.lit(chunk).cast("long")
    numbered = [*df.columns, ordinal]

    few = counted.where(F.col("_copies") <= step).withColumn(
        ordinal, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))
    )
    # A fixed partition count: adaptive execution would merge these few small rows into one task.
    spread = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = (
        counted.where(F.col("_copies") > step)
        .withColumn("_start", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"), step)))
        .repartition(spread, "_start")
        .withColumn(
            ordinal,
            F.explode(F.sequence(F.col("_start"), F.least(F.col("_start") + step - 1, F.col("_copies")))),
        )
    )
    return few.select(*numbered).unionByName(many.select(*numbered))
