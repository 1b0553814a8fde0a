"""Ranking over whole tables and within groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.session import stored

# monotonically_increasing_id puts the partition above these bits and the row's place below them.
_PLACE_BITS = 33


def global_row_number(df: DataFrame, order: Sequence[Column], rank: str = "rank") -> DataFrame:
    """``df`` with its row number 1..n in ``order``, without bringing the rows into one partition.

    The rows are range-partitioned and sorted once (Spark samples the whole sort key, so ties on its
    first column spread as well), which fixes each row's place in its partition. The result is stored
    so that both readers see the same places; the rank is the place plus the sizes of the partitions
    before, one small row per partition. ``order`` has to be unique.
    """
    placed = stored(df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()), "ranked")
    partition = F.shiftright("_place", _PLACE_BITS)
    sizes = placed.groupBy(partition.alias("_partition")).agg(F.count("*").alias("_size"))
    # One row per shuffle partition, so this window and the broadcast stay small at any data size.
    before = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_partition", F.coalesce(F.sum("_size").over(before), F.lit(0).cast("long")).alias("_before")
    )
    place = F.col("_place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return (
        placed.withColumn("_partition", partition)
        .join(F.broadcast(offsets), "_partition")
        .withColumn(rank, F.col("_before") + place + 1)
        .drop("_partition", "_place", "_before")
    )


def top_n_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """The first ``n`` rows of each group with their rank; the limit also runs before the shuffle."""
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)
