"""Measures of each load kept as a table, and loads that stand out from those before."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.operators.checks import union_all

NORMAL = 1.4826  # standard deviations of a normal distribution in its median absolute deviation


def load_measures(tables: Mapping[str, DataFrame], day: str) -> DataFrame:
    """day, table_name and row_count of one load; append these rows to the stored measures after it."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(day).cast("date").alias("day"), F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return union_all(counts)


def daily_measures(df: DataFrame, day: str, name: str) -> DataFrame:
    """The same for a table whose loads are told apart by the column ``day``."""
    counted = df.where(F.col(day).isNotNull()).groupBy(F.col(day).alias("day")).agg(F.count("*").alias("row_count"))
    return counted.select("day", F.lit(name).alias("table_name"), "row_count")


def _middle(values: Column) -> Column:
    """The median of an array, the mean of the two in the middle where their number is even."""
    ordered, n = F.array_sort(values), F.size(values)
    low = F.get(ordered, F.floor((n - 1) / 2).cast("int"))
    high = F.get(ordered, F.floor(n / 2).cast("int"))
    return (low + high) / 2


def drift_from_history(
    measures: DataFrame, *, loads: int = 8, fewest: int = 3, width: float = 4.0, least: float = 0.25, rhythm: int = 7
) -> DataFrame:
    """Each load next to the median and spread of up to ``loads`` earlier ones at the same place of the rhythm.

    ``rhythm`` is in days: 7 compares Mondays with Mondays, so that a quiet weekend is not taken for a loss. A load
    fails if it is further from the median than ``width`` usual deviations and than the share ``least`` of the
    median; with fewer than ``fewest`` earlier loads it passes. There is one row per table and load, so the windows
    are small however large the tables are.
    """
    phase = F.pmod(F.datediff("day", F.lit("1970-01-05")), F.lit(rhythm))
    own = Window.partitionBy("table_name", phase).orderBy("day").rowsBetween(-loads, -1)
    earlier = F.collect_list(F.col("row_count").cast("double")).over(own)
    listed = measures.withColumn("_earlier", earlier).withColumn("earlier_loads", F.size("_earlier"))
    usual = listed.withColumn("usual", F.when(F.col("earlier_loads") >= fewest, _middle(F.col("_earlier"))))
    away = F.transform("_earlier", lambda value: F.abs(value - F.col("usual")))
    spread = usual.withColumn("spread", F.when(F.col("usual").isNotNull(), _middle(away) * NORMAL))
    allowed = F.greatest(F.col("spread") * width, F.col("usual") * least)
    passed = F.coalesce(F.abs(F.col("row_count") - F.col("usual")) <= allowed, F.lit(True))
    return spread.withColumn("passed", passed).drop("_earlier")
