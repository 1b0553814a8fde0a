"""Look-ups from a fact table into a table with one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is heavy when it holds more than 1/PARTS of the rows, so fewer than PARTS keys are.
PARTS = 10_000


def heavy_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that hold more than a ten-thousandth of the rows, with the ``_salts`` to split each into.

    Each split of a key then holds about a ten-thousandth of the rows. Whatever the data, there are
    fewer than ``PARTS`` such keys and fewer than ``2 * PARTS`` splits of them all together.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    share = F.col("_n") * PARTS / counts.agg(F.sum("_n")).scalar()
    return counts.where(share > 1).select(key, F.ceil(share).cast("int").alias("_salts"))


def lookup_join(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """``fact`` left-joined to ``dimension``, which holds at most one row per ``key``.

    A plain join at every size: Catalyst broadcasts a dimension within the session's threshold, and
    beyond it adaptive execution splits the parts of ``fact`` that a hot key, or NULL, makes large.
    """
    return fact.join(dimension, key, "left")


def salted_lookup_join(fact: DataFrame, dimension: DataFrame, key: str, heavy: DataFrame) -> DataFrame:
    """The rows of ``lookup_join``, with the keys of ``heavy`` split by salts before the shuffle.

    For facts whose hot keys are known to pass what adaptive execution splits. ``heavy`` comes from
    ``heavy_keys``, counted once on the stored key column, and is bounded as stated there. Facts equal
    in all columns but the key meet in one task.
    """
    few = F.broadcast(heavy)
    salts = F.when(F.col(key).isNull(), F.lit(PARTS)).otherwise(F.coalesce("_salts", F.lit(1)))
    # The salt follows from the row (fact rows differ by their record key), so a task that runs again
    # splits its rows the same way.
    row = F.xxhash64(*([name for name in fact.columns if name != key] or [key]))
    salted_fact = fact.join(few, key, "left").withColumn("_salt", F.pmod(row, salts).cast("int")).drop("_salts")
    repeated = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    salted_dimension = dimension.join(few, key, "left").withColumn("_salt", repeated).drop("_salts")
    return salted_fact.join(salted_dimension, [key, "_salt"], "left").drop("_salt")


def known_rows(fact: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``fact`` whose key is in ``keys``."""
    return fact.join(keys.select(key), key, "left_semi")


def unknown_rows(fact: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``fact`` whose key is not in ``keys``; NULL is in no table."""
    return fact.join(keys.select(key), key, "left_anti")
