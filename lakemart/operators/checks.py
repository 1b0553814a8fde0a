"""Checks as DataFrames: one row per check with what was found and whether it passed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class ChecksFailed(Exception):
    """Raised by ``enforce`` with the names of all failed checks."""


@dataclass(frozen=True)
class TableRules:
    """Rules for one table. ``bad`` maps a check name to a predicate no row may satisfy; NULL passes."""

    table: str
    unique: tuple[tuple[str, ...], ...]
    not_null: tuple[str, ...] = ()
    bad: Mapping[str, Column] = field(default_factory=dict)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def as_rows(df: DataFrame, rows: Sequence[Mapping[str, Column]]) -> DataFrame:
    """A frame of one row turned into one row per entry of ``rows``."""
    structs = [F.struct(*[value.alias(name) for name, value in row.items()]) for row in rows]
    return df.select(F.inline(F.array(*structs)))


def _repeats(count: Column) -> Column:
    return F.coalesce(F.sum(count - 1), F.lit(0).cast("long"))


def check_rules(df: DataFrame, rules: TableRules) -> DataFrame:
    """``table_name, check_name, violations, passed`` of one table.

    The row rules are counted together with the rows of the first unique key, so the table is read
    once, combined before the shuffle, and not shuffled at all where it is already kept by that key.
    Every further unique key is a pass of its own over the key. NULL counts as a key.
    """
    found = {f"not_null.{name}": F.col(name).isNull() for name in rules.not_null} | dict(rules.bad)
    violations = [F.count_if(bad).alias(f"r{i}") for i, bad in enumerate(found.values())]
    names = {f"r{i}": name for i, name in enumerate(found)}
    first, *others = rules.unique
    per_key = df.groupBy(*first).agg(F.count("*").alias("n"), *violations)
    totals = per_key.agg(
        _repeats(F.col("n")).alias("repeats"),
        *[F.coalesce(F.sum(column), F.lit(0).cast("long")).alias(column) for column in names],
    )
    names["repeats"] = "unique." + ",".join(first)
    parts = [
        as_rows(totals, [{"check_name": F.lit(n), "violations": F.col(c)} for c, n in names.items()])
    ]
    for columns in others:
        counted = df.groupBy(*columns).agg(F.count("*").alias("n"))
        parts.append(
            counted.agg(_repeats(F.col("n")).alias("violations")).select(
                F.lit("unique." + ",".join(columns)).alias("check_name"), "violations"
            )
        )
    return union_all(parts).select(
        F.lit(rules.table).alias("table_name"),
        "check_name",
        "violations",
        (F.col("violations") == 0).alias("passed"),
    )


def side_by_side(measures: Sequence[DataFrame]) -> DataFrame:
    """``check_name, role, value`` rows of several tables to ``check_name, actual, expected``."""
    return (
        union_all(measures)
        .groupBy("check_name")
        .agg(
            F.max(F.when(F.col("role") == "actual", F.col("value"))).alias("actual"),
            F.max(F.when(F.col("role") == "expected", F.col("value"))).alias("expected"),
        )
    )


def measure(df: DataFrame, aggregate: Mapping[str, Column], used: Mapping[str, Sequence[tuple[str, str]]]) -> DataFrame:
    """All measures of one table in one pass, each as the actual or expected side of its checks."""
    one_row = df.agg(*[value.alias(name) for name, value in aggregate.items()])
    return as_rows(
        one_row,
        [
            {"check_name": F.lit(check), "role": F.lit(role), "value": F.col(name)}
            for name, sides in used.items()
            for check, role in sides
        ],
    )


def equal_values(measures: Sequence[DataFrame]) -> DataFrame:
    """Passes where both sides are equal; two missing values are equal."""
    return side_by_side(measures).withColumn("passed", F.col("actual").eqNullSafe(F.col("expected")))


def close_values(measures: Sequence[DataFrame], tolerance: str = "0.01") -> DataFrame:
    """Passes where the sides differ by at most ``tolerance``; a missing value counts as 0."""
    zero = F.lit(0).cast("decimal(38,2)")
    return (
        side_by_side(measures)
        .withColumns({side: F.coalesce(side, zero) for side in ("actual", "expected")})
        .withColumn("diff", F.abs(F.col("actual") - F.col("expected")).cast("decimal(38,2)"))
        .withColumn("passed", F.col("diff") <= F.lit(tolerance).cast("decimal(38,2)"))
    )


def count_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, row_count`` of every table."""
    return union_all(
        [
            df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
            for name, df in tables.items()
        ]
    )


def accepted_values(df: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    """Every value of the column with its rows and whether it is an accepted one, which is what passes."""
    return (
        df.groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("row_count"))
        .withColumn("accepted", F.coalesce(F.col("value").isin(list(accepted)), F.lit(False)))
        .withColumn("passed", F.col("accepted"))
    )


def partition_completeness(df: DataFrame, partition: str) -> DataFrame:
    """Rows of every day from the first to the last partition; a day without rows is incomplete and fails."""
    per_day = df.where(F.col(partition).isNotNull()).groupBy(F.col(partition).alias("day")).agg(
        F.count("*").alias("row_count")
    )
    calendar = per_day.agg(F.min("day").alias("first"), F.max("day").alias("last")).select(
        F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 DAY"))).alias("day")
    )
    return calendar.join(per_day, "day", "left").select(
        "day",
        F.coalesce("row_count", F.lit(0).cast("long")).alias("row_count"),
        F.col("row_count").isNotNull().alias("complete"),
        F.col("row_count").isNotNull().alias("passed"),
    )


def row_count_drift(df: DataFrame, partition: str, tolerance: float = 0.5) -> DataFrame:
    """Rows per day next to those of the day before in the table, and the relative change.

    A change of more than ``tolerance``, up or down, fails; the first day has nothing to differ from and passes.
    """
    per_day = df.groupBy(F.col(partition).alias("day")).agg(F.count("*").alias("row_count"))
    # One row per calendar day is left here, so the window without a partition stays small.
    before = F.lag("row_count").over(Window.orderBy("day"))
    return (
        per_day.where(F.col("day").isNotNull())
        .withColumn("previous_count", before)
        .withColumn("drift", (F.col("row_count") - F.col("previous_count")) / F.col("previous_count"))
        .withColumn("passed", F.coalesce(F.abs("drift") <= tolerance, F.lit(True)))
    )


def enforce(checks: DataFrame) -> None:
    """Raise when a check did not pass, naming every failed one."""
    failed = [row.asDict() for row in checks.where(~F.col("passed")).collect()]
    if failed:
        raise ChecksFailed("; ".join(", ".join(f"{k}={v}" for k, v in row.items()) for row in failed))
