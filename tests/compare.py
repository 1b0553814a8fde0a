"""Strict comparison of a Spark result with a DuckDB result: names, kinds of types, every value."""

from __future__ import annotations

import datetime
import decimal
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _kind(value):
    if isinstance(value, decimal.Decimal):
        return ("decimal", value.normalize() + 0)
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, datetime.datetime):
        return ("timestamp", value.replace(tzinfo=None))
    return (type(value).__name__, value)


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_kind(row[i]) for i in order) for row in rows)


def differences(df, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs between the two results, or None."""
    result = connection.execute(sql)
    columns = [entry[0] for entry in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    expected = _bag(columns, result.fetchall())
    found = _bag(df.columns, [tuple(row) for row in df.collect()])
    if found == expected:
        return None
    more, less = found - expected, expected - found
    return f"{sum(more.values())} rows not expected, e.g. {next(iter(more), None)}; missing e.g. {next(iter(less), None)}"


def missing_last(row):
    return tuple((value is None, str(value)) for value in row)


def rows(df, *columns):
    """The rows of a few columns in a fixed order."""
    return sorted((tuple(row) for row in df.select(*columns).collect()), key=missing_last)
