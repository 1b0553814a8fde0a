"""Column expressions shared by the layers. All of them stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

ColumnOrName = Column | str


def _col(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def parse(value: ColumnOrName, target: str, source: DataType) -> Column:
    """``value`` as ``target``; what cannot be read becomes NULL instead of failing the job.

    Text that holds a whole number with a fraction ("12.7") is cut to its integer part, as a
    lenient cast does, while a plain ``try_cast`` to int would reject it.
    """
    column = _col(value)
    if target == "int" and isinstance(source, StringType):
        column = F.regexp_extract(F.trim(column), r"^([+-]?[0-9]+)(\.[0-9]*)?$", 1)
    return column.try_cast(target)


def clean(value: ColumnOrName, style: str) -> Column:
    """Spaces trimmed at both ends, then one letter case: lower, upper, title, or as it is."""
    trimmed = F.trim(_col(value))
    match style:
        case "lower":
            return F.lower(trimmed)
        case "upper":
            return F.upper(trimmed)
        case "title":
            return F.initcap(trimmed)
        case "trim":
            return trimmed
    raise ValueError(f"unknown style {style!r}")


def composite_key(*parts: ColumnOrName) -> Column:
    """The parts joined by ``_``. A NULL part makes the key NULL, so that a not-null check sees it."""
    pieces: list[Column] = []
    for part in parts:
        pieces += [F.lit("_"), _col(part).cast("string")]
    return F.concat(*pieces[1:])


def fingerprint(*columns: ColumnOrName) -> Column:
    """md5 over the values with their lengths, so that different rows never build the same text."""
    pieces = []
    for column in columns:
        text = _col(column).cast("string")
        pieces.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.md5(F.concat(*pieces))


def positive_ratio(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """``numerator / denominator`` where the denominator is above 0, otherwise 0."""
    return F.when(_col(denominator) > 0, _col(numerator) / _col(denominator)).otherwise(F.lit(0))


def sales_month(day: ColumnOrName) -> Column:
    """First day of the month as a date."""
    return F.trunc(_col(day), "month")
