"""Column expressions: parsing raw text, normalising values, building keys."""

from lakemart.functions.columns import (
    clean,
    composite_key,
    fingerprint,
    parse,
    positive_ratio,
    sales_month,
)

__all__ = ["clean", "composite_key", "fingerprint", "parse", "positive_ratio", "sales_month"]
