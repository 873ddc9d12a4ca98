"""Column-level building blocks (pure ``Column -> Column`` functions)."""

from haulwise.functions.dates import parse_date, standardize_date, standardize_timestamp
from haulwise.functions.numbers import to_decimal, to_number, to_usd
from haulwise.functions.text import na_to_null, standardize_category, strip_text

__all__ = [
    "na_to_null", "parse_date", "standardize_category", "standardize_date",
    "standardize_timestamp", "strip_text", "to_decimal", "to_number", "to_usd",
]
