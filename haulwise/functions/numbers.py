"""Numeric coercion and currency conversion columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from haulwise.contracts import EXCHANGE_RATES
from haulwise.functions.text import strip_text

# Plain decimal or scientific notation with optional sign and surrounding
# whitespace. Spark's own cast also accepts suffixes such as '1d' or '1f';
# text like that is not a number here.
NUMERIC_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# amounts below 10^18 are parsed exactly, values below 10^16 USD are kept
MONEY = "decimal(24,6)"
USD = "decimal(18,2)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c) -> Column:
    """Text -> DOUBLE; anything that is not a plain number becomes NULL."""
    col = _col(c)
    return F.when(col.rlike(NUMERIC_TEXT), strip_text(col).try_cast("double"))


def to_decimal(c, dtype: str = MONEY) -> Column:
    """Text -> exact decimal; non-numbers and overflow become NULL."""
    col = _col(c)
    return F.when(col.rlike(NUMERIC_TEXT), strip_text(col).try_cast(dtype))


def exchange_rate(currency) -> Column:
    """Upper-cased (not trimmed) currency -> rate; unknown or NULL -> 1.0."""
    rates = F.create_map(*[x for k, v in EXCHANGE_RATES.items()
                           for x in (F.lit(k), F.lit(v).cast("decimal(3,2)"))])
    return F.coalesce(F.try_element_at(rates, F.upper(_col(currency))),
                      F.lit("1.00").cast("decimal(3,2)"))


def to_usd(amount, currency) -> Column:
    """Amount text x rate, rounded half-up to cents; bad amount -> NULL."""
    value = to_decimal(amount) * exchange_rate(currency)
    return F.round(value, 2).try_cast(USD)
