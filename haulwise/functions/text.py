"""Text cleanup columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from haulwise.contracts import NA_TOKENS

# Characters Python's str.strip() removes: ASCII whitespace, the C0 separators
# 0x1c-0x1f, NEL, NBSP and the Unicode space separators. Spark's trim() alone
# removes only the space character; a regex would try every place of the text.
WHITESPACE = "".join(map(chr, [*range(0x09, 0x0e), *range(0x1c, 0x21), 0x85, 0xa0, 0x1680, *range(0x2000, 0x200b),
                               0x2028, 0x2029, 0x202f, 0x205f, 0x3000]))


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_text(c) -> Column:
    """Remove leading and trailing whitespace like Python's ``str.strip``."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def standardize_category(c) -> Column:
    """Lower-case then strip (categorical standardization)."""
    return strip_text(F.lower(_col(c)))


def na_to_null(c) -> Column:
    """NULL for the CSV reader's NA tokens (exact, case-sensitive match)."""
    col = _col(c)
    return F.when(~col.isin(*NA_TOKENS), col)
