"""Contract validation: missing columns, NOT NULL split, first-wins dedupe.

All operators are lazy DataFrame transformations. The only driver-side value
is the batch-level null reason, a list of at most ``len(contract.not_null)``
column names obtained from one global aggregate.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulwise.contracts import CONTRACTS, ROW_SEQ, SourceContract


def _py_list(names) -> str:
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


def missing_columns(df: DataFrame, contract: SourceContract) -> list[str]:
    """Required columns absent from the feed header, in contract order."""
    present = set(df.columns)
    return [c for c in contract.required if c not in present]


def missing_columns_reason(missing: list[str]) -> str:
    return f"Missing columns: {_py_list(missing)}"


def null_mask(contract: SourceContract) -> Column:
    """TRUE for rows with a NULL in any effective NOT NULL column."""
    cols = contract.not_null
    if not cols:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def null_columns(contract: SourceContract) -> Column:
    """Per-row array of the NOT NULL columns that are NULL in that row."""
    return F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in contract.not_null]),
                    lambda x: x.isNotNull())


def split_nulls(df: DataFrame, contract: SourceContract) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) halves of a feed; together they are the whole input."""
    bad = null_mask(contract)
    return df.where(~bad), df.where(bad)


def batch_null_columns(invalid: DataFrame, contract: SourceContract) -> list[str]:
    """Columns NULL in at least one invalid row (one aggregate, tiny result)."""
    if not contract.not_null:
        return []
    row = invalid.agg(*[F.max(F.col(c).isNull()).alias(c) for c in contract.not_null]).first()
    return [c for c in contract.not_null if row is not None and row[c]]


def null_reason_text(cols: list[str]) -> str:
    return f"Null values in required columns: {_py_list(cols)}"


def with_null_reasons(invalid: DataFrame, contract: SourceContract, batch_reason: str | None) -> DataFrame:
    """Invalid rows with their own offending columns and the batch reason."""
    return invalid.withColumns({
        "_null_columns": F.concat(F.lit("["), F.array_join(
            F.transform(null_columns(contract), lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", "),
            F.lit("]")),
        "_quarantine_reason": F.lit(batch_reason),
    })


def dedupe_first(df: DataFrame, key: str, order_col: str = ROW_SEQ) -> DataFrame:
    """Keep the first row per key in landing-file order.

    ``row_number() = 1`` is planned with a partial WindowGroupLimit before the
    shuffle, so a hot key is cut to one row per map task before it moves.
    """
    w = Window.partitionBy(key).orderBy(F.col(order_col).asc())
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def duplicate_members(df: DataFrame, key: str) -> DataFrame:
    """All rows whose key occurs more than once (every copy, first included).

    Key counts are pre-aggregated map-side; the duplicated keys then select
    their rows through a left-semi join (AQE splits a skewed key's partition).
    """
    dup_keys = (df.where(F.col(key).isNotNull()).groupBy(key).count()
                .where(F.col("count") > 1).select(key))
    return df.join(dup_keys, on=key, how="left_semi")


#: Where a row of a feed goes: a NULL in a required column; the only row of its key; the first or a later row of a
#: key that occurs again.
NULL, SINGLE, FIRST, COPY = "null", "single", "first", "copy"


def routed(df: DataFrame, contract: SourceContract, order_col: str = ROW_SEQ) -> DataFrame:
    """Every row once, with ``_route``, ready for one partitioned write.

    Keys that occur again are counted map-side (a key with a billion rows costs a row per task) with the place of their
    first row; only they are joined back, so with few of them nothing else is shuffled, and AQE splits a skewed one.
    """
    bad = null_mask(contract)
    if not contract.unique_key:
        return df.withColumn("_route", F.when(bad, NULL).otherwise(SINGLE))
    key = contract.unique_key
    again = (df.where(~bad).groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.min(order_col).alias("_first"))
             .where(F.col("_n") > 1).select(key, "_first"))
    found = df.join(again, key, "left")
    route = (F.when(bad, NULL).when(F.col("_first").isNull(), SINGLE)
             .when(F.col(order_col) == F.col("_first"), FIRST).otherwise(COPY))
    return found.withColumn("_route", route).select(*df.columns, "_route")


def routes(tagged: DataFrame) -> dict[str, DataFrame]:
    """Views of a written ``routed`` table: valid (the first row of each key), invalid, duplicates (all rows of repeated keys)."""
    pick = lambda *names: tagged.where(F.col("_route").isin(*names)).drop("_route")
    return {"valid": pick(SINGLE, FIRST), "invalid": pick(NULL), "duplicates": pick(FIRST, COPY)}


def validate_source(df: DataFrame, source: str) -> dict:
    """Full validation of one feed.

    Returns a dict with ``valid`` (deduplicated), ``invalid`` (NULL rows with
    reasons), ``duplicates`` (all copies of duplicated keys) and
    ``missing`` (list of missing required columns; then ``valid`` is None).
    Unknown sources pass through unvalidated.
    """
    contract = CONTRACTS.get(source)
    if contract is None:
        return {"valid": df, "invalid": None, "duplicates": None, "missing": []}
    missing = missing_columns(df, contract)
    if missing:
        whole = df.withColumn("_quarantine_reason", F.lit(missing_columns_reason(missing)))
        return {"valid": None, "invalid": whole, "duplicates": None, "missing": missing}
    valid, invalid = split_nulls(df, contract)
    out = {"invalid_raw": invalid, "missing": []}
    if contract.unique_key:
        out["duplicates"] = duplicate_members(valid, contract.unique_key)
        valid = dedupe_first(valid, contract.unique_key)
    else:
        out["duplicates"] = None
    out["valid"] = valid
    out["invalid"] = invalid
    return out
