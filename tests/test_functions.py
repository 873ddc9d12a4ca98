"""Table-driven edge rows for the column functions."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from haulwise.functions import (
    na_to_null, standardize_category, standardize_date, standardize_timestamp, to_number, to_usd,
)

DATES = [
    ("05-03-2026", "2026-05-03"),   # month-first even when written day-first
    ("25-03-2026", "2026-03-25"),   # first number > 12: day-first
    ("13/05/2026", "2026-05-13"),
    ("31/31/2026", None), ("2026-13-40", None), ("2026-25-03", None), ("02/30/2026", None),
    ("", None), ("   ", None), ("  2026-3-5 ", "2026-03-05"), ("20260305", "2026-03-05"),
    ("2026-03-05T10:11:12", "2026-03-05"), ("2026-03-05 10:11:12", "2026-03-05"),
    ("2026-03-05 25:00", None), ("garbage", None), (None, None),
]


def _one(spark, col_fn, values, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {dtype}")
    return [r.y for r in df.select("i", col_fn(F.col("x")).alias("y")).orderBy("i").collect()]


def test_standardize_date(spark):
    got = _one(spark, standardize_date, [d for d, _ in DATES])
    assert got == [e for _, e in DATES]


@pytest.mark.parametrize("text,expected", [
    ("2026-03-05T10:11:12", "2026-03-05T10:11:12"),
    ("2026-03-05 10:11:12.5+0530", "2026-03-05T10:11:12.500000+05:30"),
    ("2026-03-05T10:11:12.000Z", "2026-03-05T10:11:12+00:00"),
    ("03/05/2026 7:05", "2026-03-05T07:05:00"),
    ("2026-03-05", "2026-03-05T00:00:00"),
    ("2026-03-05 10:61", None), ("", None),
])
def test_standardize_timestamp(spark, text, expected):
    assert _one(spark, standardize_timestamp, [text]) == [expected]


def test_to_usd_half_up_and_rates(spark):
    df = spark.createDataFrame(
        [(0, "10.35", "EUR"), (1, "abc", "USD"), (2, "10", None), (3, "10", "eur"), (4, "10", "JPY"),
         (5, None, "USD"), (6, "2.675", "USD"), (7, " 12 ", "GBP")], "i int, a string, c string")
    got = [r.y for r in df.select("i", to_usd("a", "c").alias("y")).orderBy("i").collect()]
    assert got == [Decimal("11.39"), None, Decimal("10.00"), Decimal("11.00"), Decimal("10.00"), None,
                   Decimal("2.68"), Decimal("15.24")]


def test_to_number_rejects_non_plain_numbers(spark):
    vals = ["1d", "1_000", "0x10", "1,000", "$5", " 12 ", "1e3", "-5", ".5", None]
    assert _one(spark, to_number, vals) == [None, None, None, None, None, 12.0, 1000.0, -5.0, 0.5, None]


def test_standardize_category_strips_all_whitespace(spark):
    vals = ["DELIVERED", " Pending ", "\tshipped\n", None]
    assert _one(spark, standardize_category, vals) == ["delivered", "pending", "shipped", None]


def test_na_tokens(spark):
    vals = ["NA", "n/a", "NULL", "nan", "", "#N/A", "ok", "Na", " NA"]
    assert _one(spark, na_to_null, vals) == [None, None, None, None, None, None, "ok", "Na", " NA"]
