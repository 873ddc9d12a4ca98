"""Properties: dedupe and upsert are idempotent; the fact never outgrows its orders."""

import datetime as dt

from pyspark.sql import functions as F

from haulwise.operators import star
from haulwise.operators.validation import dedupe_first
from haulwise.plans.build import Batch
from tests.conftest import SF_SMALL

T = dt.datetime(2024, 1, 1)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_dedupe_is_idempotent(spark):
    df = spark.range(0, 300).select((F.col("id") % 37).cast("string").alias("k"), F.col("id").alias("_row_seq"))
    once = dedupe_first(df, "k")
    assert _rows(dedupe_first(once, "k")) == _rows(once)
    assert once.count() == 37


def test_upsert_is_idempotent(spark):
    members = spark.createDataFrame([(f"ROUTE_{i:03d}",) for i in range(1, 40)], "route_id string")
    first = star.load_dim_route(star.empty(spark, star.DIM_ROUTE), members, T, base_key=0)
    again = star.load_dim_route(first, members, T)
    assert _rows(again) == _rows(first)


def test_fact_rows_bounded_by_distinct_orders(spark):
    b = Batch(spark, SF_SMALL)
    orders = b.transformed["orders"]
    assert b.fact.count() <= orders.select("order_id").distinct().count()
    assert b.fact.select("order_id").distinct().count() == b.fact.count()
