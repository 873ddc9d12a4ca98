"""Sums that the marts need, kept per batch beside the fact.

Each table holds, for every batch of the fact and every key of a mart, sums
that add up over batches. They are worked out from the rows of the batch alone,
so a load refreshes the batches it touched (its own, and those whose rows it
met) and nothing else; a row that the upsert changed leaves its old share and
brings its new one, as its batch is summed again. A mart adds the batches up:
its cost follows keys times batches, not the fact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulwise.contracts import FACT_TABLE
from haulwise.sources.warehouse import WarehouseStore

def _count(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def warehouse_sums(fact: DataFrame, *batch: str) -> DataFrame:
    """Per warehouse key (NULL too): orders, order values, deliveries with a known outcome, days late."""
    known = F.col("is_on_time").isNotNull()
    return fact.groupBy(*batch, "warehouse_key").agg(
        F.count("order_id").alias("orders"), F.sum("order_value_usd").alias("value"),
        F.count("order_value_usd").alias("valued"), _count(known).alias("known"), _count(F.col("is_on_time")).alias("on_time"),
        F.sum(F.when(known, F.col("days_late"))).alias("known_late"), F.count(F.when(known, F.col("days_late"))).alias("known_late_n"),
        F.sum("days_late").alias("late"), F.count("days_late").alias("late_n"))


def route_sums(fact: DataFrame, *batch: str) -> DataFrame:
    """Per route key: deliveries with a duration, hours, days late."""
    return fact.where(F.col("delivery_duration_hours").isNotNull()).groupBy(*batch, "route_key").agg(
        F.count(F.lit(1)).alias("deliveries"), F.sum("delivery_duration_hours").alias("hours"),
        F.sum("days_late").alias("late"), F.count("days_late").alias("late_n"))


def partner_sums(fact: DataFrame, *batch: str) -> DataFrame:
    """Per partner key (NULL too): orders, those with a value, their value."""
    return fact.groupBy(*batch, "partner_key").agg(
        F.count("order_id").alias("orders"), F.count("order_value_usd").alias("valued"), F.sum("order_value_usd").alias("value"))


def month_sums(fact: DataFrame, *batch: str) -> DataFrame:
    """Per month of the order date (yyyymm): orders, those with a value, their value."""
    month = F.expr("order_date_key DIV 100").cast("int")
    return fact.where(F.col("order_date_key").isNotNull()).groupBy(*batch, month.alias("month_key")).agg(
        F.count("order_id").alias("orders"), F.count("order_value_usd").alias("valued"), F.sum("order_value_usd").alias("value"))


#: The marts' sums and their keys.
SUMS = {"warehouse": (warehouse_sums, "warehouse_key"), "route": (route_sums, "route_key"),
        "partner": (partner_sums, "partner_key"), "month": (month_sums, "month_key")}
TABLE = "mart_state"


def refresh(store: WarehouseStore, batches: list[str]) -> None:
    """Sum the given batches of the fact again; the other batches' sums stay as they are."""
    fact = store.placed(FACT_TABLE)
    if fact is None:  # nothing was ever loaded
        return
    fact, rows = fact.where(F.col("_batch").isin(batches)), None
    for grain, (sums, key) in SUMS.items():
        part = sums(fact, "_batch").withColumnRenamed(key, "key").withColumns({"grain": F.lit(grain), "key": F.col("key").cast("long")})
        rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
    store.replace(TABLE, rows.withColumn("_bucket", F.lit(0)), reads_itself=False)


def total(store: WarehouseStore, grain: str) -> DataFrame:
    """The sums of one grain over all batches, one row per key."""
    sums, key = SUMS[grain]
    kept = store.read(TABLE).where(F.col("grain") == grain).withColumnRenamed("key", key)
    wanted = [c for c in sums(store.read(FACT_TABLE)).columns if c != key]
    return kept.groupBy(key).agg(*[F.sum(c).alias(c) for c in wanted])
