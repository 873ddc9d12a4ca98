"""The five analytical marts over the star schema.

Facts are summed by surrogate key before a dimension is joined, so a join meets
a row per key. The sums add up over batches: a mart takes them from a fact, or
from ``mart_state`` without reading the fact.

Ratios and averages are taken in DOUBLE from exact integer / decimal sums and
rounded half-up through a decimal, so the printed value does not depend on
binary rounding of ties.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulwise.operators.joins import lookup_join
from haulwise.plans import mart_state


def round_half_up(x: Column, digits: int = 2) -> Column:
    return F.round(x.cast("decimal(30,10)"), digits).cast("double")


def ratio(num, den) -> Column:
    num, den = (F.col(c) if isinstance(c, str) else c for c in (num, den))
    return num.cast("double") / F.nullif(den, F.lit(0)).cast("double")


def on_time_rate_by_warehouse(fact: DataFrame, dim_w: DataFrame) -> DataFrame:
    return on_time_rates(mart_state.warehouse_sums(fact), dim_w)


def on_time_rates(sums: DataFrame, dim_w: DataFrame) -> DataFrame:
    """From sums per warehouse key."""
    found = lookup_join(sums.where((F.col("known") > 0) & F.col("warehouse_key").isNotNull()), dim_w, "warehouse_key", how="inner",
                        cols=["warehouse_key", "warehouse_id", "warehouse_name", "region"])
    return found.select("warehouse_id", "warehouse_name", "region", F.col("known").alias("total_deliveries"),
                        F.col("on_time").alias("on_time_deliveries"),
                        round_half_up(ratio(F.col("on_time") * 100, "known")).alias("on_time_rate_pct"),
                        round_half_up(ratio("known_late", "known_late_n")).alias("avg_days_late")) \
        .orderBy(F.col("on_time_rate_pct").desc(), "warehouse_id")


def delivery_time_by_route(fact: DataFrame, dim_r: DataFrame, top: int = 20) -> DataFrame:
    return route_times(mart_state.route_sums(fact), dim_r, top)


def route_times(sums: DataFrame, dim_r: DataFrame, top: int = 20) -> DataFrame:
    """From sums per route key; a route's distance is the same for all its deliveries."""
    found = lookup_join(sums.where(F.col("route_key").isNotNull() & (F.col("deliveries") >= 5)), dim_r, "route_key", how="inner",
                        cols=["route_key", "route_id", "origin", "destination", "distance_km"])
    hours = ratio("hours", "deliveries")
    return found.select("route_id", "origin", "destination", "distance_km", F.col("deliveries").alias("delivery_count"),
                        round_half_up(hours).alias("avg_delivery_hours"),
                        round_half_up(ratio("late", "late_n")).alias("avg_days_late"),
                        round_half_up(ratio("hours", F.col("deliveries") * F.col("distance_km")), 4).alias("hours_per_km")) \
        .orderBy(F.col("avg_delivery_hours").desc(), "route_id").limit(top)


def partner_payment_reconciliation(fact: DataFrame, dim_p: DataFrame, payments_clean: DataFrame) -> DataFrame:
    return reconciliation(mart_state.partner_sums(fact), dim_p, payments_clean)


def reconciliation(sums: DataFrame, dim_p: DataFrame, payments_clean: DataFrame) -> DataFrame:
    """From sums per partner key, against the payments of each partner (also those with no orders)."""
    orders = lookup_join(sums.where((F.col("valued") > 0) & F.col("partner_key").isNotNull()), dim_p, "partner_key", how="inner",
                         cols=["partner_key", "partner_id"])
    orders = orders.select("partner_id", F.col("value").alias("total_order_value"), F.col("valued").alias("order_count"))
    paid = (payments_clean.where(F.col("amount_usd").isNotNull())
            .groupBy("partner_id")
            .agg(F.sum("amount_usd").alias("total_paid"), F.count(F.lit(1)).alias("payment_count")))
    both = orders.join(paid, "partner_id", "full_outer")
    open_amount = F.coalesce(F.col("total_paid"), F.lit(0)) - F.coalesce(F.col("total_order_value"), F.lit(0))
    state = F.when(F.abs(open_amount) < 100, "Balanced").when(open_amount < 0, "Underpaid").otherwise("Overpaid")
    return both.select("partner_id", F.col("total_order_value").cast("double").alias("total_order_value"),
                       F.col("total_paid").cast("double").alias("total_paid"),
                       open_amount.cast("double").alias("payment_difference"), state.alias("reconciliation_status"),
                       "order_count", "payment_count", F.abs(open_amount).alias("_abs")) \
        .orderBy(F.col("_abs").desc(), "partner_id").drop("_abs")


def monthly_order_trend(fact: DataFrame, dim_d: DataFrame) -> DataFrame:
    return month_trend(mart_state.month_sums(fact), dim_d)


def month_trend(sums: DataFrame, dim_d: DataFrame) -> DataFrame:
    """From sums per month; months that the calendar lacks have no row."""
    months = dim_d.select((F.col("year") * 100 + F.col("month")).alias("month_key")).distinct()
    name = F.concat_ws("-", F.substring(F.col("month_key").cast("string"), 1, 4), F.substring(F.col("month_key").cast("string"), 5, 2))
    found = lookup_join(sums, months, "month_key", how="left_semi").withColumn("year_month", name)
    # one row per calendar month: the unpartitioned window is bounded by the number of months, not by the fact size
    before = F.lag("orders").over(Window.orderBy("year_month"))
    return found.select("year_month", F.col("orders").alias("order_count"), F.col("value").cast("double").alias("total_value"),
                        round_half_up(ratio("value", "valued")).alias("avg_order_value"), before.alias("prev_month_orders"),
                        round_half_up(ratio((F.col("orders") - before) * 100, before)).alias("mom_growth_pct")) \
        .orderBy(F.col("year_month").desc())


def executive_kpis(fact: DataFrame) -> DataFrame:
    """The fact is summed once by both keys; warehouses and partners are summed from that."""
    both = fact.groupBy("warehouse_key", "partner_key").agg(
        F.count("order_id").alias("orders"), F.sum("order_value_usd").alias("value"), F.count("order_value_usd").alias("valued"),
        F.count("is_on_time").alias("known"), F.count_if(F.coalesce("is_on_time", F.lit(False))).alias("on_time"),
        F.sum("days_late").alias("late"), F.count("days_late").alias("late_n"))
    per = lambda key: both.groupBy(key).agg(*[F.sum(c).alias(c) for c in both.columns[2:]])
    return kpis(per("warehouse_key"), per("partner_key"))


def kpis(warehouses: DataFrame, partners: DataFrame) -> DataFrame:
    """One row, from sums per warehouse key and per partner key (the rows without a key among them)."""
    whole = warehouses.agg(
        F.coalesce(F.sum("orders"), F.lit(0)).alias("total_orders"),
        F.count("warehouse_key").alias("active_warehouses"),
        F.round(F.sum("value"), 2).cast("double").alias("total_order_value"),
        round_half_up(ratio(F.sum("value"), F.sum("valued"))).alias("avg_order_value"),
        round_half_up(ratio(F.sum("on_time") * 100, F.sum("known"))).alias("overall_on_time_rate"),
        round_half_up(ratio(F.sum("late"), F.sum("late_n"))).alias("avg_days_late"))
    rows = whole.unionByName(partners.agg(F.count("partner_key").alias("active_partners")), allowMissingColumns=True)
    names = ["total_orders", "active_warehouses", "active_partners", *whole.columns[2:]]
    return rows.agg(*[F.max(c).alias(c) for c in names])
