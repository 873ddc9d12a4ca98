"""Upserts, surrogate keys, calendar and watermark semantics."""

import datetime as dt

from pyspark.sql import functions as F

from haulwise.operators import keys, star

T1 = dt.datetime(2024, 1, 1)
T2 = dt.datetime(2024, 2, 1)


def test_dimension_upsert_policies(spark):
    w0 = star.load_dim_warehouse(star.empty(spark, star.DIM_WAREHOUSE),
                                 spark.createDataFrame([("WH_001",), ("WH_002",)], "warehouse_id string"), T1, base_key=0)
    w1 = star.load_dim_warehouse(w0, spark.createDataFrame([("WH_002",), ("WH_007",)], "warehouse_id string"), T2)
    rows = {r.warehouse_id: r for r in w1.collect()}
    assert rows["WH_001"].warehouse_key == 1 and rows["WH_001"].updated_at == T1
    assert rows["WH_002"].warehouse_key == 2 and rows["WH_002"].created_at == T1 and rows["WH_002"].updated_at == T2
    assert rows["WH_007"].warehouse_key == 3 and rows["WH_007"].region == "West"  # 7 % 4 = 3
    assert rows["WH_001"].region == "South" and rows["WH_001"].warehouse_name == "Warehouse 001"


def test_partner_upsert_only_touches_updated_at(spark):
    p0 = star.load_dim_partner(star.empty(spark, star.DIM_PARTNER),
                               spark.createDataFrame([("PARTNER_003",)], "partner_id string"), T1, base_key=0)
    renamed = p0.withColumn("partner_name", F.lit("Custom"))
    p1 = star.load_dim_partner(renamed, spark.createDataFrame([("PARTNER_003",)], "partner_id string"), T2)
    r = p1.first()
    assert (r.partner_name, r.partner_key, r.created_at, r.updated_at) == ("Custom", 1, T1, T2)


def test_number_rows_dense_and_ordered(spark):
    ids = spark.range(0, 500).select(F.format_string("ID_%05d", (F.col("id") * 7919) % 500).alias("i"))
    small = {r.i: r.k for r in keys.number_rows(ids, ["i"], "k", start=11).collect()}
    large = {r.i: r.k for r in keys.number_rows(ids.repartition(7), ["i"], "k", start=11).collect()}
    expect = {f"ID_{n:05d}": 11 + n for n in range(500)}
    assert small == expect and large == expect


def test_calendar_weekday_and_keys(spark):
    cal = {r.date_key: r for r in star.calendar(spark, "2024-01-01", "2024-01-07").collect()}
    assert len(cal) == 7
    assert cal[20240101].day_of_week == 0 and not cal[20240101].is_weekend  # Monday
    assert cal[20240106].is_weekend and cal[20240107].day_of_week == 6
    assert cal[20240101].quarter == 1


def test_watermark_strict_and_null_safe(spark):
    o = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-02"), ("c", None)], "order_id string, order_date string")
    assert {r.order_id for r in star.incremental_slice(o, "2024-01-01").collect()} == {"b"}
    assert star.incremental_slice(o, None).count() == 3
    assert {r.order_id for r in star.incremental_slice(o, "2024-01-02", lookback_days=1).collect()} == {"b"}


def test_advance_watermark_empty_slice_keeps_state(spark):
    s0 = star.initial_state(spark, T1)
    assert star.read_watermark(s0) == "1900-01-01"
    assert star.advance_watermark(s0, None, T2).collect() == s0.collect()
    s1 = star.advance_watermark(s0, "2024-03-01", T2)
    assert star.read_watermark(s1) == "2024-03-01"


def test_fact_upsert_updates_only_metrics(spark):
    rows = spark.createDataFrame(
        [("O1", 1, None, 1, 20240101, 20240105, 20240104, "10.00", True, -1, "-24.00")],
        "order_id string, warehouse_key long, partner_key long, route_key long, order_date_key int, "
        "promised_date_key int, actual_date_key int, order_value_usd string, is_on_time boolean, days_late int, "
        "delivery_duration_hours string")
    rows = rows.withColumns({"order_value_usd": F.col("order_value_usd").cast("decimal(12,2)"),
                             "delivery_duration_hours": F.col("delivery_duration_hours").cast("decimal(10,2)")})
    f1 = star.load_fact(star.empty(spark, star.FACT), rows, T1, base_key=0)
    again = rows.withColumns({"order_value_usd": F.lit(99).cast("decimal(12,2)"), "is_on_time": F.lit(False),
                              "days_late": F.lit(3)})
    f2 = star.load_fact(f1, again, T2).first()
    assert (f2.delivery_key, float(f2.order_value_usd), f2.is_on_time, f2.days_late, f2.created_at) == \
        (1, 10.0, False, 3, T1)
