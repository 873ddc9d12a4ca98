"""Rows held back and taken up again, touched folders only, late rows by content, sums kept per batch."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from haulwise.contracts import CONTRACTS, FACT_TABLE
from haulwise.operators import joins, star
from haulwise.operators import validation as val
from haulwise.plans import load, mart_state, marts
from haulwise.plans.job import run_batch
from haulwise.sources.warehouse import WarehouseStore
from tests.test_reruns import feed, order

T1, T2, T3 = (dt.datetime(2024, 1, d) for d in (10, 11, 12))
CAL = ("2023-12-01", "2024-12-31")


def run(spark, root, n, *orders, **more):
    at = (T1, T2, T3)[n - 1]
    return run_batch(spark, {"orders": feed(spark, *orders)}, root, at.date().isoformat(), at, **{"calendar": CAL, **more})


def fact(res):
    return {r.order_id: r for r in res.tables[FACT_TABLE].collect()}


def files(root, table=FACT_TABLE):
    return {os.path.relpath(f, root) for f in glob.glob(f"{root}/{table}/*/*/*.parquet")}


def test_a_far_future_date_moves_no_mark(spark, tmpdir_path):
    res = run(spark, tmpdir_path, 1, order(1), order(2, order_date="9999-12-31"))
    assert res.watermark == "2024-01-02" and set(fact(res)) == {"ORD_1"}
    res = run(spark, tmpdir_path, 2, order(3, order_date="2024-01-03"), order(4, order_date="2024-01-04"))
    assert set(fact(res)) == {"ORD_1", "ORD_3", "ORD_4"} and res.watermark == "2024-01-04"
    held = spark.read.parquet(f"{tmpdir_path}/quarantine/source={FACT_TABLE}").where("_execution_date = '2024-01-11'").collect()
    assert [(r.order_id, r.order_date, r.order_value) for r in held] == [("ORD_2", "9999-12-31", "10")]  # whole, and still held


def test_held_rows_are_loaded_once_their_date_exists(spark, tmpdir_path):
    early = ("2023-12-01", "2024-01-31")
    res = run(spark, tmpdir_path, 1, order(1), order(2, promised_delivery_date="2024-03-01"), order(3, order_date="2024-03-05"),
              order(4, order_date="2024-03-06", promised_delivery_date="2024-03-07"), calendar=early)
    assert set(fact(res)) == {"ORD_1"} and res.watermark == "2024-01-02"
    # 4 comes again in a newer version, 2 and 3 do not
    res = run(spark, tmpdir_path, 2, order(5, order_date="2024-01-03"), order(4, order_date="2024-01-01", order_value="77"))
    got = fact(res)
    assert set(got) == {"ORD_1", "ORD_2", "ORD_3", "ORD_4", "ORD_5"}
    assert got["ORD_3"].order_date_key == 20240305 and str(got["ORD_4"].order_value_usd) == "77.00"
    assert got["ORD_2"].warehouse_key == got["ORD_1"].warehouse_key
    assert res.watermark == "2024-01-03"  # the slice's last loaded date, not that of a row taken up again
    assert spark.read.parquet(f"{tmpdir_path}/quarantine/source={FACT_TABLE}/_execution_date=2024-01-11").count() == 0
    keys = sorted(r.delivery_key for r in got.values())
    assert keys == [1, 2, 3, 4, 5]


def test_rerun_of_a_batch_that_held_rows(spark, tmpdir_path):
    rows = [order(1), order(2, order_date="9999-12-31")]
    run(spark, tmpdir_path, 1, *rows)
    again = run(spark, tmpdir_path, 1, *rows)
    assert set(fact(again)) == {"ORD_1"}
    res = run(spark, tmpdir_path, 2, order(2, order_date="2024-01-05"))
    assert set(fact(res)) == {"ORD_1", "ORD_2"}


def test_untouched_files_keep_their_names(spark, tmpdir_path):
    first = [order(i, order_date=f"2024-01-0{1 + i % 5}") for i in range(60)]
    run(spark, tmpdir_path, 1, *first)
    before = files(tmpdir_path)
    assert len({os.path.dirname(f) for f in before}) == 8
    run(spark, tmpdir_path, 2, *[order(i, order_date="2024-01-08") for i in range(100, 104)])
    assert before < files(tmpdir_path)  # new orders only add files
    before = files(tmpdir_path)
    res = run(spark, tmpdir_path, 3, order(7, order_date="2024-01-09", actual_delivery_date="2024-01-09"))
    gone = {os.path.dirname(f) for f in before - files(tmpdir_path)}
    assert len(gone) == 1 and "_batch=2024-01-10" in gone.pop()  # the one folder that holds order 7
    assert fact(res)["ORD_7"].days_late == 4 and len(fact(res)) == 64
    before = files(tmpdir_path)
    run(spark, tmpdir_path, 3, order(7, order_date="2024-01-09", actual_delivery_date="2024-01-09"))
    assert files(tmpdir_path) == before  # nothing differs any more


def test_a_load_that_dies_half_way_is_repeated(spark, tmpdir_path, monkeypatch):
    run(spark, tmpdir_path, 1, *[order(i) for i in range(20)])
    second = [order(3, order_date="2024-01-08", actual_delivery_date="2024-01-09"), *[order(i, order_date="2024-01-08") for i in (50, 51)]]
    for method, at in (("append", 0), ("replace", 0)):  # before the new rows; after the fact, before the sums
        real, calls = getattr(WarehouseStore, method), []

        def dying(self, table, *args, _real=real, _calls=calls, _at=at, **kw):
            if table in (FACT_TABLE, mart_state.TABLE):
                _calls.append(table)
                if len(_calls) > _at:
                    raise RuntimeError("lost")
            return _real(self, table, *args, **kw)
        monkeypatch.setattr(WarehouseStore, method, dying)
        with pytest.raises(RuntimeError):
            run(spark, tmpdir_path, 2, *second)
        monkeypatch.setattr(WarehouseStore, method, real)
    res = run(spark, tmpdir_path, 2, *second)
    got = fact(res)
    assert len(got) == 22 == res.tables[FACT_TABLE].count() and got["ORD_3"].days_late == 4
    assert len({r.delivery_key for r in got.values()}) == 22
    same_marts(spark, tmpdir_path)


def same_marts(spark, root):
    store = WarehouseStore(spark, root)
    rows, dims = store.read(FACT_TABLE), {t: store.read(t) for t in ("dim_warehouse", "dim_route", "dim_date")}
    total = lambda grain: mart_state.total(store, grain)
    pairs = [(marts.on_time_rates(total("warehouse"), dims["dim_warehouse"]), marts.on_time_rate_by_warehouse(rows, dims["dim_warehouse"])),
             (marts.route_times(total("route"), dims["dim_route"]), marts.delivery_time_by_route(rows, dims["dim_route"])),
             (marts.month_trend(total("month"), dims["dim_date"]), marts.monthly_order_trend(rows, dims["dim_date"])),
             (marts.kpis(total("warehouse"), total("partner")), marts.executive_kpis(rows))]
    for kept, summed in pairs:
        assert kept.columns == summed.columns and kept.collect() == summed.collect()
        assert FACT_TABLE not in kept._jdf.queryExecution().optimizedPlan().toString()
        assert not any(f"/{FACT_TABLE}/" in f for f in kept.inputFiles())


def test_marts_from_sums_kept_per_batch(spark, tmpdir_path):
    some = lambda ids, **more: [order(i, warehouse_id=f"WH_00{i % 3}", order_value=str(i), **more) for i in ids]
    run(spark, tmpdir_path, 1, *some(range(30)), order(90, actual_delivery_date=None), order(91, order_value="x"))
    same_marts(spark, tmpdir_path)
    run(spark, tmpdir_path, 2, *some(range(5), order_date="2024-02-08", actual_delivery_date="2024-02-09"),  # old out, new in
        *some(range(40, 50), order_date="2024-02-08"))
    same_marts(spark, tmpdir_path)


def test_late_rows_by_content(spark, tmpdir_path):
    late = {"lookback_days": 3, "late_rows": True}
    res = run(spark, tmpdir_path, 1, order(1), order(2), order(3, order_date="2023-12-20"), **late)
    assert res.watermark == "2024-01-02"
    store = WarehouseStore(spark, tmpdir_path)
    dims = {t: store.read(t) for t in ("dim_warehouse", "dim_route", "dim_date")} | {"dim_partner": star.empty(spark, star.DIM_PARTNER)}
    from haulwise.operators.standardize import transform_source
    raw = feed(spark, order(1), order(2, actual_delivery_date="2024-01-09"), order(3, order_date="2023-12-20", status="delivered"),
               order(4), order(5, order_date="2023-12-20"))
    orders = transform_source(val.validate_source(raw, "orders")["valid"], "orders")
    out = load.load_fact(store, orders, dims, T2, "2024-01-11", **late)
    # 1 is unchanged; 3 and 5 lie before the look-back; 2 says something else; 4 is new on a day that was loaded
    assert {r.order_id for r in out.taken.collect()} == {"ORD_2", "ORD_4"}
    assert {r.order_id: r.days_late for r in out.tables[FACT_TABLE].collect()} == {"ORD_1": 0, "ORD_2": 4, "ORD_3": 0, "ORD_4": 0}
    strict = load.load_fact(store, orders, dims, T3, "2024-01-12")
    assert strict.taken.count() == 0  # the default stays the strict filter


def test_routes_of_a_feed(spark, tmpdir_path):
    rows = feed(spark, order(1), order(2), order(1), {"order_id": None}, order(1), {"order_id": None, "status": "x"}, order(3, status=None))
    tagged = val.routed(rows, CONTRACTS["orders"])
    assert tagged.count() == 7
    parts = val.routes(tagged)
    whole = val.validate_source(rows, "orders")
    for kind in ("valid", "invalid", "duplicates"):
        assert sorted(parts[kind].collect(), key=repr) == sorted(whole[kind].collect(), key=repr), kind
    plan = tagged._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("Join") == 1
    res = run_batch(spark, {"orders": rows}, tmpdir_path, "2024-01-10", T1)
    assert res.counts["orders"] == {"original": 7, "quarantined": 3 if "status" in CONTRACTS["orders"].not_null else 2,
                                    "kept": 2 if "status" in CONTRACTS["orders"].not_null else 3}


def test_a_hot_key_is_dealt_out(spark):
    n = 30_000
    big = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None)
                                .otherwise(F.col("id") % 5000).cast("long").alias("k"))
    lookup = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    assert joins.hot_keys(big, "k") == [7]
    spread = joins.spread_lookup(big, lookup, "k", "id")
    plain = big.join(lookup, "k", "left")
    assert sorted(spread.select("id", "k", "v").collect(), key=repr) == sorted(plain.select("id", "k", "v").collect(), key=repr)
    old = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        counts = [r["count"] for r in joins.spread_lookup(big.repartition(4), lookup, "k", "id")
                  .groupBy(F.spark_partition_id()).count().collect()]
        assert max(counts) < 2 * n / len(counts) and len(counts) == 4  # no task holds the third of the hot key
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert joins.spread_lookup(big, lookup, "k", "id", how="inner").count() == plain.where("v IS NOT NULL").count()


def test_a_bitmap_loses_no_key(spark):
    table = spark.range(20_000).select(F.concat(F.lit("k"), F.col("id")).alias("k"), "id")
    keys = spark.range(0, 20_000, 40).select(F.concat(F.lit("k"), F.col("id")).alias("k")).union(
        spark.createDataFrame([(None,), ("other",)], "k string"))
    for rows in (1, 4, 256):
        left = joins.only_possible(table, keys, "k", rows)
        assert left.columns == table.columns
        assert left.join(keys, "k", "left_semi").count() == 500
        assert 500 <= left.count() < (1_500 if rows == 1 else 900)
    assert joins.only_possible(table, keys.where("false"), "k").count() == 0
