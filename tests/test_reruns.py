"""Empty, rejected, unreadable and repeated batches; keys that dangle."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from haulwise.contracts import CONTRACTS
from haulwise.operators import quality as dq
from haulwise.operators import star
from haulwise.operators.validation import validate_source
from haulwise.plans.job import extract_sources, run_batch
from haulwise.sources import landing
from haulwise.sources.warehouse import WarehouseStore
from haulwise.streaming.landing_stream import process_landed

T, DS = dt.datetime(2024, 1, 10), "2024-01-10"
COLS = list(CONTRACTS["orders"].columns)


def feed(spark, *rows):
    base = {c: None for c in COLS}
    full = [tuple({**base, **r}[c] for c in COLS) + (i,) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, ", ".join(f"{c} string" for c in COLS) + ", _row_seq long")


def order(i, **more):
    return {"order_id": f"ORD_{i}", "warehouse_id": "WH_001", "partner_id": "PARTNER_001", "route_id": "ROUTE_001",
            "order_date": "2024-01-02", "promised_delivery_date": "2024-01-05", "actual_delivery_date": "2024-01-05",
            "order_value": "10", "currency": "USD", "status": "shipped", **more}


def sink(spark, root, kind):
    return spark.read.parquet(f"{root}/{kind}/source=orders/_execution_date={DS}").count()


def test_a_clean_rerun_leaves_nothing_of_the_dirty_run(spark, tmpdir_path):
    dirty = feed(spark, order(1), order(1), {"order_id": None, "status": "x"})
    run_batch(spark, {"orders": dirty}, tmpdir_path, DS, T)
    assert sink(spark, tmpdir_path, "quarantine") == 1 and sink(spark, tmpdir_path, "duplicates") > 0
    res = run_batch(spark, {"orders": feed(spark, order(1))}, tmpdir_path, DS, T)
    assert res.counts["orders"] == {"original": 1, "quarantined": 0, "kept": 1}
    assert sink(spark, tmpdir_path, "quarantine") == 0 and sink(spark, tmpdir_path, "duplicates") == 0


def test_an_all_rejected_rerun_keeps_no_stale_rows(spark, tmpdir_path):
    run_batch(spark, {"orders": feed(spark, order(1))}, tmpdir_path, DS, T)
    res = run_batch(spark, {"orders": feed(spark, {"order_id": None})}, tmpdir_path, DS, T)
    assert res.counts["orders"] == {"original": 1, "quarantined": 1, "kept": 0}
    assert res.transformed["orders"].count() == 0


def test_first_run_on_no_valid_row(spark, tmpdir_path):
    res = run_batch(spark, {"orders": feed(spark, {"order_id": None})}, tmpdir_path, DS, T)
    assert res.counts["orders"]["kept"] == 0


def test_header_only_file(spark, tmpdir_path):
    land = os.path.join(tmpdir_path, "land")
    os.makedirs(land)
    with open(os.path.join(land, CONTRACTS["orders"].file_name), "w") as f:
        f.write(",".join(COLS) + "\n")
    feeds = extract_sources(spark, land, os.path.join(tmpdir_path, "wh"), DS, T)
    assert list(feeds) == ["orders"] and feeds["orders"].count() == 0
    assert run_batch(spark, feeds, os.path.join(tmpdir_path, "wh"), DS, T).counts["orders"]["original"] == 0


def test_a_read_error_is_not_an_absent_feed(spark, tmpdir_path):
    with pytest.raises(Exception):
        extract_sources(spark, "nosuchscheme://landing", tmpdir_path, DS, T)
    assert extract_sources(spark, os.path.join(tmpdir_path, "none"), tmpdir_path, DS, T) == {}


def test_surplus_lines_are_kept(spark, tmpdir_path):
    land = os.path.join(tmpdir_path, "land")
    os.makedirs(land)
    with open(os.path.join(land, CONTRACTS["orders"].file_name), "w") as f:
        f.write(",".join(COLS) + "\n" + ",".join("a" * len(COLS)) + "\n" + ",".join("b" * (len(COLS) + 2)) + "\n")
    feeds = extract_sources(spark, land, tmpdir_path, DS, T)
    assert feeds["orders"].count() == 1 and sink(spark, tmpdir_path, "malformed") == 1


def test_dates_outside_the_calendar_are_held_back(spark, tmpdir_path):
    rows = feed(spark, order(1), order(2, order_date="1990-01-01", promised_delivery_date="1990-01-02"),
                order(3, actual_delivery_date=None))
    res = run_batch(spark, {"orders": rows}, tmpdir_path, DS, T)
    fact = res.tables["fact_deliveries"]
    assert sorted(r.order_id for r in fact.collect()) == ["ORD_1", "ORD_3"]
    held = spark.read.parquet(f"{tmpdir_path}/quarantine/source=fact_deliveries/_execution_date={DS}").collect()
    assert [(r.order_id, r._quarantine_reason) for r in held] == [
        ("ORD_2", "No row in the referenced dimension: order_date_key, promised_date_key")]
    dims = res.tables
    assert star.fk_violations(fact, dims["dim_warehouse"], dims["dim_partner"], dims["dim_route"],
                              dims["dim_date"]).count() == 0


def test_unknown_source_passes_through(spark):
    df = spark.createDataFrame([(1,)], "x int")
    assert validate_source(df, "something_else")["valid"].collect() == df.collect()


def test_only_a_missing_folder_means_no_table(spark, tmpdir_path):
    store = WarehouseStore(spark, tmpdir_path)
    assert store.read("t") is None
    store.put("t", spark.range(3))
    assert store.read("t").count() == 3
    assert sorted(r.id for r in store.put("t", spark.range(2)).collect()) == [0, 1]
    with pytest.raises(Exception):
        WarehouseStore(spark, "nosuchscheme://x").read("t")


def test_repeated_values_are_counted_in_one_group(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), (None,), ("b",)], "k string")
    assert dq.count_repeated("k")(df).first()[0] == 5 == dq.unique_values("k")(df).count()


def test_stream_refuses_other_columns(spark, tmpdir_path):
    land = os.path.join(tmpdir_path, "land")
    os.makedirs(land)
    with open(os.path.join(land, "a.csv"), "w") as f:
        f.write(",".join(reversed(COLS)) + "\n" + ",".join("x" * len(COLS)) + "\n")
    with pytest.raises(Exception):
        process_landed(spark, "orders", land, os.path.join(tmpdir_path, "cp"), lambda df, i: df.count())


def test_marts_have_no_expand(spark):
    from haulwise.plans import marts
    fact = spark.createDataFrame([], "order_id string, warehouse_key long, partner_key long, order_value_usd decimal(12,2), "
                                     "is_on_time boolean, days_late int, order_date_key int")
    plan = marts.executive_kpis(fact)._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan
    assert marts.executive_kpis(fact).first().total_orders == 0


def test_active_keys_are_not_gathered(spark):
    from haulwise.plans import marts
    rows = [(str(i), i % 40 if i % 7 else None, i % 30 if i % 5 else None, 1) for i in range(400)]
    fact = spark.createDataFrame(rows, "order_id string, warehouse_key long, partner_key long, days_late int") \
        .selectExpr("*", "CAST(days_late AS DECIMAL(12,2)) AS order_value_usd", "days_late > 1 AS is_on_time")
    found = marts.executive_kpis(fact)
    assert "collect_set" not in found._jdf.queryExecution().optimizedPlan().toString()
    row = found.first()
    assert (row.total_orders, row.active_warehouses, row.active_partners) == (
        400, len({w for _, w, _, _ in rows if w is not None}), len({p for _, _, p, _ in rows if p is not None}))


def test_numbers_follow_the_order(spark):
    from haulwise.operators import keys
    df = spark.range(500).select((F.col("id") * 7 % 500).alias("id"))
    got = {r.id: r.k for r in keys.number_rows(df, ["id"], "k").collect()}
    assert got == {i: i + 1 for i in range(500)}


def test_report_shows_violators_and_broken_rules(spark):
    df = spark.createDataFrame([(i, "x" if i % 2 else None) for i in range(20)], "_row_seq long, k string").withColumn("n", F.col("_row_seq"))
    v = dq.Validator([dq.Rule("k_not_null", "k", mask=dq.not_null("k")),
                      dq.Rule("gone_not_null", "no such column", mask=dq.not_null("gone")),
                      dq.Rule("raises", "fails in a task", mask=lambda d: F.raise_error(F.lit("no luck")).isNotNull()),
                      dq.Rule("k_unique", "k", violations=dq.unique_values("k"), count=dq.count_repeated("k")),
                      dq.Rule("k_in_set", "k", mask=dq.in_set("k", ["x"])),
                      dq.Rule("odd", "batch rule", batch=lambda b: [n % 2 == 1 for n in b.column("n").to_pylist()]),
                      dq.Rule("bad_batch", "batch rule", batch=lambda b: b.column("gone")),
                      dq.Rule("set_raises", "set rule", violations=lambda d: d.where(F.raise_error(F.lit("never")).isNotNull()))])
    rows = {r.rule: r for r in v.full_report(df, "d", T).collect()}
    assert len(rows) == 8
    assert rows["k_not_null"].violation_count == 10
    assert rows["k_not_null"].details == "Sample violations: " + ", ".join("{k: NULL, n: %d}" % i for i in (0, 2, 4, 6, 8))
    assert rows["k_unique"].violation_count == 20 and rows["k_unique"].details.count("{k: ") == 5
    assert rows["odd"].violation_count == 10 and rows["odd"].details.startswith("Sample violations: {k: x, n: 1}, {k: x, n: 3}")
    for name, word in (("gone_not_null", "gone"), ("raises", "no luck"), ("bad_batch", "gone"), ("set_raises", "never")):
        assert (rows[name].passed, rows[name].violation_count) == (False, -1), name
        assert rows[name].details.startswith("Check failed with error: ") and word in rows[name].details, rows[name].details
    assert rows["k_in_set"].passed and rows["k_in_set"].details is None
    assert {r.checked_at for r in rows.values()} == {T.isoformat()}


def test_orphans_get_a_report_row(spark):
    fact = spark.createDataFrame([(1,), (2,), (None,)], "warehouse_key long")
    dim = spark.createDataFrame([(1,)], "warehouse_key long")
    assert [r.violation_count for r in dq.orphan_row(dq.orphan_count(fact, dim), T).collect()] == [1]
    assert dq.orphan_row(dq.orphan_count(dim, dim), T).count() == 0


def test_fail_on_error(spark, tmpdir_path):
    bad = feed(spark, order(1, status="lost"))
    with pytest.raises(dq.QualityError):
        run_batch(spark, {"orders": bad}, tmpdir_path, DS, T, fail_on_error=True)
    res = run_batch(spark, {"orders": bad}, tmpdir_path, DS, T)
    assert res.quality_summary == {"total_checks": 4, "failures": 1} and "checked_at" in res.quality.columns


def test_values_out_of_range_are_held_back(spark, tmpdir_path):
    rows = feed(spark, order(1, order_value="99999999999.00"), order(2, order_value="1e30"),
                order(3, order_value="9999999999.99"), order(4, order_value="abc"))
    res = run_batch(spark, {"orders": rows}, tmpdir_path, DS, T)
    values = {r.order_id: r.order_value_usd for r in res.tables["fact_deliveries"].collect()}
    assert sorted(values) == ["ORD_3", "ORD_4"] and str(values["ORD_3"]) == "9999999999.99"
    held = spark.read.parquet(f"{tmpdir_path}/quarantine/source=fact_deliveries/_execution_date={DS}").collect()
    assert sorted((r.order_id, r._quarantine_reason) for r in held) == [
        ("ORD_1", "Order value out of range"), ("ORD_2", "Order value out of range")]
    usd = {r.order_id: r.order_value_usd for r in res.transformed["orders"].collect()}
    assert str(usd["ORD_1"]) == "99999999999.00"
