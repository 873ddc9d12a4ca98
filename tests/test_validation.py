"""Validation: null split, first-wins dedupe, duplicate report, reasons."""

from haulwise.contracts import CONTRACTS
from haulwise.operators import validation as val

COLS = CONTRACTS["orders"].columns


def _orders(spark, rows):
    full = [(seq, *r) for seq, r in rows]
    return spark.createDataFrame(full, "_row_seq long, " + ", ".join(f"{c} string" for c in COLS))


def _row(oid, wh="WH_001", status="pending"):
    return (oid, wh, None, "ROUTE_001", "2020-01-01", None, None, "10", "USD", status)


def test_null_bad_first_copy_does_not_shadow_good_second(spark):
    df = _orders(spark, [(1, _row("A", wh=None)), (2, _row("A", status="shipped")), (3, _row("B"))])
    out = val.validate_source(df, "orders")
    kept = {(r.order_id, r.status) for r in out["valid"].collect()}
    assert kept == {("A", "shipped"), ("B", "pending")}


def test_first_occurrence_wins_and_report_has_all_copies(spark):
    df = _orders(spark, [(5, _row("A", status="second")), (1, _row("A", status="first")), (3, _row("B"))])
    out = val.validate_source(df, "orders")
    assert {(r.order_id, r.status) for r in out["valid"].collect()} == {("A", "first"), ("B", "pending")}
    assert sorted(r.status for r in out["duplicates"].collect()) == ["first", "second"]


def test_split_is_a_partition_of_the_input(spark):
    df = _orders(spark, [(1, _row(None)), (2, _row("B", wh=None)), (3, _row("C"))])
    valid, invalid = val.split_nulls(df, CONTRACTS["orders"])
    assert valid.count() + invalid.count() == df.count()
    cols = val.batch_null_columns(invalid, CONTRACTS["orders"])
    assert val.null_reason_text(cols) == "Null values in required columns: ['order_id', 'warehouse_id']"


def test_missing_columns_quarantine_whole_batch(spark):
    df = _orders(spark, [(1, _row("A"))]).drop("status")
    out = val.validate_source(df, "orders")
    assert out["valid"] is None
    assert out["invalid"].first()["_quarantine_reason"] == "Missing columns: ['status']"
