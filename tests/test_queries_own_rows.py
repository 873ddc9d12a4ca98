"""Registered queries over tables that the tests build."""

import datetime as dt
import re

import pytest

from haulwise.operators.standardize import transform_source
from haulwise.plans.build import SOURCES, Batch
from haulwise.plans.registry import QUERIES

DAY = dt.datetime(2000, 3, 1)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Orders of all ten warehouses, two of them landed twice; parts, events and payments, one payment landed three times."""
    at = str(tmp_path_factory.mktemp("tables"))
    put = lambda name, rows, schema: spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{at}/{name}.parquet")
    put("orders", [(k, k, DAY + dt.timedelta(k), 10.0 + k) for k in range(1, 101)],
        "o_orderkey long, o_custkey long, o_orderdate timestamp, o_totalprice double")
    put("part", [(k, k % 50) for k in range(1, 41)], "p_partkey long, p_size int")
    put("events", [(k, "view", DAY, k, 20.0) for k in range(1, 31)],
        "event_id long, event_type string, ts timestamp, user_id long, value double")
    put("lineitem", [(k, k, k, 1, 5.0, "A", "F", DAY) for k in (1, 2, 3, 3, 3, 109)],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp")
    return at


def test_summary_checks_the_whole_warehouse_dimension(spark, tables):
    failed = QUERIES["dq_report"](spark, tables).where("not passed")
    assert failed.where("rule = 'orphan_warehouse_keys'").count() == 0  # every warehouse of the fact is in the dimension
    r = QUERIES["dq_summary"](spark, tables).first()
    assert (r.total_checks, r.failures) == (9, failed.count())


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_row_counts_take_one_pass_per_feed(spark, tables):
    found = QUERIES["stage_row_counts"](spark, tables)
    assert "Window" not in _plan(found)  # the validated rows were counted where they were staged, not deduped again
    got = {(r.source, r.stage): r.row_count for r in found.collect()}
    assert len(got) == found.count() == 12
    # orders 50 and 100 land twice, and their partner is null, which is allowed; warehouse 97 is null
    assert [got["orders", s] for s in ("extracted", "validated", "transformed")] == [102, 99, 99]
    # order 109 has no partner; the payment of order 3 landed three times
    assert [got["partner_payments", s] for s in ("extracted", "validated", "transformed")] == [6, 3, 3]
    assert [got["warehouse_inventory", s] for s in ("extracted", "validated", "transformed")] == [40, 40, 40]
    assert [got["delivery_events", s] for s in ("extracted", "validated", "transformed")] == [30, 30, 30]


def test_validated_rows_of_empty_and_of_staged_feeds(spark, tables):
    b = Batch(spark, tables)
    b._raw["orders"] = b.raw("orders").where("order_id = 'none'")
    assert b.validated_rows("orders") == 0 and b.transformed["orders"].count() == 0
    b.transformed["partner_payments"]
    assert b.validated_rows("partner_payments") == 3


@pytest.mark.parametrize("source", SOURCES)
def test_standardizing_compiles_to_methods_that_the_jvm_takes(spark, tables, source):
    """HotSpot leaves methods beyond 8,000 bytes of bytecode interpreted."""
    df = transform_source(Batch(spark, tables).valid(source), source)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = re.findall(r"maxMethodCodeSize:(\d+)", df._jdf.queryExecution().explainString(mode))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sizes and max(map(int, sizes)) < 8000
