"""Plan shape: no Python in the hot path, dimension joins broadcast."""

from haulwise.plans import marts
from haulwise.plans.build import Batch
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_marts_have_no_python_and_broadcast_dims(spark):
    b = Batch(spark, SF_SMALL)
    p = _plan(marts.on_time_rate_by_warehouse(b.fact, b.dim_warehouse))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p


def test_watermark_filter_reaches_the_scan(spark):
    b = Batch(spark, SF_SMALL)
    p = _plan(b.fact_slice)
    assert "PushedFilters: [IsNotNull(order_date), GreaterThan(order_date,1900-01-01)]" in p


def test_dedupe_limits_before_shuffle(spark):
    b = Batch(spark, SF_SMALL)
    p = _plan(b.valid("orders"))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_marts_sum_before_they_join(spark):
    b = Batch(spark, SF_SMALL)
    fact = b.mart_fact("warehouse")
    plan = marts.on_time_rate_by_warehouse(fact, b.dim_warehouse)._jdf.queryExecution().optimizedPlan().toString()
    joins = [i for i, line in enumerate(plan.splitlines()) if "Join Inner" in line]
    sums = [i for i, line in enumerate(plan.splitlines()) if "Aggregate [warehouse_key" in line]
    assert joins and sums and joins[0] < sums[0]  # the tree prints the join above the sums it takes
