"""A subset of registered queries against their DuckDB twins at sf0.001."""

import duckdb
import pytest

from tests.conftest import SF_SMALL
from tools.oracle_check import TABLES, rows_of

KEYS = ["on_time_rate_by_warehouse", "partner_payment_reconciliation", "monthly_order_trend",
        "executive_kpis", "transform_orders", "dq_report", "upsert_fact"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", KEYS)
def test_query_matches_oracle(spark, con, name):
    from __spark_entry__ import oracle_sql, queries

    df = queries()[name](spark, SF_SMALL)
    res = con.execute(oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(dcols, res.fetchall())


def test_every_query_has_an_oracle():
    from __spark_entry__ import oracle_sql, queries

    # the library's own queries; those of the training-data operators that SQL
    # cannot express are tested with their operators
    from haulwise.plans.registry import QUERIES
    from oracle import ORACLE
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())
