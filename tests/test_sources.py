"""Source registry: missing feeds are skipped."""

import datetime as dt
import os

from haulwise.plans.job import extract_sources

T = dt.datetime(2024, 1, 1)


def test_missing_feed_is_skipped(spark, tmpdir_path):
    land = os.path.join(tmpdir_path, "landing")
    os.makedirs(land)
    with open(os.path.join(land, "orders.csv"), "w") as f:
        f.write("order_id,warehouse_id,route_id,order_date,order_value,status\nO1,WH_001,ROUTE_001,2024-01-01,5,NA\n")
    feeds = extract_sources(spark, land, os.path.join(tmpdir_path, "wh"), "2024-01-01", T, multiline={"orders": False})
    assert list(feeds) == ["orders"]
    row = feeds["orders"].first()
    assert (row.order_id, row.status, row._source_file, row._execution_date) == ("O1", None, "orders.csv", "2024-01-01")
