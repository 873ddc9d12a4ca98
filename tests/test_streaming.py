"""Landed files are processed once across AvailableNow runs."""

import os

from haulwise.streaming.landing_stream import process_landed


def test_each_file_processed_once(spark, tmpdir_path):
    land = os.path.join(tmpdir_path, "landing")
    os.makedirs(land)
    header = "order_id,warehouse_id,partner_id,route_id,order_date,promised_delivery_date,actual_delivery_date,order_value,currency,status\n"

    def drop(name, ids):
        with open(os.path.join(land, name), "w") as f:
            f.write(header + "".join(f"{i},WH_001,,ROUTE_001,2024-01-01,,,10,USD,pending\n" for i in ids))

    seen = []
    ckpt = os.path.join(tmpdir_path, "ckpt")
    drop("a.csv", ["O1", "O2"])
    process_landed(spark, "orders", land, ckpt, lambda df, _: seen.extend(r.order_id for r in df.collect()))
    drop("b.csv", ["O3"])
    process_landed(spark, "orders", land, ckpt, lambda df, _: seen.extend(r.order_id for r in df.collect()))
    assert sorted(seen) == ["O1", "O2", "O3"]
