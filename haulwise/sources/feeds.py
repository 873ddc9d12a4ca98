"""The four landing feeds, derived deterministically from the given tables.

The derivations are written once as portable SQL. Four date-format macros are
the only dialect differences; ``render`` fills them for Spark SQL or DuckDB so
both engines produce row-for-row identical feeds. In Spark the base tables are
bound as DataFrames through ``spark.sql(..., **tables)``; nothing is
registered globally, so sessions can hold several scale factors at once.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulwise.contracts import CONTRACTS, ROW_SEQ

_MACROS = {
    "spark": {
        "ymd": "date_format({x},'yyyy-MM-dd')",
        "mdy": "date_format({x},'MM/dd/yyyy')",
        "dmy": "date_format({x},'dd-MM-yyyy')",
        "iso": "date_format({x},\"yyyy-MM-dd'T'HH:mm:ss\")",
    },
    "duckdb": {
        "ymd": "strftime({x},'%Y-%m-%d')",
        "mdy": "strftime({x},'%m/%d/%Y')",
        "dmy": "strftime({x},'%d-%m-%Y')",
        "iso": "strftime({x},'%Y-%m-%dT%H:%M:%S')",
    },
}
_MACRO_RE = re.compile(r"\{(ymd|mdy|dmy|iso):([^{}]*)\}")

ORDERS_RAW = """
WITH o AS (SELECT o_orderkey k, o_custkey c, CAST(o_orderdate AS DATE) d, o_totalprice v FROM {orders}),
base AS (SELECT k, k * 2 AS _row_seq,
  CASE WHEN k % 211 = 0 THEN NULL ELSE concat('ORD_', lpad(CAST(k AS STRING), 6, '0')) END AS order_id,
  CASE WHEN k % 97 = 0 THEN NULL ELSE concat('WH_', lpad(CAST(c % 10 + 1 AS STRING), 3, '0')) END AS warehouse_id,
  CASE WHEN k % 20 = 0 THEN NULL ELSE concat('PARTNER_', lpad(CAST((c * 7 + k) % 20 + 1 AS STRING), 3, '0')) END AS partner_id,
  concat('ROUTE_', lpad(CAST(c % 50 + 1 AS STRING), 3, '0')) AS route_id,
  CASE WHEN k % 503 = 0 THEN 'garbage' WHEN k % 4 = 1 THEN {mdy:d} WHEN k % 4 = 2 THEN {dmy:d} ELSE {ymd:d} END AS order_date,
  {ymd:d + CAST(3 + k % 5 AS INT)} AS promised_delivery_date,
  CASE WHEN k % 10 = 3 THEN NULL ELSE {ymd:d + CAST(3 + k % 5 + (k * 7) % 11 - 5 AS INT)} END AS actual_delivery_date,
  CASE WHEN k % 307 = 0 THEN 'abc' WHEN k % 401 = 0 THEN concat('-', CAST(CAST(v AS DECIMAL(12,2)) AS STRING)) ELSE CAST(CAST(v AS DECIMAL(12,2)) AS STRING) END AS order_value,
  CASE WHEN k % 5 = 4 THEN NULL WHEN k % 127 = 7 THEN 'nan' WHEN k % 50 = 1 THEN 'JPY' ELSE split_part('USD,EUR,GBP,usd', ',', CAST(k % 5 + 1 AS INT)) END AS currency,
  CASE WHEN k % 601 = 0 THEN 'lost' WHEN k % 113 = 1 THEN 'NA' WHEN k % 113 = 2 THEN 'null' WHEN k % 113 = 3 THEN 'N/A' ELSE split_part('pending,shipped,delivered,cancelled,DELIVERED, Pending ', ',', CAST(k % 6 + 1 AS INT)) END AS status
  FROM o)
SELECT * FROM base
UNION ALL
SELECT k, _row_seq + 1, order_id, warehouse_id, partner_id, route_id, order_date, promised_delivery_date, actual_delivery_date, order_value, currency, 'shipped' FROM base WHERE k % 50 = 0
"""

INVENTORY_RAW = """
SELECT p_partkey AS _row_seq, concat('INV_', CAST(p_partkey AS STRING)) AS inventory_id,
  CASE WHEN p_partkey % 89 = 0 THEN NULL ELSE concat('WH_', lpad(CAST(p_partkey % 10 + 1 AS STRING), 3, '0')) END AS warehouse_id,
  concat('SKU_', CAST(1000 + p_partkey % 9000 AS STRING)) AS sku,
  CASE WHEN p_partkey % 33 = 0 THEN NULL WHEN p_partkey % 101 = 0 THEN 'abc' WHEN p_partkey % 103 = 0 THEN '-5' ELSE CAST((p_partkey * 37) % 201 AS STRING) END AS quantity_on_hand,
  CASE WHEN p_partkey % 97 = 0 THEN '0' ELSE CAST(10 + p_size AS STRING) END AS reorder_level,
  CASE WHEN p_partkey % 107 = 0 THEN 'garbage' ELSE {iso:TIMESTAMP '2001-08-01 00:00:00' + p_size * INTERVAL '1' HOUR} END AS last_updated
FROM {part}
"""

EVENTS_RAW = """
SELECT event_id AS _row_seq, CASE WHEN event_id % 113 = 0 THEN NULL ELSE concat('EVT_', CAST(event_id AS STRING)) END AS event_id,
  concat('ORD_', lpad(CAST((event_id * 3) % (SELECT max(o_orderkey) + 50 FROM {orders}) AS STRING), 6, '0')) AS order_id,
  CASE WHEN event_id % 701 = 0 THEN 'teleported' WHEN event_id % 7 = 0 THEN ' DELIVERED ' ELSE
    CASE event_type WHEN 'view' THEN 'picked_up' WHEN 'click' THEN 'in_transit' WHEN 'signup' THEN 'out_for_delivery' WHEN 'purchase' THEN 'delivered' ELSE 'exception' END END AS event_type,
  CASE event_id % 13 WHEN 1 THEN concat({iso:ts}, '.250') WHEN 2 THEN concat({iso:ts}, 'Z') WHEN 3 THEN concat({iso:ts}, '+02:00') WHEN 4 THEN replace({iso:ts}, 'T', ' ') WHEN 5 THEN replace({iso:ts}, '-', '/') WHEN 6 THEN concat('  ', {iso:ts}, ' ') WHEN 7 THEN '' WHEN 8 THEN 'soon' ELSE {iso:ts} END AS event_timestamp, concat('City_', CAST(user_id % 10 AS STRING)) AS location,
  CASE WHEN event_id % 20 = 0 THEN NULL WHEN event_id % 333 = 0 THEN 'abc' ELSE CAST(CAST(value AS DECIMAL(10,2)) - CAST(10 AS DECIMAL(10,2)) AS STRING) END AS delivery_duration_minutes
FROM {events}
"""

PAYMENTS_RAW = """
SELECT l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_returnflag, l_linestatus, concat('PAY_', CAST(l_orderkey AS STRING), '_', CAST(l_linenumber AS STRING)) AS payment_id,
  CASE WHEN l_orderkey % 109 = 0 THEN NULL ELSE concat('PARTNER_', lpad(CAST(l_suppkey % 25 + 1 AS STRING), 3, '0')) END AS partner_id,
  CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS STRING) END AS amount,
  CASE l_returnflag WHEN 'A' THEN 'USD' WHEN 'N' THEN 'EUR' ELSE 'GBP' END AS currency,
  {ymd:CAST(l_shipdate AS DATE)} AS payment_date,
  CASE WHEN l_linestatus = 'F' THEN 'COMPLETED' WHEN l_linenumber % 3 = 0 THEN 'failed' ELSE 'pending' END AS payment_status,
  concat('ORD_', lpad(CAST(l_orderkey AS STRING), 6, '0')) AS reference_order_ids
FROM {lineitem}
"""

PAYMENT_ORDER = ("l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_returnflag", "l_linestatus")

FEED_SQL = {
    "orders": (ORDERS_RAW, ("orders",)),
    "warehouse_inventory": (INVENTORY_RAW, ("part",)),
    "delivery_events": (EVENTS_RAW, ("events", "orders")),
    "partner_payments": (PAYMENTS_RAW, ("lineitem",)),
}


def render(sql: str, dialect: str) -> str:
    """Fill the date-format macros for one engine (table slots stay)."""
    macros = _MACROS[dialect]
    return _MACRO_RE.sub(lambda m: macros[m.group(1)].format(x=m.group(2)), sql)


def duckdb_feed_sql(source: str) -> str:
    """The feed derivation as DuckDB SQL over the pre-registered tables."""
    sql, tables = FEED_SQL[source]
    sql = render(sql, "duckdb")
    for t in tables:
        sql = sql.replace("{" + t + "}", t)
    return sql.strip()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def derive_feed(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """One landing feed (all-string columns plus ``_row_seq``) from the tables.

    ``_row_seq`` stands for the position in the landing file: the first copy
    of a duplicated key has the smallest value.
    """
    sql, tables = FEED_SQL[source]
    bound = {t: read_table(spark, sf_dir, t) for t in tables}
    df = spark.sql(render(sql, "spark"), **bound)
    if source == "partner_payments":
        # file order of the payments feed: lineitem's part, supplier, then
        # the remaining columns that can tell two copies apart
        df = df.withColumn(ROW_SEQ, F.struct(*PAYMENT_ORDER))
    cols = [ROW_SEQ, *CONTRACTS[source].columns]
    if source == "orders":
        cols = ["k", *cols]
    return df.select(*cols)


def derive_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {s: derive_feed(spark, sf_dir, s) for s in FEED_SQL}
