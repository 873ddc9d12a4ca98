"""Loading the star schema: dimensions, calendar, incremental fact, watermark.

A fact row whose dates the calendar lacks, or whose value the fact cannot hold,
is held back whole. Every load takes up what is still held from the one before,
in its newest version, and tries again. The watermark counts loaded rows of the
slice only, so a row that was held back cannot move it past orders to come.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from haulwise.contracts import CONTRACTS, FACT_TABLE
from haulwise.operators import star
from haulwise.plans import mart_state
from haulwise.sources import sinks
from haulwise.sources.stage import new_run_id, stage
from haulwise.sources.warehouse import DIGESTS, WarehouseStore

ORDER_COLS = [*CONTRACTS["orders"].columns, "order_value_usd", "days_late", "is_on_time"]
DIGEST_SCHEMA = "order_id string, order_date string, digest long"


@dataclass
class Loaded:
    tables: dict[str, DataFrame] = field(default_factory=dict)
    watermark: str | None = None
    taken: DataFrame | None = None  # the orders that the incremental filter let through
    held: DataFrame | None = None  # whole rows with the reason


def load_dimensions(store: WarehouseStore, members: dict[str, DataFrame | None], as_of: dt.datetime, ds: str) -> dict[str, DataFrame]:
    """Upsert the three keyed dimensions; one without members keeps what it has."""
    spark = store.spark
    specs = {"dim_warehouse": (star.DIM_WAREHOUSE, star.warehouse_attributes, "warehouse", ["warehouse_name", "region"]),
             "dim_partner": (star.DIM_PARTNER, star.partner_attributes, "partner", []),
             "dim_route": (star.DIM_ROUTE, star.route_attributes, "route", [])}

    def one(table: str) -> None:
        schema, attributes, name, update = specs[table]
        star.upsert_table(store, table, schema, attributes(members[table]), f"{name}_id", f"{name}_key", update, as_of, ds)

    with ThreadPoolExecutor(len(specs)) as pool:  # small jobs that wait for nothing of each other
        list(pool.map(one, [t for t in specs if members.get(t) is not None]))
    found = {t: store.read(t) for t in specs}
    return {t: star.empty(spark, specs[t][0]) if df is None else df for t, df in found.items()}


def load_calendar(store: WarehouseStore, start: str, end: str, ds: str) -> DataFrame:
    """Insert the days that are not there yet."""
    days, there = star.calendar(store.spark, start, end), store.read("dim_date")
    fresh = days if there is None else days.join(there.select("date_key"), "date_key", "left_anti")
    if there is None or not fresh.isEmpty():
        store.append("dim_date", fresh, "date_key", ds)
    return store.read("dim_date")


def held_before(store: WarehouseStore, ds: str) -> DataFrame | None:
    """The rows that the last load before ``ds`` held back."""
    path = f"{store.root}/quarantine/source={FACT_TABLE}"
    try:
        held = store.spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    held = held.withColumn("_execution_date", F.col("_execution_date").cast("string"))
    last = held.where(F.col("_execution_date") < ds).agg(F.max("_execution_date")).first()[0]
    return None if last is None else held.where(F.col("_execution_date") == last).select(*ORDER_COLS)


def with_digest(orders: DataFrame) -> DataFrame:
    """A hash of everything an order says (NULL and empty text differ)."""
    cols = CONTRACTS["orders"].columns
    return orders.withColumn("digest", F.xxhash64(*[F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("")) for c in cols]))


def unlike_loaded(orders: DataFrame, digests: DataFrame | None) -> DataFrame:
    """Orders that were never loaded, or that say something else than when they were."""
    if digests is None:
        return orders
    known = star.only_possible(digests.select("order_id", F.col("digest").alias("_digest")), orders, "order_id")
    met = with_digest(orders).join(known, "order_id", "left")
    return met.where(~F.col("digest").eqNullSafe(F.col("_digest"))).select(*orders.columns)


def load_fact(store: WarehouseStore, orders: DataFrame, dims: dict[str, DataFrame], as_of: dt.datetime, ds: str,
              lookback_days: int = 0, late_rows: bool = False) -> Loaded:
    """One incremental load of standardized orders into the fact.

    ``late_rows``: of the ``lookback_days`` before the watermark, only orders whose content was not loaded yet are taken
    (same-day rows that come late); without it the look-back takes all of them, and 0 days is the strict filter.
    """
    spark, run = store.spark, new_run_id()
    out = Loaded(dict(dims))
    state = store.read("etl_metadata")
    if state is None:
        state = store.put("etl_metadata", star.initial_state(spark, as_of))
    mark = out.watermark = star.read_watermark(state)
    orders = orders.select(*ORDER_COLS)
    taken = star.incremental_slice(orders, mark, lookback_days)
    if late_rows:
        taken = stage(spark, unlike_loaded(taken, store.read(DIGESTS)), run, "taken")
    out.taken = taken
    tried = taken.withColumn("_sliced", F.lit(True))
    before = held_before(store, ds)
    if before is not None:
        newest = orders.join(before.select("order_id"), "order_id", "left_semi").join(taken.select("order_id"), "order_id", "left_anti")
        older = before.join(orders.select("order_id"), "order_id", "left_anti")
        tried = tried.unionByName(newest.unionByName(older).withColumn("_sliced", F.lit(False)))
        tried = stage(spark, tried, run, "tried")
    fits, over = star.split_by_amount(tried)
    keys = {c: (dims["dim_date"], "date_key") for c in star.DATE_KEYS}
    # the other keys come from the dimensions themselves: only dates can dangle
    rows = star.fact_rows(fits, dims["dim_warehouse"], dims["dim_partner"], dims["dim_route"], kept=("_sliced",))
    rows = stage(spark, star.with_missing_keys(rows, keys), run, "fact_rows")
    bad = rows.where(F.size("_fk_columns") > 0).select("order_id", F.concat(
        F.lit("No row in the referenced dimension: "), F.array_join("_fk_columns", ", ")).alias("_quarantine_reason"))
    held = fits.join(bad, "order_id").unionByName(
        over.withColumn("_quarantine_reason", F.lit("Order value out of range"))).drop("_sliced")
    good = rows.where(F.size("_fk_columns") == 0).drop("_fk_columns")
    batches = star.upsert_table(store, FACT_TABLE, star.FACT, good.drop("_sliced"), "order_id", "delivery_key",
                                star.FACT_UPDATE_COLS, as_of, ds, ts_cols=("created_at",))
    mart_state.refresh(store, batches)
    if late_rows:
        done = with_digest(tried.drop("_sliced")).join(good.select("order_id"), "order_id", "left_semi")
        star.upsert_table(store, DIGESTS, DIGEST_SCHEMA, done.select("order_id", "order_date", "digest"), "order_id", None,
                          ["order_date", "digest"], as_of, ds, ts_cols=())
    out.held = sinks.quarantine(held, store.root, FACT_TABLE, None, as_of, ds)
    # the mark after the rows: a crash in between reloads the same slice, which the upsert absorbs
    last = good.where("_sliced").agg(F.date_format(F.to_date(F.max("order_date_key").cast("string"), "yyyyMMdd"), "yyyy-MM-dd"))
    loaded = last.first()[0]
    if loaded is not None and (mark is None or loaded > mark):
        store.put("etl_metadata", star.advance_watermark(state, loaded, as_of))
        out.watermark = loaded
    fact = store.read(FACT_TABLE)
    out.tables[FACT_TABLE] = star.empty(spark, star.FACT) if fact is None else fact
    out.tables["etl_metadata"] = store.read("etl_metadata")
    return out
