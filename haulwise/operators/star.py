"""Star schema: dimensions, calendar, keyed upserts, fact rows, watermark.

Every table is a DataFrame. ``upsert(target, source, ...)`` returns the next
content of a target as a DataFrame; ``upsert_table`` does the same to a written
warehouse table and touches only the folders that hold changed rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulwise.contracts import FACT_TABLE, INITIAL_WATERMARK, PARTNER_TYPE, WAREHOUSE_REGIONS
from haulwise.functions.numbers import NUMERIC_TEXT
from haulwise.operators.joins import lookup_join, only_possible, spread_lookup
from haulwise.operators.keys import number_rows
from haulwise.sources.stage import new_run_id, stage
from haulwise.sources.warehouse import PLACE, WarehouseStore

# ---------------------------------------------------------------- schemas
DIM_WAREHOUSE = "warehouse_key long, warehouse_id string, warehouse_name string, region string, created_at timestamp_ntz, updated_at timestamp_ntz"
DIM_PARTNER = "partner_key long, partner_id string, partner_name string, partner_type string, created_at timestamp_ntz, updated_at timestamp_ntz"
DIM_ROUTE = "route_key long, route_id string, origin string, destination string, distance_km int, created_at timestamp_ntz, updated_at timestamp_ntz"
DIM_DATE = "date_key int, full_date date, year int, quarter int, month int, day int, day_of_week int, is_weekend boolean"
FACT = ("delivery_key long, order_id string, warehouse_key long, partner_key long, route_key long, "
        "order_date_key int, promised_date_key int, actual_date_key int, order_value_usd decimal(12,2), "
        "is_on_time boolean, days_late int, delivery_duration_hours decimal(10,2), created_at timestamp_ntz")
ETL_METADATA = "table_name string, last_watermark string, updated_at timestamp_ntz"


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def _suffix_number(id_col: str) -> Column:
    """Integer after the first '_' of an id; NULL when not a number."""
    return F.split_part(F.col(id_col), F.lit("_"), F.lit(2)).try_cast("int")


# ------------------------------------------------------------ dim members
def warehouse_members(orders: DataFrame | None, inventory: DataFrame | None) -> DataFrame:
    """Distinct warehouse ids of orders if present, else of inventory."""
    src = orders if orders is not None else inventory
    return src.select("warehouse_id").where(F.col("warehouse_id").isNotNull()).distinct()


def partner_members(orders: DataFrame, payments: DataFrame) -> DataFrame:
    return orders.select("partner_id").union(payments.select("partner_id")) \
        .where(F.col("partner_id").isNotNull()).distinct()


def route_members(orders: DataFrame) -> DataFrame:
    return orders.select("route_id").where(F.col("route_id").isNotNull()).distinct()


# --------------------------------------------------------- dim attributes
def warehouse_attributes(members: DataFrame) -> DataFrame:
    n = _suffix_number("warehouse_id")
    regions = F.array(*[F.lit(r) for r in WAREHOUSE_REGIONS])
    return members.withColumns({
        "warehouse_name": F.concat(F.lit("Warehouse "), F.split_part(F.col("warehouse_id"), F.lit("_"), F.lit(2))),
        "region": F.element_at(regions, (F.pmod(n, F.lit(len(WAREHOUSE_REGIONS))) + 1).cast("int")),
    })


def partner_attributes(members: DataFrame) -> DataFrame:
    return members.withColumns({
        "partner_name": F.concat(F.lit("Partner "), F.split_part(F.col("partner_id"), F.lit("_"), F.lit(2))),
        "partner_type": F.lit(PARTNER_TYPE),
    })


def route_attributes(members: DataFrame) -> DataFrame:
    n = _suffix_number("route_id")
    return members.withColumns({
        "origin": F.concat(F.lit("City_"), F.pmod(n, F.lit(10)).cast("string")),
        "destination": F.concat(F.lit("City_"), F.pmod(n + 5, F.lit(10)).cast("string")),
        "distance_km": (F.lit(100) + F.pmod(n * 10, F.lit(500))).cast("int"),
    })


# ------------------------------------------------------------------ upsert
def upsert(target: DataFrame, source: DataFrame, key: str, key_col: str | None,
           update_cols: list[str], as_of: dt.datetime, ts_cols: tuple[str, ...] = ("created_at", "updated_at"),
           key_order: str | None = None, base_key: int | None = None) -> DataFrame:
    """``INSERT ... ON CONFLICT (key) DO UPDATE SET update_cols`` as joins.

    * matched: target row, with ``update_cols`` (and ``updated_at``) from source;
    * new: source row, new surrogate key after the current maximum (in
      ``key_order`` order), ``created_at`` = ``updated_at`` = ``as_of``;
    * untouched target rows are kept as they are.
    ``source`` must be unique on ``key``. ``base_key`` is the target's current
    maximum key when the caller knows it (0 for an empty target). The matched/untouched half is a left
    join of target to source, the new half a left-anti join of source to
    target; both shuffle on ``key`` and share the exchanges.
    """
    cols = target.columns
    stamp = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    src_cols = [c for c in source.columns if c in cols and c != key]
    upd = [c for c in update_cols if c in src_cols]
    s = source.select(key, *[F.col(c).alias(f"_s_{c}") for c in upd]).withColumn("_s_hit", F.lit(True))

    def keep(c):
        if c in upd:
            return F.when(F.col("_s_hit"), F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c)
        if c == "updated_at" and c in ts_cols:
            return F.when(F.col("_s_hit"), stamp).otherwise(F.col(c)).alias(c)
        return F.col(c)

    old = target.join(s, on=key, how="left").select(*[keep(c) for c in cols])
    fresh = source.join(target.select(key), on=key, how="left_anti")
    fill = {c: stamp for c in ts_cols if c in cols}
    fill.update({c: F.lit(None).cast(target.schema[c].dataType)
                 for c in cols if c not in source.columns and c not in fill and c != key_col})
    fresh = fresh.withColumns(fill) if fill else fresh
    if key_col is not None:
        base = base_key if base_key is not None else (target.agg(F.max(key_col)).first()[0] or 0)
        fresh = number_rows(fresh, [key_order or key], key_col, start=int(base) + 1)
    return old.unionByName(fresh.select(*[F.col(c).cast(target.schema[c].dataType) for c in cols]))


def upsert_table(store: WarehouseStore, table: str, schema: str, source: DataFrame, key: str, key_col: str | None,
                 update_cols: list[str], as_of: dt.datetime, batch: str,
                 ts_cols: tuple[str, ...] = ("created_at", "updated_at")) -> list[str]:
    """``upsert`` into a written table. Returns the batches that hold rows of ``source`` (the new ones among them).

    The target's keys and update columns meet the source's keys: other buckets are not read, and rows whose key is
    not in the source's bitmap are not shuffled. Rows that differ are rewritten with their (batch, bucket) folders, new
    ones are appended, with keys after the greatest (``key_col`` None: without). A table without ``updated_at`` is
    rewritten only where a value changes. ``source`` is read twice, so it should be a written table.
    """
    spark = store.spark
    fields = empty(spark, schema).schema
    stamp = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    upd = [c for c in update_cols if c in source.columns]
    run = new_run_id()
    rows = source.withColumn("_bucket", store.bucket(table, key))
    target = store.placed(table)
    fresh, base, batches, n_fresh = rows, 0, set(), None
    if target is not None:
        if key_col is not None:  # before any file of the target is replaced
            base = target.agg(F.max(key_col)).first()[0] or 0
        there = target
        if store.buckets.get(table, 1) > 1:
            touched = [r[0] for r in rows.select("_bucket").distinct().collect()]  # at most store.buckets
            there = only_possible(target.where(F.col("_bucket").isin(touched)), rows, key)
        there = there.select(key, "_batch", *[F.col(c).alias(f"_t_{c}") for c in upd])
        met = stage(spark, rows.join(there, key, "left"), run, f"{table}_met")
        fresh = met.where(F.col("_batch").isNull())
        differs = F.lit("updated_at" in ts_cols)
        for c in upd:
            differs = differs | ~F.col(c).eqNullSafe(F.col(f"_t_{c}"))
        changed = met.where(F.col("_batch").isNotNull() & differs)
        # a row for each folder met, at most batches times buckets
        folders = met.groupBy(*PLACE).agg(F.max(differs).alias("differs"), F.count(F.lit(1)).alias("n")).collect()
        n_fresh = sum(r.n for r in folders if r["_batch"] is None)
        batches = {r["_batch"] for r in folders if r["_batch"] is not None}
        if pairs := [(r["_batch"], r["_bucket"]) for r in folders if r["_batch"] is not None and r.differs]:
            where = F.struct(*PLACE).isin([F.struct(F.lit(b), F.lit(n)) for b, n in pairs])
            new = changed.select(key, *[F.col(c).alias(f"_s_{c}") for c in upd], F.lit(True).alias("_s_hit"))
            joined = target.where(where).join(new, key, "left")
            put = {c: F.when(F.col("_s_hit"), F.col(f"_s_{c}")).otherwise(F.col(c)) for c in upd}
            if "updated_at" in ts_cols:
                put["updated_at"] = F.when(F.col("_s_hit"), stamp).otherwise(F.col("updated_at"))
            store.replace(table, joined.withColumns(put).select(*target.columns))
    if n_fresh != 0:
        numbered = fresh if key_col is None else number_rows(fresh, [key], key_col, start=int(base) + 1)
        fill = {f.name: stamp if f.name in ts_cols else F.lit(None) for f in fields if f.name not in numbered.columns}
        store.append(table, numbered.withColumns(fill).select(*[F.col(f.name).cast(f.dataType) for f in fields]), key, batch)
    return sorted(batches | {batch})


def load_dim_warehouse(target: DataFrame, members: DataFrame, as_of: dt.datetime,
                       base_key: int | None = None) -> DataFrame:
    return upsert(target, warehouse_attributes(members), "warehouse_id", "warehouse_key",
                  ["warehouse_name", "region"], as_of, base_key=base_key)


def load_dim_partner(target: DataFrame, members: DataFrame, as_of: dt.datetime,
                     base_key: int | None = None) -> DataFrame:
    return upsert(target, partner_attributes(members), "partner_id", "partner_key", [], as_of, base_key=base_key)


def load_dim_route(target: DataFrame, members: DataFrame, as_of: dt.datetime,
                   base_key: int | None = None) -> DataFrame:
    return upsert(target, route_attributes(members), "route_id", "route_key", [], as_of, base_key=base_key)


# ---------------------------------------------------------------- calendar
def calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day in [start, end]; Monday = 0, weekend = Sat/Sun."""
    d0 = dt.date.fromisoformat(start)
    n = (dt.date.fromisoformat(end) - d0).days + 1
    day = F.date_add(F.lit(d0), F.col("id").cast("int"))
    return (spark.range(max(n, 0)).select(day.alias("full_date"))
            .select(F.date_format("full_date", "yyyyMMdd").cast("int").alias("date_key"),
                    "full_date",
                    F.year("full_date").alias("year"), F.quarter("full_date").alias("quarter"),
                    F.month("full_date").alias("month"), F.dayofmonth("full_date").alias("day"),
                    F.weekday("full_date").alias("day_of_week"),
                    (F.weekday("full_date") >= 5).alias("is_weekend")))


def calendar_range(as_of: dt.datetime, back_days: int = 730, ahead_days: int = 365) -> tuple[str, str]:
    d = as_of.date()
    return ((d - dt.timedelta(days=back_days)).isoformat(), (d + dt.timedelta(days=ahead_days)).isoformat())


def load_dim_date(target: DataFrame, days: DataFrame) -> DataFrame:
    """Insert-if-absent: existing dates are never touched."""
    return target.unionByName(days.join(target.select("date_key"), "date_key", "left_anti"))


# --------------------------------------------------------------- watermark
def initial_state(spark: SparkSession, as_of: dt.datetime) -> DataFrame:
    return spark.createDataFrame([(FACT_TABLE, INITIAL_WATERMARK, as_of)], ETL_METADATA)


def read_watermark(state: DataFrame, table: str = FACT_TABLE) -> str | None:
    row = state.where(F.col("table_name") == table).select("last_watermark").first()
    return None if row is None else row[0]


def incremental_slice(orders: DataFrame, watermark: str | None, lookback_days: int = 0) -> DataFrame:
    """Rows strictly after the watermark (ISO text comparison); NULL dates drop.

    With no watermark every row is kept. ``lookback_days`` > 0 re-reads that
    many days before the watermark (late rows are then upserted, not lost).
    """
    if watermark is None:
        return orders
    bound = F.lit(watermark)
    if lookback_days:
        bound = F.date_format(F.date_sub(F.lit(watermark).cast("date"), lookback_days), "yyyy-MM-dd")
    return orders.where(F.col("order_date") > bound)


def slice_max_date(slice_df: DataFrame) -> DataFrame:
    """One-row frame with the slice's maximum order_date (NULL if empty)."""
    return slice_df.agg(F.max("order_date").alias("last_watermark"))


def advance_watermark(state: DataFrame, new_mark: str | None, as_of: dt.datetime,
                      table: str = FACT_TABLE) -> DataFrame:
    """Next state: the table's mark replaced when ``new_mark`` is set."""
    if not new_mark:
        return state
    row = state.sparkSession.createDataFrame([(table, new_mark, as_of)], ETL_METADATA)
    return state.where(F.col("table_name") != table).unionByName(row)


# -------------------------------------------------------------------- fact
def date_key(iso_text) -> Column:
    c = F.col(iso_text) if isinstance(iso_text, str) else iso_text
    return F.date_format(c.try_cast("date"), "yyyyMMdd").cast("int")


def fact_rows(slice_df: DataFrame, dim_w: DataFrame | None = None, dim_p: DataFrame | None = None,
              dim_r: DataFrame | None = None, kept: tuple[str, ...] = (), spread: tuple[str, ...] = ()) -> DataFrame:
    """Orders slice -> fact columns (no delivery_key / created_at yet), and the ``kept`` columns of the slice.

    Surrogate keys come from left lookups (unmatched -> NULL key), which never add rows as dimensions are unique on their
    ids; the key of a dimension that is not given is left out. ``spread`` names dimensions (warehouse, partner, route) too
    large to broadcast: their hot members are dealt out.
    """
    o = slice_df.select("order_id", "warehouse_id", "partner_id", "route_id", "order_date",
                        "promised_delivery_date", "actual_delivery_date", "order_value_usd",
                        "is_on_time", "days_late", *kept)
    keys = []
    for dim, name in ((dim_w, "warehouse"), (dim_p, "partner"), (dim_r, "route")):
        if dim is not None:
            pair = dim.select(f"{name}_id", f"{name}_key")
            o = spread_lookup(o, pair, f"{name}_id", "order_id") if name in spread else lookup_join(o, pair, f"{name}_id")
            keys.append(f"{name}_key")
    return o.select(
        "order_id", *keys,
        date_key("order_date").alias("order_date_key"),
        date_key("promised_delivery_date").alias("promised_date_key"),
        date_key("actual_delivery_date").alias("actual_date_key"),
        F.col("order_value_usd").try_cast("decimal(12,2)").alias("order_value_usd"),
        "is_on_time",
        F.col("days_late").cast("int").alias("days_late"),
        (F.col("days_late") * 24).try_cast("decimal(10,2)").alias("delivery_duration_hours"), *kept,
    )


FACT_UPDATE_COLS = ["is_on_time", "days_late", "delivery_duration_hours"]


def load_fact(target: DataFrame, rows: DataFrame, as_of: dt.datetime, base_key: int | None = None) -> DataFrame:
    """Upsert fact rows by order_id: only the three delivery metrics update."""
    return upsert(target, rows, "order_id", "delivery_key", FACT_UPDATE_COLS, as_of,
                  ts_cols=("created_at",), base_key=base_key)


def fk_violations(fact: DataFrame, dim_w: DataFrame, dim_p: DataFrame, dim_r: DataFrame,
                  dim_d: DataFrame) -> DataFrame:
    """Fact rows whose non-NULL foreign key has no dimension row, found in one pass over the fact.

    One output row per (order_id, fk column) violation.
    """
    dims = {"warehouse_key": (dim_w, "warehouse_key"), "partner_key": (dim_p, "partner_key"), "route_key": (dim_r, "route_key"),
            **{c: (dim_d, "date_key") for c in DATE_KEYS}}
    bad = with_missing_keys(fact.select("order_id", *dims), dims).where(F.size("_fk_columns") > 0)
    value = F.create_map(*[x for c in dims for x in (F.lit(c), F.col(c).cast("long"))])
    return bad.select("order_id", F.explode("_fk_columns").alias("fk_column"), value.alias("_value")) \
        .select("order_id", "fk_column", F.col("_value")[F.col("fk_column")].alias("fk_value"))


def split_by_amount(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(orders whose value the fact can hold or that have none, the others).

    A numeric order value that overflows would otherwise turn into NULL.
    """
    over = F.col("order_value").rlike(NUMERIC_TEXT) & F.col("order_value_usd").try_cast("decimal(12,2)").isNull()
    over = F.coalesce(over, F.lit(False))
    return orders.where(~over), orders.where(over)


#: Keys of the fact that refer to the calendar.
DATE_KEYS = ("order_date_key", "promised_date_key", "actual_date_key")


def with_missing_keys(rows: DataFrame, dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """``rows`` and ``_fk_columns``: the foreign keys that are not NULL and that their dimension lacks.

    ``dims`` maps a foreign-key column to the (table, key) it refers to. One pass: a flag per key from a lookup, no row
    is read twice.
    """
    out = rows
    for col, (dim, key) in dims.items():
        out = lookup_join(out, dim.select(F.col(key).alias(col)).withColumn(f"_has_{col}", F.lit(True)), col)
    bad = F.filter(F.array(*[F.when(F.col(c).isNotNull() & F.col(f"_has_{c}").isNull(), F.lit(c)) for c in dims]),
                   lambda c: c.isNotNull())
    return out.withColumn("_fk_columns", bad).select(*rows.columns, "_fk_columns")


def split_by_foreign_keys(rows: DataFrame, dims: dict[str, tuple[DataFrame, str]]) -> tuple[DataFrame, DataFrame]:
    """(rows whose non-NULL keys all exist, the others with ``_fk_columns``)."""
    flagged = with_missing_keys(rows, dims)
    good = flagged.where(F.size("_fk_columns") == 0).drop("_fk_columns")
    return good, flagged.where(F.size("_fk_columns") > 0)
