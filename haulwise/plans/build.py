"""Assembly of one batch: feeds -> validated -> standardized -> star schema.

``Batch`` lazily builds each product once per instance. Products are plain
DataFrames, so callers can explain, join or write any of them.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from haulwise.contracts import CONTRACTS, INITIAL_WATERMARK
from haulwise.operators import star
from haulwise.operators.standardize import transform_source
from haulwise.operators.validation import validate_source
from haulwise.plans.load import load_calendar, load_dimensions, load_fact
from haulwise.session import scratch_path
from haulwise.sources.feeds import derive_feed
from haulwise.sources.lineage import with_lineage
from haulwise.sources.stage import new_run_id, stage
from haulwise.sources.warehouse import WarehouseStore

# fixed job parameters used by the registered queries
DS = "2001-08-02"
AS_OF = dt.datetime(2001, 8, 2, 0, 0, 0)
AS_OF_2 = dt.datetime(2001, 9, 2, 0, 0, 0)
CALENDAR = ("1994-01-01", "2002-12-31")
#: Wide enough that no date of the feeds dangles.
LOAD_CALENDAR = ("1970-01-01", "2030-12-31")
BATCH1_LAST_DATE = "2000-06-30"
SOURCES = ("orders", "warehouse_inventory", "delivery_events", "partner_payments")


def second_batch_orders(orders_raw: DataFrame) -> DataFrame:
    """Next day's orders feed: every order again, and for k % 70 = 5 a late
    re-delivery (order date 2001-09-01, delivered 3 days later, value x2)."""
    hit = (F.col("_row_seq") / 2).cast("long") % 70 == 5
    later = F.date_format(F.date_add(F.col("actual_delivery_date").try_cast("date"), 3), "yyyy-MM-dd")
    doubled = (F.col("order_value").try_cast("decimal(12,2)") * 2).cast("string")
    return orders_raw.withColumns({
        "order_date": F.when(hit, F.lit("2001-09-01")).otherwise(F.col("order_date")),
        "actual_delivery_date": F.when(hit, later).otherwise(F.col("actual_delivery_date")),
        "order_value": F.when(hit, doubled).otherwise(F.col("order_value")),
    })


class _Lazy:
    """Mapping view that builds a value on first access."""

    def __init__(self, fn):
        self.fn = fn

    def __getitem__(self, key):
        return self.fn(key)


class Batch:
    """All products of one batch over the tables in ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str, ds: str = DS, as_of: dt.datetime = AS_OF,
                 calendar: tuple[str, str] = CALENDAR):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.ds = ds
        self.as_of = as_of
        self.calendar_range = calendar
        self.run_id = new_run_id()
        self._staged: dict[str, DataFrame] = {}
        self._validated: dict[str, dict] = {}
        self._raw: dict[str, DataFrame] = {}

    # ---------------------------------------------------------- ingest
    def raw(self, source: str) -> DataFrame:
        """The landing feed with lineage (``k`` helper column dropped)."""
        if source not in self._raw:
            df = derive_feed(self.spark, self.sf_dir, source)
            if "k" in df.columns:
                df = df.drop("k")
            self._raw[source] = with_lineage(df, CONTRACTS[source].file_name, self.ds, self.as_of)
        return self._raw[source]

    def validation(self, source: str) -> dict:
        """Validation products of one feed (built on first use)."""
        if source not in self._validated:
            self._validated[source] = validate_source(self.raw(source), source)
        return self._validated[source]

    @property
    def validated(self) -> "_Lazy":
        return _Lazy(self.validation)

    def valid(self, source: str) -> DataFrame:
        return self.validated[source]["valid"]

    def standardized(self, source: str) -> DataFrame:
        """Validated + standardized feed, staged once per batch (it feeds
        several dimensions, the fact and the quality suites)."""
        if source not in self._staged:
            self._stage(source, self.valid(source))
        return self._staged[source]

    def _stage(self, source: str, valid: DataFrame) -> None:
        self._staged[source] = stage(self.spark, transform_source(valid, source), self.run_id, f"{source}_transformed")

    def validated_rows(self, source: str) -> int:
        """Rows of the validated feed, counted by the pass that stages the standardized one. They are counted after the
        dedupe's shuffle, in the job's result stage, where a task that runs again counts once."""
        valid = self.valid(source)
        if source not in self._staged:
            seen = Observation()
            self._stage(source, valid.observe(seen, F.count(F.lit(1)).alias("n")))
            if (n := seen.get.get("n")) is not None:
                return n
        return valid.count()

    @property
    def transformed(self) -> "_Lazy":
        return _Lazy(self.standardized)

    # ------------------------------------------------------------ load
    def _table(self, name: str, df: DataFrame) -> DataFrame:
        """Write a warehouse table once; later plans scan it."""
        return stage(self.spark, df, self.run_id, name)

    def _members(self, name: str, df: DataFrame) -> DataFrame:
        """Distinct natural ids, written once: numbering them samples and sorts
        them, and neither should recompute the feed."""
        return stage(self.spark, df, self.run_id, f"{name}_members")

    @cached_property
    def dim_warehouse(self) -> DataFrame:
        # orders when present, else inventory (never their union)
        # ids of the staged orders: a distinct over a written table is cheap
        # to recompute, so no member list is written
        members = star.warehouse_members(self.transformed["orders"], None)
        return self._table("dim_warehouse", star.load_dim_warehouse(
            star.empty(self.spark, star.DIM_WAREHOUSE), members, self.as_of, base_key=0))

    @cached_property
    def dim_partner(self) -> DataFrame:
        # standardization does not touch partner_id: the validated payments
        # feed gives the same members without staging the whole transform
        payments = self._staged.get("partner_payments")
        if payments is None:
            payments = self.valid("partner_payments")
        members = self._members("partner", star.partner_members(self.transformed["orders"], payments))
        return self._table("dim_partner", star.load_dim_partner(
            star.empty(self.spark, star.DIM_PARTNER), members, self.as_of, base_key=0))

    @cached_property
    def dim_route(self) -> DataFrame:
        members = star.route_members(self.transformed["orders"])
        return self._table("dim_route", star.load_dim_route(
            star.empty(self.spark, star.DIM_ROUTE), members, self.as_of, base_key=0))

    @cached_property
    def dim_date(self) -> DataFrame:
        return star.load_dim_date(star.empty(self.spark, star.DIM_DATE),
                                  star.calendar(self.spark, *self.calendar_range))

    @cached_property
    def state(self) -> DataFrame:
        return star.initial_state(self.spark, self.as_of)

    @cached_property
    def watermark(self) -> str | None:
        # a first load starts from the seeded watermark; no need to read it
        return INITIAL_WATERMARK

    @cached_property
    def fact_slice(self) -> DataFrame:
        return star.incremental_slice(self.transformed["orders"], self.watermark)

    @cached_property
    def fact_rows(self) -> DataFrame:
        return star.fact_rows(self.fact_slice, self.dim_warehouse, self.dim_partner, self.dim_route)

    @cached_property
    def fact(self) -> DataFrame:
        return star.load_fact(star.empty(self.spark, star.FACT), self.fact_rows, self.as_of, base_key=0)

    def mart_fact(self, *names: str) -> DataFrame:
        """The rows of a first load without delivery_key, which no mart reads, with the keys of the named dimensions."""
        return star.fact_rows(self.fact_slice, **{f"dim_{n[0]}": getattr(self, f"dim_{n}") for n in names})

    @cached_property
    def payments_clean(self) -> DataFrame:
        """The ``partner_payments_clean`` relation read by the reconciliation."""
        return self.transformed["partner_payments"]


class TwoBatchLoad:
    """Batch 1 (orders dated up to 2000-06-30) then batch 2 (every order
    again plus late re-deliveries) loaded onto the batch-1 warehouse."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.b = Batch(spark, sf_dir)

    @cached_property
    def orders1(self) -> DataFrame:
        return self.b.transformed["orders"].where(F.col("order_date") <= BATCH1_LAST_DATE)

    @cached_property
    def orders2(self) -> DataFrame:
        raw2 = second_batch_orders(self.b.raw("orders"))
        df = transform_source(validate_source(raw2, "orders")["valid"], "orders")
        return stage(self.spark, df, self.b.run_id, "orders2_transformed")

    @cached_property
    def _payment_partners(self) -> DataFrame:
        """Distinct partners of the validated payments, written once: both
        loads need them and the payments feed is the largest input."""
        ids = self.b.valid("partner_payments").select("partner_id").where(F.col("partner_id").isNotNull()).distinct()
        return stage(self.spark, ids, self.b.run_id, "payment_partners")

    @cached_property
    def store(self) -> WarehouseStore:
        return WarehouseStore(self.spark, scratch_path(self.spark, "warehouse", self.b.run_id))

    def _load(self, orders: DataFrame, as_of: dt.datetime, ds: str) -> dict[str, DataFrame]:
        """One load into the written warehouse: dimensions from the full batch, the fact from the slice after the
        watermark. Tables are read where the load left them."""
        members = {"dim_warehouse": star.warehouse_members(orders, None),
                   "dim_partner": star.partner_members(orders, self._payment_partners),
                   "dim_route": star.route_members(orders)}
        dims = load_dimensions(self.store, members, as_of, ds)
        dims["dim_date"] = load_calendar(self.store, *LOAD_CALENDAR, ds)
        found = load_fact(self.store, orders, dims, as_of, ds)
        return {**found.tables, "slice": found.taken}

    @cached_property
    def load1(self) -> dict[str, DataFrame]:
        return self._load(self.orders1, self.b.as_of, "2001-08-02")

    @cached_property
    def load2(self) -> dict[str, DataFrame]:
        self.load1  # noqa: B018 - the second load comes on top of the first
        return self._load(self.orders2, AS_OF_2, "2001-09-02")
