"""The daily batch job: extract -> validate -> standardize -> load -> quality.

``run_batch`` is the Spark re-expression of the reference's task chain. Each
stage ends in a written table, so a lost executor only recomputes from the last
one, and a rerun of the same ``ds`` replaces its own partitions instead of
adding to them. Wall-clock values are job arguments (``as_of``), never read
inside plans.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from haulwise.contracts import CONTRACTS, FACT_TABLE
from haulwise.operators import quality as dq
from haulwise.operators import star
from haulwise.operators import validation as val
from haulwise.operators.standardize import transform_source
from haulwise.plans import load
from haulwise.sources import landing, sinks
from haulwise.sources.lineage import with_lineage
from haulwise.sources.warehouse import WarehouseStore

SOURCE_ORDER = ("orders", "warehouse_inventory", "delivery_events", "partner_payments")


@dataclass
class BatchResult:
    transformed: dict[str, DataFrame] = field(default_factory=dict)
    tables: dict[str, DataFrame] = field(default_factory=dict)
    counts: dict[str, dict[str, int]] = field(default_factory=dict)
    watermark: str | None = None
    quality: DataFrame | None = None
    quality_summary: dict | None = None


def _stage(df: DataFrame, root: str, stage: str, source: str, ds: str) -> DataFrame:
    return landing.write_date(df, f"{root}/stage/{stage}/{source}", ds)


def _validate(raw: DataFrame, source: str, root: str, ds: str, as_of: dt.datetime) -> tuple[DataFrame | None, dict[str, int]]:
    """Route the feed's rows, fill its sinks; (valid rows, counts of what was written)."""
    contract = CONTRACTS[source]
    if val.missing_columns(raw, contract):
        whole = sinks.quarantine(val.validate_source(raw, source)["invalid"], root, source, None, as_of, ds)
        n = whole.count()
        return None, {"original": n, "quarantined": n, "kept": 0}
    tagged = landing.write_date(val.routed(raw, contract), f"{root}/stage/routed/{source}", ds, by=("_route",))
    found = val.routes(tagged)
    invalid = found["invalid"]
    reason = val.null_reason_text(val.batch_null_columns(invalid, contract))
    sinks.quarantine(val.with_null_reasons(invalid, contract, reason).drop("_null_columns"), root, source, None, as_of, ds)
    if contract.unique_key:
        sinks.duplicate_report(found["duplicates"], root, source, ds)
    n = {r["_route"]: r["count"] for r in tagged.groupBy("_route").count().collect()}
    return found["valid"], {"original": sum(n.values()), "quarantined": n.get(val.NULL, 0),
                            "kept": n.get(val.SINGLE, 0) + n.get(val.FIRST, 0)}


def extract_sources(spark: SparkSession, landing_dir: str, root: str, ds: str, as_of: dt.datetime,
                    multiline: dict[str, bool] | None = None) -> dict[str, DataFrame]:
    """Scan every landed feed that exists; a missing file is skipped, any other
    read error is raised. Surplus lines are kept under ``malformed/``."""
    out = {}
    for source in SOURCE_ORDER:
        c = CONTRACTS[source]
        path = f"{landing_dir.rstrip('/')}/{c.file_name}"
        wide = (multiline or {}).get(source, False)
        try:
            cols = landing.header_columns(spark, path, wide)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        out[source] = landing.land(spark, path, source, c.file_name, ds, as_of, root, cols, multiline=wide)
    return out


def run_batch(spark: SparkSession, feeds: dict[str, DataFrame], root: str, ds: str, as_of: dt.datetime,
              calendar: tuple[str, str] | None = None, lookback_days: int = 0, late_rows: bool = False,
              fail_on_error: bool = False, buckets: dict[str, int] | None = None) -> BatchResult:
    """Run one batch over already-scanned feeds (all-string + ``_row_seq``).

    ``lookback_days`` and ``late_rows``: see ``load.load_fact``. ``buckets``: see ``WarehouseStore``. ``fail_on_error``
    raises QualityError after the report is written if a rule failed.
    """
    if not feeds:
        raise ValueError("no input feeds")
    root = root.rstrip("/")
    res = BatchResult()
    store = WarehouseStore(spark, root, buckets)

    # ---- validate + standardize
    for source in SOURCE_ORDER:
        if source not in feeds:
            continue
        raw = feeds[source]
        if "_execution_date" not in raw.columns:
            raw = with_lineage(raw, CONTRACTS[source].file_name, ds, as_of)
        else:  # the run's date owns its partitions
            raw = raw.withColumn("_execution_date", F.lit(ds))
        valid, res.counts[source] = _validate(raw, source, root, ds, as_of)
        if valid is not None:
            res.transformed[source] = _stage(transform_source(valid, source), root, "transformed", source, ds)

    # ---- dimensions (full batch, not the incremental slice), calendar, incremental fact
    t = res.transformed
    orders, inventory, payments = t.get("orders"), t.get("warehouse_inventory"), t.get("partner_payments")
    members = {"dim_warehouse": star.warehouse_members(orders, inventory) if orders is not None or inventory is not None else None,
               "dim_partner": star.partner_members(orders, payments) if orders is not None and payments is not None else None,
               "dim_route": star.route_members(orders) if orders is not None else None}
    dims = load.load_dimensions(store, members, as_of, ds)
    dims["dim_date"] = load.load_calendar(store, *(calendar or star.calendar_range(as_of)), ds)
    if orders is not None:
        loaded = load.load_fact(store, orders, dims, as_of, ds, lookback_days, late_rows)
        res.tables, res.watermark = loaded.tables, loaded.watermark
    else:
        state = store.read("etl_metadata")
        res.tables, res.watermark = dims, None if state is None else star.read_watermark(state)

    # ---- quality on the standardized data + orphan check on the warehouse
    reports = [dq.VALIDATORS[s]().full_report(t[s], s, as_of).drop("rule_order")
               for s in SOURCE_ORDER if s in t and s in dq.VALIDATORS]
    if reports:
        rep = reports[0]
        for r in reports[1:]:
            rep = rep.unionByName(r)
        fact = store.read(FACT_TABLE)
        orphans = (dq.orphan_count(fact, dims["dim_warehouse"]) if fact is not None
                   else spark.createDataFrame([(0,)], "orphan_count long"))
        path = f"{root}/quality/_execution_date={ds}"
        rep.unionByName(dq.orphan_row(orphans, as_of)).write.mode("overwrite").parquet(path)
        res.quality = spark.read.parquet(path)
        suite = F.col("rule") != "orphan_warehouse_keys"
        row = res.quality.agg(F.count_if(suite).alias("total_checks"), F.count_if(~F.col("passed")).alias("failures")).first()
        res.quality_summary = {"total_checks": row["total_checks"], "failures": row["failures"]}
        if fail_on_error and row["failures"]:
            raise dq.QualityError(f"{row['failures']} of {row['total_checks']} quality checks failed")
    return res
