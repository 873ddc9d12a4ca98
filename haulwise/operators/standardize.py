"""Standardization of validated feeds: one projection per source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulwise.contracts import CONTRACTS
from haulwise.functions import standardize_category, to_number, to_usd
from haulwise.functions.dates import with_date, with_dates, with_timestamp_text


def with_optional_columns(df: DataFrame, source: str) -> DataFrame:
    """Add absent optional columns as typed NULL (or their default literal)."""
    contract = CONTRACTS[source]
    add = {c: F.lit(v).cast("string") for c, v in contract.optional_defaults.items() if c not in df.columns}
    return df.withColumns(add) if add else df


def days_late(actual, promised):
    """Whole days actual - promised; NULL if either is NULL."""
    return F.datediff(actual, promised)


def is_on_time(late):
    """Three-valued: late <= 0, NULL stays NULL."""
    return late <= 0


def _iso_date(c: str):
    return F.col(c).cast("string")  # a DATE of four-digit years, as ``with_dates`` gives it


def transform_orders(df: DataFrame) -> DataFrame:
    df = with_optional_columns(df, "orders")
    # each date text is parsed once into a helper DATE column
    p = with_dates(df, {"order_date": "_od", "promised_delivery_date": "_pd", "actual_delivery_date": "_ad"})
    return (p.withColumns({
        "order_date": _iso_date("_od"),
        "promised_delivery_date": _iso_date("_pd"),
        "actual_delivery_date": _iso_date("_ad"),
        "status": standardize_category("status"),
        "order_value_usd": to_usd("order_value", "currency"),
        "days_late": days_late(F.col("_ad"), F.col("_pd")),
    }).withColumn("is_on_time", is_on_time(F.col("days_late"))).drop("_od", "_pd", "_ad"))


def transform_delivery_events(df: DataFrame) -> DataFrame:
    df = with_optional_columns(df, "delivery_events")
    p = (with_timestamp_text(df, "event_timestamp", "_ts")
         .withColumn("_min", to_number("delivery_duration_minutes")))
    minutes = F.col("_min")
    return p.withColumns({
        "event_timestamp": F.col("_ts"),
        "event_type": standardize_category("event_type"),
        # flag computed before negatives are nulled: NULL counts as valid
        "is_valid_duration": F.coalesce(minutes >= 0, F.lit(True)),
        "delivery_duration_minutes": F.when(~(minutes < 0), minutes),
    }).drop("_ts", "_min")


def transform_partner_payments(df: DataFrame) -> DataFrame:
    df = with_optional_columns(df, "partner_payments")
    return with_date(df, "payment_date", "_pay").withColumns({
        "payment_date": _iso_date("_pay"),
        "payment_status": standardize_category("payment_status"),
        "amount_usd": to_usd("amount", "currency"),
    }).drop("_pay")


def transform_warehouse_inventory(df: DataFrame) -> DataFrame:
    df = with_optional_columns(df, "warehouse_inventory")
    p = with_timestamp_text(df, "last_updated", "_lu").withColumns(
        {"_q": to_number("quantity_on_hand"), "_l": to_number("reorder_level")})
    qty, lvl = F.col("_q"), F.col("_l")
    return p.withColumns({
        "quantity_on_hand": qty,
        "reorder_level": lvl,
        "last_updated": F.col("_lu"),
        "needs_reorder": F.coalesce(qty < lvl, F.lit(False)),
    }).drop("_q", "_l", "_lu")


TRANSFORMS = {
    "orders": transform_orders,
    "delivery_events": transform_delivery_events,
    "partner_payments": transform_partner_payments,
    "warehouse_inventory": transform_warehouse_inventory,
}


def transform_source(df: DataFrame, source: str) -> DataFrame:
    """Dispatch by source name; unknown sources pass through unchanged."""
    f = TRANSFORMS.get(source)
    return df.transform(f) if f else df
