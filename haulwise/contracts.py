"""Fixed values the engine must share with the feeds it reads.

Everything in this module is a constant: contract column lists, the NA
tokens a CSV reader treats as missing, exchange rates, valid category sets
and dimension attribute lists. They are stated plainly and in natural order.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values: text tokens read as missing (default NA list of pandas'
# CSV reader). Exact match, case-sensitive, no trimming.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# --- fixed values: static exchange rates to USD. Unknown or missing currency
# converts at 1.0.
EXCHANGE_RATES = {"USD": "1.00", "EUR": "1.10", "GBP": "1.27"}

# --- fixed values: valid category sets used by the quality suites.
ORDER_STATUSES = ("pending", "shipped", "delivered", "cancelled")
EVENT_TYPES = ("picked_up", "in_transit", "out_for_delivery", "delivered", "exception")

# --- fixed values: dimension attributes derived from id suffixes.
WAREHOUSE_REGIONS = ("North", "South", "East", "West")
PARTNER_TYPE = "carrier"

# --- fixed values: initial fact watermark seeded by the warehouse DDL.
INITIAL_WATERMARK = "1900-01-01"
FACT_TABLE = "fact_deliveries"


@dataclass(frozen=True)
class SourceContract:
    """Presence / nullness / uniqueness contract of one landing feed."""

    name: str
    file_name: str
    columns: tuple[str, ...]
    required: tuple[str, ...]
    nullable: tuple[str, ...] = ()
    unique_key: str | None = None
    # optional columns the standardizer reads; missing ones become NULL
    optional_defaults: dict = field(default_factory=dict)

    @property
    def not_null(self) -> tuple[str, ...]:
        """Required columns minus the explicitly nullable ones, in order."""
        return tuple(c for c in self.required if c not in self.nullable)


CONTRACTS: dict[str, SourceContract] = {
    "orders": SourceContract(
        name="orders",
        file_name="orders.csv",
        columns=("order_id", "warehouse_id", "partner_id", "route_id", "order_date",
                 "promised_delivery_date", "actual_delivery_date", "order_value",
                 "currency", "status"),
        required=("order_id", "warehouse_id", "route_id", "order_date", "order_value", "status"),
        nullable=("partner_id", "actual_delivery_date"),
        unique_key="order_id",
        optional_defaults={"currency": "USD", "partner_id": None,
                           "promised_delivery_date": None, "actual_delivery_date": None},
    ),
    "warehouse_inventory": SourceContract(
        name="warehouse_inventory",
        file_name="warehouse_inventory.csv",
        columns=("inventory_id", "warehouse_id", "sku", "quantity_on_hand",
                 "reorder_level", "last_updated"),
        required=("inventory_id", "warehouse_id", "sku", "quantity_on_hand"),
        nullable=("quantity_on_hand",),
        unique_key="inventory_id",
        optional_defaults={"reorder_level": None, "last_updated": None},
    ),
    "delivery_events": SourceContract(
        name="delivery_events",
        file_name="delivery_events.csv",
        columns=("event_id", "order_id", "event_type", "event_timestamp", "location",
                 "delivery_duration_minutes"),
        required=("event_id", "order_id", "event_type", "event_timestamp"),
        nullable=("delivery_duration_minutes",),
        unique_key="event_id",
        optional_defaults={"delivery_duration_minutes": None, "location": None},
    ),
    "partner_payments": SourceContract(
        name="partner_payments",
        file_name="partner_payments.csv",
        columns=("payment_id", "partner_id", "amount", "currency", "payment_date",
                 "payment_status", "reference_order_ids"),
        required=("payment_id", "partner_id", "payment_date", "payment_status"),
        nullable=("amount",),
        unique_key="payment_id",
        optional_defaults={"amount": None, "currency": "USD"},
    ),
}

# lineage columns added at scan time
LINEAGE_COLUMNS = ("_extracted_at", "_source_file", "_execution_date")
# capture of file order, used for first-wins dedupe and sample ordering
ROW_SEQ = "_row_seq"
