"""Composable data-quality rules.

A rule is a name, a description and one of: a ``Column`` factory that is TRUE
for a violating row, a function over Arrow batches, or a DataFrame of violating
rows. A ``Validator`` counts all ``Column`` rules in ONE aggregate pass and all
batch rules in one Python pass; a uniqueness rule is a grouped count with
map-side pre-aggregation, a referential rule a left-anti join. A rule that
cannot run, or fails while running, gets count -1 and the message, and the
others their counts: the pass is repeated over halves of the rules until the
failing one stands alone. Only rules that failed are asked for sample rows.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from typing import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulwise.contracts import EVENT_TYPES, ORDER_STATUSES, ROW_SEQ
from haulwise.functions.numbers import to_number
from haulwise.operators.joins import spread_lookup

REPORT_SCHEMA = "dataset string, rule string, description string, passed boolean, violation_count long"

#: Violating rows that a report names for a failed rule.
SAMPLES = 5


class QualityError(RuntimeError):
    """Rules failed and the caller asked for failure."""


@dataclass
class Rule:
    name: str
    description: str
    # row rules: df -> Column (TRUE = violation)
    mask: Callable[[DataFrame], Column] | None = None
    # batch rules: Arrow batch -> one boolean per row (TRUE = violation, null passes)
    batch: Callable[[pa.RecordBatch], object] | None = None
    # set rules: df -> DataFrame with one row per violating row
    violations: Callable[[DataFrame], DataFrame] | None = None
    # set rules with a cheaper count: df -> one-row DataFrame (violation_count)
    count: Callable[[DataFrame], DataFrame] | None = None

    def violation_rows(self, df: DataFrame) -> DataFrame:
        if self.mask is not None:
            return df.where(self.mask(df))
        if self.batch is not None:
            return df.mapInArrow(lambda batches: (b.filter(_flags(self, b)) for b in batches), df.schema)
        return self.violations(df)


def _flags(rule: Rule, batch: pa.RecordBatch) -> pa.Array:
    flags = rule.batch(batch)
    return flags if isinstance(flags, (pa.Array, pa.ChunkedArray)) else pa.array(flags, pa.bool_())


def _count_batches(rules: list[Rule]):
    """Per task: violations of every rule, and the message of the first error of a rule that fails."""
    def run(batches):
        counts, errors = dict.fromkeys((r.name for r in rules), 0), {}
        for batch in batches:
            for r in rules:
                try:
                    counts[r.name] += _flags(r, batch).true_count
                except Exception as e:  # noqa: BLE001 - whatever the caller's function raises
                    errors.setdefault(r.name, _message(e))
        yield pa.RecordBatch.from_pydict({"rule": list(counts), "n": list(counts.values()),
                                          "message": [errors.get(r) for r in counts]},
                                         pa.schema({"rule": pa.string(), "n": pa.int64(), "message": pa.string()}))
    return run


def _message(error: Exception) -> str:
    text = str(error).strip() or type(error).__name__
    return next((line for line in text.splitlines() if "USER_RAISED" in line or "error" in line.lower()), text.splitlines()[0])[:500]


# ------------------------------------------------------------ rule factories
def not_null(column: str) -> Callable[[DataFrame], Column]:
    return lambda df: F.col(column).isNull()


def non_negative(column: str) -> Callable[[DataFrame], Column]:
    """Numeric value < 0 violates; NULL and non-numeric text pass."""
    return lambda df: _numeric(df, column) < 0


def between(column: str, lo, hi) -> Callable[[DataFrame], Column]:
    """Inclusive range; NULL and non-numeric pass."""
    return lambda df: (_numeric(df, column) < lo) | (_numeric(df, column) > hi)


def in_set(column: str, values) -> Callable[[DataFrame], Column]:
    """Value outside ``values`` violates; NULL passes."""
    vals = list(values)
    return lambda df: F.col(column).isNotNull() & ~F.col(column).isin(*vals)


def _numeric(df: DataFrame, column: str) -> Column:
    dtype = df.schema[column].dataType.simpleString()
    if dtype == "string":
        return to_number(column)
    return F.col(column).cast("double")


def unique_values(column: str) -> Callable[[DataFrame], DataFrame]:
    """Every member of a duplicated value group violates (NULLs are equal).

    Value counts are pre-aggregated map-side; the duplicated values then
    select their rows with a null-safe semi join.
    """
    def rows(df: DataFrame) -> DataFrame:
        dups = df.groupBy(column).count().where(F.col("count") > 1).select(F.col(column).alias("_dup"))
        return df.join(dups, df[column].eqNullSafe(dups["_dup"]), "left_semi")
    return rows


def count_repeated(column: str) -> Callable[[DataFrame], DataFrame]:
    """Members of duplicated value groups, by one grouped count."""
    def count(df: DataFrame) -> DataFrame:
        return (df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
                .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violation_count")))
    return count


def referential_integrity(column: str, dim: DataFrame, dim_key: str,
                          row_id: str | None = None) -> Callable[[DataFrame], DataFrame]:
    """Non-NULL values with no matching dimension key violate. Rows without a value stay out of the join. ``row_id``: for
    a dimension (unique on its key) too large to broadcast, rows of a hot value are dealt out by it."""
    def rows(df: DataFrame) -> DataFrame:
        keys = dim.select(F.col(dim_key).alias("_k")).where(F.col("_k").isNotNull())
        if row_id is not None:
            return spread_lookup(df.where(F.col(column).isNotNull()), keys.withColumnRenamed("_k", column), column, row_id,
                                 how="left_anti").select(*df.columns)
        return df.where(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("_k"), "left_anti")
    return rows


# ------------------------------------------------------------------ runner
@dataclass
class Validator:
    rules: list[Rule] = field(default_factory=list)

    def add_rule(self, rule: Rule) -> "Validator":
        self.rules.append(rule)
        return self

    def _count_masks(self, df: DataFrame, rules: list[Rule]) -> dict[str, tuple[int, str | None]]:
        """Counts of row rules in one pass; a pass that fails is repeated over halves."""
        if not rules:
            return {}
        try:
            row = df.agg(*[F.count_if(F.coalesce(r.mask(df), F.lit(False))).alias(f"r{i}") for i, r in enumerate(rules)]).first()
            return {r.name: (row[i], None) for i, r in enumerate(rules)}
        except Exception as e:  # noqa: BLE001 - a rule may raise anything, here or in a task
            if len(rules) == 1:
                return {rules[0].name: (-1, _message(e))}
            half = len(rules) // 2
            return self._count_masks(df, rules[:half]) | self._count_masks(df, rules[half:])

    def counts(self, df: DataFrame) -> DataFrame:
        """(rule, violation_count, message) for every rule, one row per rule."""
        found = self._counted(df)
        return df.sparkSession.createDataFrame([(r.name, *found[r.name]) for r in self.rules],
                                               "rule string, violation_count long, message string")

    def _counted(self, df: DataFrame) -> dict[str, tuple[int, str | None]]:
        """Violations of every rule, or -1 and the message of one that cannot run or fails while running."""
        found = self._count_masks(df, [r for r in self.rules if r.mask is not None])
        batch_rules = [r for r in self.rules if r.batch is not None]
        if batch_rules:
            parts = df.mapInArrow(_count_batches(batch_rules), "rule string, n long, message string")
            for r in parts.groupBy("rule").agg(F.sum("n").alias("n"), F.min("message").alias("message")).collect():
                found[r.rule] = (r.n, None) if r.message is None else (-1, r.message)
            found = {r.name: (0, None) for r in batch_rules} | found  # no batch at all
        for r in self.rules:
            if r.mask is None and r.batch is None:
                try:
                    n = r.count(df) if r.count else r.violations(df).agg(F.count(F.lit(1)))
                    found[r.name] = (n.first()[0], None)
                except Exception as e:  # noqa: BLE001
                    found[r.name] = (-1, _message(e))
        return found

    def _report(self, df: DataFrame, dataset: str, counts: dict, details: dict) -> DataFrame:
        rows = [(dataset, r.name, r.description, counts[r.name][0] == 0, counts[r.name][0], i,
                 details.get(r.name, counts[r.name][1])) for i, r in enumerate(self.rules)]
        return df.sparkSession.createDataFrame(rows, f"{REPORT_SCHEMA}, rule_order int, message string")

    def report(self, df: DataFrame, dataset: str) -> DataFrame:
        """dataset, rule, description, passed, violation_count (rule order kept), message of a rule that could not run."""
        return self._report(df, dataset, self._counted(df), {})

    def first_violators(self, df: DataFrame, names: set[str], n: int = SAMPLES, order_col: str = ROW_SEQ) -> dict[str, str]:
        """The first ``n`` violating rows (in landing order) of the named rules, as text. Row rules share one pass; a
        task passes on at most ``n`` rows a rule."""
        rules = [r for r in self.rules if r.name in names]
        if not rules:
            return {}
        shown = [c for c in df.columns if not c.startswith("_")]
        text = F.concat(F.lit("{"), F.concat_ws(", ", *[
            F.concat(F.lit(f"{c}: "), F.coalesce(F.col(c).cast("string"), F.lit("NULL"))) for c in shown]), F.lit("}"))
        masks = F.filter(F.array(F.lit(None).cast("string"), *[F.when(r.mask(df), F.lit(r.name)) for r in rules if r.mask is not None]),
                         lambda x: x.isNotNull())
        rows = df.withColumn("rule", F.explode(masks)).select("rule", order_col, text.alias("row"))
        for r in rules:
            if r.mask is None:
                rows = rows.unionByName(r.violation_rows(df).select(F.lit(r.name).alias("rule"), order_col, text.alias("row")))
        first = rows.withColumn("_rank", F.row_number().over(Window.partitionBy("rule").orderBy(order_col))).where(F.col("_rank") <= n)
        out: dict[str, list[str]] = {}
        for r in first.orderBy("rule", "_rank").collect():  # at most n rows a rule
            out.setdefault(r.rule, []).append(r.row)
        return {rule: "Sample violations: " + ", ".join(x) for rule, x in out.items()}

    def full_report(self, df: DataFrame, dataset: str, checked_at: dt.datetime, order_col: str = ROW_SEQ) -> DataFrame:
        """The report with ``details`` (sample rows, or why a rule could not run) and ``checked_at``."""
        counts = self._counted(df)
        details = self.first_violators(df, {r for r, (n, _) in counts.items() if n > 0}, order_col=order_col)
        details |= {r: f"Check failed with error: {m}" for r, (_, m) in counts.items() if m is not None}
        return self._report(df, dataset, counts, details).select(
            "dataset", "rule", "description", "passed", "violation_count", F.col("message").alias("details"),
            F.lit(checked_at.isoformat()).alias("checked_at"), "rule_order")

    def samples(self, df: DataFrame, rule_name: str, n: int = 5, order_col: str = ROW_SEQ) -> DataFrame:
        """First ``n`` violating rows of one rule (in landing order)."""
        rule = next(r for r in self.rules if r.name == rule_name)
        rows = rule.violation_rows(df)
        if order_col in rows.columns:
            rows = rows.orderBy(order_col)
        return rows.limit(n)


# ----------------------------------------------------------------- suites
def orders_validator() -> Validator:
    return (Validator()
            .add_rule(Rule("order_id_not_null", "Order ID must not be null", mask=not_null("order_id")))
            .add_rule(Rule("order_id_unique", "Order ID must be unique", violations=unique_values("order_id"),
                           count=count_repeated("order_id")))
            .add_rule(Rule("order_value_positive", "Order value must be non-negative",
                           mask=non_negative("order_value_usd")))
            .add_rule(Rule("status_valid", "Status must be a valid value", mask=in_set("status", ORDER_STATUSES))))


def delivery_events_validator() -> Validator:
    return (Validator()
            .add_rule(Rule("event_id_not_null", "Event ID must not be null", mask=not_null("event_id")))
            .add_rule(Rule("duration_non_negative", "Delivery duration must be non-negative (physical constraint)",
                           mask=non_negative("delivery_duration_minutes")))
            .add_rule(Rule("event_type_valid", "Event type must be valid", mask=in_set("event_type", EVENT_TYPES))))


def warehouse_validator() -> Validator:
    return (Validator()
            .add_rule(Rule("quantity_non_negative", "Quantity on hand must be non-negative",
                           mask=non_negative("quantity_on_hand")))
            .add_rule(Rule("reorder_level_positive", "Reorder level must be positive",
                           mask=lambda df: _numeric(df, "reorder_level") <= 0)))


VALIDATORS = {
    "orders": orders_validator,
    "delivery_events": delivery_events_validator,
    "warehouse_inventory": warehouse_validator,
}


def orphan_count(fact: DataFrame, dim: DataFrame, fk: str = "warehouse_key") -> DataFrame:
    """Fact rows whose non-NULL key has no dimension row (one-row count)."""
    keys = dim.select(fk)
    return (fact.where(F.col(fk).isNotNull()).select(fk).join(keys, fk, "left_anti")
            .agg(F.count(F.lit(1)).alias("orphan_count")))


def quality_summary(report: DataFrame, orphans: DataFrame) -> DataFrame:
    """total_checks (suite rules only), failures (suite failures + orphan check)."""
    suite = report.select(F.lit(1).alias("c"), (~F.col("passed")).cast("long").alias("f"))
    orphan = orphans.select(F.lit(0).alias("c"), (F.col("orphan_count") > 0).cast("long").alias("f"))
    return (suite.unionByName(orphan)
            .agg(F.sum("c").cast("long").alias("total_checks"), F.sum("f").cast("long").alias("failures")))


def orphan_row(orphans: DataFrame, checked_at: dt.datetime) -> DataFrame:
    """The report row of the orphan check: one row if there are orphans, else none."""
    return orphans.where(F.col("orphan_count") > 0).select(
        F.lit("fact_deliveries").alias("dataset"), F.lit("orphan_warehouse_keys").alias("rule"),
        F.lit("Warehouse keys must exist in the warehouse dimension").alias("description"),
        F.lit(False).alias("passed"), F.col("orphan_count").cast("long").alias("violation_count"),
        F.lit(None).cast("string").alias("details"), F.lit(checked_at.isoformat()).alias("checked_at"))
