"""Quarantine and duplicate-report sinks.

Rows are written under ``{root}/{kind}/source={source}/_execution_date={ds}``.
A run replaces the folder of its date, by nothing if there is nothing to
report, so a clean rerun leaves no rows of the run before.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulwise.sources.landing import write_date


def quarantine(df: DataFrame, root: str, source: str, reason: str | None, at: dt.datetime, ds: str) -> DataFrame:
    """Stamp reason and time on rejected rows and put them in the sink of the date."""
    out = df.withColumns({"_quarantine_reason": F.coalesce(F.col("_quarantine_reason"), F.lit(reason))
                          if "_quarantine_reason" in df.columns else F.lit(reason),
                          "_quarantined_at": F.lit(at.isoformat())})
    return write_date(out, f"{root.rstrip('/')}/quarantine/source={source}", ds)


def duplicate_report(df: DataFrame, root: str, source: str, ds: str) -> None:
    write_date(df, f"{root.rstrip('/')}/duplicates/source={source}", ds)
