"""Lineage tags stamped on every landed row."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_lineage(df: DataFrame, source_file: str, ds: str, extracted_at: dt.datetime) -> DataFrame:
    """Add ``_extracted_at`` (one batch-wide ISO text), ``_source_file`` and
    ``_execution_date``. The timestamp is a job argument, not the wall clock,
    so recomputing a lost partition gives the same value."""
    return df.withColumns({
        "_extracted_at": F.lit(extracted_at.isoformat()),
        "_source_file": F.lit(source_file),
        "_execution_date": F.lit(ds),
    })
