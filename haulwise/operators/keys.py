"""Surrogate keys: dense numbering in id order, one way at every size.

Rows are range-partitioned and sorted on the id, tagged with their partition
and place in it, and written to the shared folder, so that every later use sees
one numbering. The rows in the partitions before (one count per partition)
give each partition its offset. Key = start + offset + place. No task ever
holds more than its range.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulwise.sources.stage import stage


def number_rows(df: DataFrame, order_cols: list[str], key_col: str, start: int = 1) -> DataFrame:
    """Add ``key_col`` = start, start + 1, ... following ``order_cols`` (unique)."""
    ranged = df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols) \
        .withColumns({"_pid": F.spark_partition_id(), "_mid": F.monotonically_increasing_id()})
    written = stage(df.sparkSession, ranged, uuid.uuid4().hex[:12], "numbered")
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # a row per partition: window and broadcast are bounded by the partition count
    offsets = written.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n")) \
        .select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    place = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return written.join(F.broadcast(offsets), "_pid") \
        .withColumn(key_col, (F.lit(start) + F.col("_off") + place).cast("long")).drop("_pid", "_mid", "_off")
