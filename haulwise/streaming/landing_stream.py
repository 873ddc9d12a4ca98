"""Landed CSV files -> batch job, each file processed once.

``process_landed`` starts a file-source stream over a landing folder with an
all-string schema (the feed contract's columns), and runs ``on_batch`` for
every micro-batch with ``Trigger.AvailableNow``: it processes what has landed
since the last run and stops. The stream checkpoint (in the shared
checkpoint folder) records processed files, so reruns skip them, and the
batch job's idempotent upserts absorb a micro-batch replayed after a crash.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulwise.contracts import CONTRACTS, ROW_SEQ
from haulwise.functions.text import na_to_null
from haulwise.sources.landing import BAD, field_count


def landed_stream(spark: SparkSession, source: str, landing_dir: str, multiline: bool = False) -> DataFrame:
    """Streaming scan of one feed's landing folder (same rules as the batch scan).

    A file whose header is not the contract's column list, in order, fails the
    stream: columns are never taken by position alone.
    """
    cols = list(CONTRACTS[source].columns)
    schema = ", ".join(f"`{c}` string" for c in cols) + f", {BAD} string"
    df = (spark.readStream.schema(schema).option("header", True).option("multiLine", multiline)
          .option("enforceSchema", False)
          .option("escape", '"').option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD)
          .csv(landing_dir))
    keep = F.col(BAD).isNull() | (field_count(F.col(BAD)) <= len(cols))
    return df.where(keep).select(F.col("_metadata.file_path").alias("_file"),
                                 F.col("_metadata.file_block_start").alias("_block"),
                                 *[na_to_null(F.col(f"`{c}`")).alias(c) for c in cols])


def _with_row_seq(df: DataFrame) -> DataFrame:
    """File order inside a micro-batch (positions need a static frame)."""
    seq = F.struct(F.col("_file").alias("file"), F.col("_block").alias("block"),
                   F.monotonically_increasing_id().alias("pos"))
    return df.withColumn(ROW_SEQ, seq).drop("_file", "_block")


def process_landed(spark: SparkSession, source: str, landing_dir: str, checkpoint_dir: str,
                   on_batch: Callable[[DataFrame, int], None], multiline: bool = False) -> None:
    """Run ``on_batch(df, batch_id)`` over files landed since the last run."""
    q = (landed_stream(spark, source, landing_dir, multiline).writeStream
         .foreachBatch(lambda df, batch_id: on_batch(_with_row_seq(df), batch_id))
         .option("checkpointLocation", checkpoint_dir)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
