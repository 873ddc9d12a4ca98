"""Stage tables: intermediate results written once and read back.

A staged table lives under the shared checkpoint folder (``spark.checkpoint.dir``),
so it survives executor loss, cuts the lineage, and later reads get column
pruning, filter pushdown and file sizes (for Spark's join choice) from the
Parquet scan.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from haulwise.session import scratch_path


def new_run_id() -> str:
    return uuid.uuid4().hex[:12]


def stage(spark: SparkSession, df: DataFrame, run_id: str, name: str) -> DataFrame:
    path = scratch_path(spark, "stage", run_id, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)  # the schema is known: no footer read to infer it
