"""Intermediate tables in the cluster's shared folder, and worker set-up."""

from __future__ import annotations

import contextlib
import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from haulwise.session import scratch_path

REPO_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package from the same path as the driver."""
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if REPO_ROOT not in parts:
        env["PYTHONPATH"] = os.pathsep.join([REPO_ROOT, *parts])


@contextlib.contextmanager
def _released_shuffles(spark: SparkSession):
    """Shuffle files of the jobs inside go as soon as their query has ended."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back.

    This cuts the lineage (a lost executor costs a re-read, not a rebuild) and
    releases the shuffle files the result was made from.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", f"{name}-{uuid.uuid4().hex[:12]}")
    with _released_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def renamed(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with columns c0, c1, ... and the new name of each old one, so
    that columns an operator adds never clash with the caller's."""
    names = {c: f"c{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names
