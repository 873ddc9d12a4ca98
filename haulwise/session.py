"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. Shuffle partitions and file split size are
# left to the cluster's own defaults unless the caller passes them.
_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    # Standardization projections generate large methods; HotSpot skips JIT
    # compilation of methods over 8000 bytecodes by default, which leaves
    # them interpreted and several times slower.
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def get_spark(app: str = "haulwise", master: str | None = None,
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine defaults applied."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared, fault-tolerant folder and is
    used as is. Only in local mode (tests) may it be unset; a private scratch
    folder is created then.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="haulwise-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "haulwise", *parts])
