"""Warehouse tables: plain Parquet folders, partitioned so that a load touches few files.

A table lies under ``{root}/{table}/_batch={date}/_bucket={n}``: the batch that
first loaded a row, and a hash of its natural key. New rows are appended to
their batch; changed rows are rewritten together with the (batch, bucket)
folders that hold them, and no other file is touched. Rewritten rows are staged
before the folders are replaced, as a table is never read and overwritten at
the same path in one job.

There is no log beside the data. A load that dies half-way is repeated: rows it
appended are found again by their keys, rows it rewrote no longer differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from haulwise.contracts import FACT_TABLE
from haulwise.sources.stage import new_run_id, stage

DIGESTS = "order_digests"
PLACE = ("_batch", "_bucket")


class WarehouseStore:
    """Tables under ``root``. ``buckets`` (table: number, 1 if not named) must be the same for every load."""

    def __init__(self, spark: SparkSession, root: str, buckets: dict[str, int] | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = {FACT_TABLE: 8, DIGESTS: 8} | (buckets or {})
        self._schemas: dict[str, T.StructType] = {}  # of tables written or read here: no footers are read to infer them

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def bucket(self, table: str, key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets.get(table, 1))).cast("int")

    def placed(self, table: str) -> DataFrame | None:
        """The table with ``_batch`` and ``_bucket``, or None if it was never written."""
        if table in self._schemas:
            return self.spark.read.schema(self._schemas[table]).parquet(self.path(table))
        try:
            found = self.spark.read.parquet(self.path(table))
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None
        self._note(table, found)
        return self.spark.read.schema(self._schemas[table]).parquet(self.path(table))

    def _note(self, table: str, rows: DataFrame) -> None:
        body = [f for f in rows.schema.fields if f.name not in PLACE]
        self._schemas[table] = T.StructType([*body, T.StructField("_batch", T.StringType()), T.StructField("_bucket", T.IntegerType())])

    def read(self, table: str) -> DataFrame | None:
        found = self.placed(table)
        return None if found is None else found.drop(*PLACE)

    def append(self, table: str, rows: DataFrame, key: str, batch: str) -> None:
        """Add rows to their batch, one file per bucket."""
        placed = rows.withColumns({"_batch": F.lit(batch), "_bucket": self.bucket(table, key)})
        if self.buckets.get(table, 1) > 1:
            placed = placed.repartition("_bucket")
        placed.write.mode("append").partitionBy(*PLACE).parquet(self.path(table))
        self._note(table, placed)

    def replace(self, table: str, placed: DataFrame, reads_itself: bool = True) -> None:
        """Put whole (batch, bucket) folders in the place of those that ``placed`` has rows of. Rows made from the
        table itself are staged first."""
        body = stage(self.spark, placed, new_run_id(), f"replace_{table}") if reads_itself else placed
        self._note(table, placed)
        body.repartition(*PLACE).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy(*PLACE).parquet(self.path(table))

    def put(self, table: str, rows: DataFrame) -> DataFrame:
        """A table of a few rows (the load's state), written whole: one batch, one bucket."""
        kept = self.spark.createDataFrame(rows.collect(), rows.schema)
        self.replace(table, kept.withColumns({"_batch": F.lit("all"), "_bucket": F.lit(0)}), reads_itself=False)
        return self.read(table)
