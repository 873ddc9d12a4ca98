"""Landing CSV scan: every column text, pandas-compatible edge handling.

* Columns come from the header; every value is read as a string (no type
  inference: messy text is kept for validation to judge).
* NA tokens (``contracts.NA_TOKENS``) become NULL.
* A line with MORE fields than the header is left out and kept by
  ``keep_malformed``; a line with FEWER fields is padded with NULL. Spark's PERMISSIVE mode flags both
  in a corrupt-record column; the flagged text's field count (quoted
  sections collapsed first) tells them apart.
* ``_row_seq`` captures file order: (file, block start, position in split).
* ``multiLine`` (quoted newlines) is a per-feed option, off unless asked for:
  it makes each file a single split.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulwise.contracts import ROW_SEQ
from haulwise.functions.text import na_to_null
from haulwise.sources.lineage import with_lineage

__all__ = ["extract", "field_count", "header_columns", "keep_malformed", "malformed_lines", "scan_feed",
           "land", "with_lineage", "write_date"]

BAD = "_bad"
QUOTED = r'"([^"]|"")*"'


def _reader(spark: SparkSession, header: bool, multiline: bool):
    return (spark.read.option("header", header).option("multiLine", multiline)
            .option("enforceSchema", False)  # a file with other columns than the header read first fails, never by position
            .option("escape", '"').option("quote", '"').option("encoding", "UTF-8")
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD))


def header_columns(spark: SparkSession, path: str, multiline: bool = False) -> list[str]:
    """Column names from the feed's header row."""
    return _reader(spark, True, multiline).csv(path).columns


def field_count(text_col) -> F.Column:
    """Number of CSV fields in a raw line (quoted commas do not count)."""
    return F.size(F.split(F.regexp_replace(text_col, QUOTED, "q"), ",", -1))


def scan_feed(spark: SparkSession, path: str, columns: list[str] | None = None,
              header: bool = True, multiline: bool = False) -> DataFrame:
    """All-string scan of a landing CSV (file or folder of files)."""
    cols = list(columns) if columns else header_columns(spark, path, multiline)
    schema = ", ".join(f"`{c}` string" for c in cols) + f", {BAD} string"
    df = _reader(spark, header, multiline).schema(schema).csv(path)
    keep = F.col(BAD).isNull() | (field_count(F.col(BAD)) <= len(cols))
    seq = F.struct(F.col("_metadata.file_path").alias("file"),
                   F.col("_metadata.file_block_start").alias("block"),
                   F.monotonically_increasing_id().alias("pos"))
    return df.where(keep).select(seq.alias(ROW_SEQ), *[na_to_null(F.col(f"`{c}`")).alias(c) for c in cols])


def malformed_lines(spark: SparkSession, path: str, columns: list[str], header: bool = True,
                    multiline: bool = False) -> DataFrame:
    """The lines with more fields than the header: line, fields, values (the first ones), file."""
    schema = ", ".join(f"`{c}` string" for c in columns) + f", {BAD} string"
    df = _reader(spark, header, multiline).schema(schema).csv(path)
    # all columns are read: a pruned scan does not see that a line is too long
    return (df.select(F.col(BAD).alias("line"), field_count(F.col(BAD)).alias("fields"),
                      F.array(*[F.col(f"`{c}`") for c in columns]).alias("values"), F.col("_metadata.file_path").alias("file"))
            .where(F.col("fields") > len(columns)))


def write_date(df: DataFrame, path: str, ds: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Replace the ``_execution_date=ds`` folder of ``path`` with ``df``, which
    may be empty, and read it back (an empty frame empties the folder: a rerun
    never sees rows of the run before). ``by``: columns that part the folder."""
    body = df.drop("_execution_date")
    out = f"{path.rstrip('/')}/_execution_date={ds}"
    body.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*by).parquet(out)
    return df.sparkSession.read.schema(body.schema).parquet(out).withColumn("_execution_date", F.lit(ds))


def extract(spark: SparkSession, path: str, source: str, source_file: str, ds: str, extracted_at: dt.datetime,
            stage_root: str, columns: list[str] | None = None, header: bool = True,
            multiline: bool = False) -> DataFrame:
    """Scan + lineage, written to the stage under ``_execution_date`` (a rerun
    replaces its own date, also by nothing), read back.

    Staging also materializes the corrupt-record filter: Spark refuses
    queries that only touch the corrupt-record column of a raw CSV scan.
    """
    df = with_lineage(scan_feed(spark, path, columns, header, multiline), source_file, ds, extracted_at)
    return write_date(df, f"{stage_root.rstrip('/')}/extracted/{source}", ds)


def land(spark: SparkSession, path: str, source: str, source_file: str, ds: str, extracted_at: dt.datetime, root: str,
         columns: list[str], header: bool = True, multiline: bool = False) -> DataFrame:
    """``extract`` and ``keep_malformed`` from one read of the files: every line goes to its part of one written table,
    and the surplus ones from there to their sink."""
    schema = ", ".join(f"`{c}` string" for c in columns) + f", {BAD} string"
    df = _reader(spark, header, multiline).schema(schema).csv(path)
    fields = F.when(F.col(BAD).isNotNull(), field_count(F.col(BAD)))
    seq = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                   F.monotonically_increasing_id().alias("pos"))
    surplus = F.coalesce(fields > len(columns), F.lit(False))
    rows = df.select(seq.alias(ROW_SEQ), *[na_to_null(F.col(f"`{c}`")).alias(c) for c in columns],
                     F.when(surplus, F.struct(F.col(BAD).alias("line"), fields.alias("fields"),
                                              F.array(*[F.col(f"`{c}`") for c in columns]).alias("values"),
                                              F.col("_metadata.file_path").alias("file"))).alias("_surplus"),
                     surplus.alias("_malformed"))
    both = write_date(with_lineage(rows, source_file, ds, extracted_at), f"{root.rstrip('/')}/stage/landed/{source}", ds, by=("_malformed",))
    write_date(both.where("_malformed").select("_surplus.*"), f"{root.rstrip('/')}/malformed/source={source}", ds)
    return both.where("NOT _malformed").drop("_surplus", "_malformed")


def keep_malformed(spark: SparkSession, path: str, source: str, columns: list[str], root: str, ds: str,
                   header: bool = True, multiline: bool = False) -> DataFrame:
    """The surplus lines that the scan leaves out, kept under ``malformed/`` for the date."""
    lines = malformed_lines(spark, path, columns, header, multiline)
    return write_date(lines, f"{root.rstrip('/')}/malformed/source={source}", ds)
