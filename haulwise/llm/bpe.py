"""Byte-level BPE encoding and decoding with the tiktoken library.

Ranks come from a local file (its path is a parameter and must exist on the
workers), the split pattern from the caller. Long texts are cut at safe
boundaries (``boundaries.parts``) before the library sees them, which bounds
its working memory and leaves the ids as they are for the whole text. Decoding
joins raw bytes, so ids of one character that fall into two parts are no
matter. Documents are independent: no shuffle, nothing gathered.

Cases: null and empty texts have no ids and decode to empty bytes; repeated
rows each get a row; an empty table gives an empty result; input columns are
kept and results come after them.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulwise.llm.boundaries import parts
from haulwise.llm.store import prepare
from haulwise.llm.words import sliced

PART_CHARS = 1 << 16
#: Bytes of text or ids that a task holds at a time (a longer document stands alone).
BATCH = 2 << 20


@functools.lru_cache(maxsize=4)
def encoding(rank_file: str, pattern: str) -> tiktoken.Encoding:
    """The library's encoding for a rank file, without special tokens."""
    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def encode_text(enc: tiktoken.Encoding, text: str) -> np.ndarray:
    """Token ids of one text."""
    found = [np.array(enc.encode_ordinary(p), dtype=np.int32) for p in parts(text, PART_CHARS)]
    return np.concatenate(found) if found else np.empty(0, np.int32)


def _added(docs: DataFrame, kind: T.DataType, name: str) -> tuple[DataFrame, T.StructType]:
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return plain, T.StructType([*plain.schema.fields, T.StructField(name, kind)])


def encode(docs: DataFrame, rank_file: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``docs`` and the column _ids (array of int), in place of an input column of this name."""
    prepare(docs.sparkSession)
    docs = docs.drop("_ids")
    at = docs.columns.index(text_col)
    plain, schema = _added(docs, T.ArrayType(T.IntegerType()), "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(rank_file, pattern)
        for batch in sliced(batches, at, BATCH):
            ids = [encode_text(enc, t.as_py() or "") for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, _list(ids)], names=schema.names)

    return plain.mapInArrow(run, schema).toDF(*docs.columns, "_ids")


def decode(docs: DataFrame, rank_file: str, pattern: str, ids_col: str = "_ids") -> DataFrame:
    """``docs`` and the column _decoded (the raw bytes of the ids), in place of an input column of this name."""
    prepare(docs.sparkSession)
    docs = docs.drop("_decoded")
    at = docs.columns.index(ids_col)
    plain, schema = _added(docs, T.BinaryType(), "decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(rank_file, pattern)
        for batch in sliced(batches, at, BATCH):
            raw = [enc.decode_bytes(ids.values.to_numpy().tolist() if ids.is_valid else []) for ids in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(raw, pa.binary())], names=schema.names)

    return plain.mapInArrow(run, schema).toDF(*docs.columns, "_decoded")


def round_trip(docs: DataFrame, rank_file: str, pattern: str, text_col: str = "text") -> DataFrame:
    """encode and decode in one pass over the rows: ``docs`` without ``text_col``,
    and the columns _ids and _decoded, in place of input columns of these names (one Python worker a task instead of two)."""
    prepare(docs.sparkSession)
    docs = docs.drop("_ids", "_decoded")
    rest = [c for c in docs.columns if c != text_col]
    plain = docs.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{text_col}`")).toDF(*[f"c{i}" for i in range(len(docs.columns))])
    schema = T.StructType([*plain.schema.fields[:-1], T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(rank_file, pattern)
        for batch in sliced(batches, len(rest), BATCH):
            ids = [encode_text(enc, t.as_py() or "") for t in batch.column(len(rest))]
            raw = pa.array([enc.decode_bytes(i.tolist()) for i in ids], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], _list(ids), raw], names=schema.names)

    return plain.mapInArrow(run, schema).toDF(*rest, "_ids", "_decoded")


def _list(ids: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32)))


def ids_digest(ids_col: str) -> F.Column:
    """SHA-256 of the decimal ids joined by one space."""
    return F.sha2(F.array_join(F.col(ids_col).cast("array<string>"), " ").cast("binary"), 256)
