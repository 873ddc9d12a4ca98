"""Token counts: batch encoding that returns lengths only.

Every whole text is cut at safe boundaries into white-space-led pieces, whose
tokens do not depend on what stands around them. The pieces that a task has
not met yet go to the tokenizers library in batches balanced by bytes; their
lengths are kept (a bounded table, started anew when full) and summed per
text. Ids and offsets never leave the library, documents are never shuffled,
and a text that a third of all rows share costs only look-ups.

Special strings inside texts are the library's default matter: they hold no
white space, so no cut divides one.

Cases: null and empty texts have 0 tokens; repeated rows each get a row; an
empty table gives an empty result; input columns are kept and the result comes
after them.
"""

from __future__ import annotations

import functools
import itertools
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Tokenizer

from haulwise.llm.boundaries import PIECE
from haulwise.llm.store import prepare

#: UTF-8 bytes of a batch.
BATCH_CHARS = 1 << 20
PIECES_AT_ONCE = 200_000
KNOWN_PIECES = 1_000_000
KEPT_CHARS = 64


@functools.lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return Tokenizer.from_file(path)


def _size(text: str) -> int:
    """UTF-8 bytes of a text."""
    return len(text) if text.isascii() else len(text.encode("utf-8", "surrogatepass"))


def _balanced(pieces) -> Iterator[list[str]]:
    """Pieces in batches of about BATCH_CHARS bytes."""
    batch, size = [], 0
    for piece in pieces:
        batch.append(piece)
        size += _size(piece)
        if size >= BATCH_CHARS:
            yield batch
            batch, size = [], 0
    if batch:
        yield batch


class Counter:
    """Token counts of texts; remembers the lengths of short pieces it has met."""

    def __init__(self, path: str):
        self.tokenizer, self.known = tokenizer(path), {}

    def counts(self, texts: list[str | None]) -> list[int]:
        totals = [0] * len(texts)
        held, size = [], 0
        for row, text in enumerate(texts):
            own = _size(text or "")
            found = (m.group() for m in PIECE.finditer(text)) if own > BATCH_CHARS else None
            runs = iter(lambda: list(itertools.islice(found, PIECES_AT_ONCE)), []) if found else [PIECE.findall(text or "")]
            for pieces in runs:
                held.append((row, pieces))
                size += sum(map(_size, pieces)) if found else own
                if size >= BATCH_CHARS:
                    self._add(held, totals)
                    held, size = [], 0
        self._add(held, totals)
        return totals

    def _add(self, held: list[tuple[int, list[str]]], totals: list[int]) -> None:
        pieces = set().union(*(p for _, p in held))
        if len(self.known) + len(pieces) > KNOWN_PIECES:
            self.known = {}
        lengths = self.known
        for batch in _balanced(pieces.difference(lengths)):
            lengths.update(zip(batch, map(len, self.tokenizer.encode_batch_fast(batch, add_special_tokens=False))))
        for row, own in held:
            totals[row] += sum(map(lengths.__getitem__, own))
        for piece in pieces:
            if len(piece) > KEPT_CHARS:
                del lengths[piece]


@functools.lru_cache(maxsize=1)
def counter(path: str) -> Counter:
    """A worker's counter: what it has learnt serves its later tasks too."""
    return Counter(path)


def count_tokens(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``docs`` and the column _n_tokens, in place of an input column of this name."""
    docs = docs.drop("_n_tokens")
    prepare(docs.sparkSession)
    n, at = len(docs.columns), docs.columns.index(text_col)
    plain = docs.toDF(*[f"c{i}" for i in range(n)])
    schema = T.StructType([*plain.schema.fields, T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(path).counts
        for batch in batches:
            lengths = pa.array(counts(batch.column(at).to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, lengths], names=schema.names)

    return plain.mapInArrow(run, schema).toDF(*docs.columns, "_n_tokens")
