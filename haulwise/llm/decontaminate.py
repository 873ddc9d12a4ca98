r"""Benchmark decontamination by a prefix-filtered set join.

An item's windows are its runs of ``width`` consecutive words (an item with
fewer words, but some, is one window). A window's set is its word shingles
(three words, or the whole window if it is shorter). At containment 1 the
necessary prefix of a set is one shingle, so every window is joined by its
rarest one: shingles are ordered by their count over all documents. A match
gives the only place where the window can start; the length and positional
bounds drop starts outside the document, and the words of the window-sized
span are compared exactly.

The benchmark is the stated query set and is taken in blocks of about
``block_windows`` pairs of a window and an item and ``block_bytes`` of their
text at most, each broadcast to scan all documents (twice: shingle counts, then
matches), so memory does not grow with it. A sentence that many items share is
many pairs, dealt over the blocks. Documents are never shuffled; a passage that
a third of them share stays in its own rows.

Cases: null and empty texts have no words and no hits; an item without words
is ignored; repeated items count once per item id, a null item id is ignored;
repeated documents each get a row; an empty table on either side gives no
hits. Input columns are kept; the results are added after them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulwise.llm.store import materialize, prepare, renamed
from haulwise.llm.words import ALNUM, LOWER, flat, rolling, row_groups, word_table

SHINGLE = 3
CHUNK_BYTES = 2 << 20
#: Word bytes lower-cased, every other byte a space.
_SPACED_OUT = bytes(LOWER[b] if ALNUM[b] else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text with A-Z lower-cased."""
    return (text or "").encode("utf-8").translate(_SPACED_OUT).split()


def windows(items: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """Distinct pairs of a window and an item: item (id as string), window (words joined by a space), n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found, sizes = [], [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                for i in range(max(len(words) - width + 1, min(len(words), 1))):
                    part = words[i:i + width]
                    ids.append(item)
                    found.append(b" ".join(part).decode("utf-8"))
                    sizes.append(len(part))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(found, pa.string()),
                                              pa.array(sizes, pa.int32())], names=["item", "window", "n"])

    return items.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("string"), text_col) \
        .mapInArrow(run, "item string, window string, n int").distinct()


def _shingle_hashes(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """Per window its shingles' hashes in order, and its shingle length."""
    column = pa.array(texts, pa.string())
    buf, offsets = flat(column)
    hashes, first = word_table(buf, offsets, ALNUM, lower=True)
    k = np.minimum(np.diff(first), SHINGLE)
    return [rolling(hashes[a:b], int(n)) for a, b, n in zip(first[:-1], first[1:], k)], k


def _counts(docs: DataFrame, wanted) -> DataFrame:
    """Occurrences of each wanted shingle over all documents: k, hash, n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = wanted.value
        totals = {k: np.zeros(len(v), dtype=np.int64) for k, v in table.items()}
        for batch in batches:
            text = batch.column(0)
            for lo, hi in row_groups(flat(text)[1], CHUNK_BYTES):
                hashes, first = word_table(*flat(text.slice(lo, hi - lo)), ALNUM, lower=True)
                for k, keys in table.items():
                    _, _, at = _matches(hashes, first, k, keys)
                    totals[k] += np.bincount(at, minlength=len(keys))
        for k, keys in table.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), k, np.int32)), pa.array(keys.view(np.int64)),
                                              pa.array(totals[k])], names=["k", "hash", "n"])

    return docs.mapInArrow(run, "k int, hash long, n long").groupBy("k", "hash").agg(F.sum("n").alias("n"))


def _matches(hashes: np.ndarray, first: np.ndarray, k: int, keys: np.ndarray):
    """Row, word position in the row and key index of every k-word shingle among the sorted keys."""
    grams = rolling(hashes, k)
    at = np.searchsorted(keys, grams)
    at[at == len(keys)] = 0
    hit = np.flatnonzero(keys[at] == grams)
    row = np.searchsorted(first, hit, side="right") - 1
    inside = hit + k <= first[row + 1]
    hit, row = hit[inside], row[inside]
    return row, hit - first[row], at[hit]


def _prefixes(found: pa.Table, counts: dict[int, dict[int, int]]) -> dict:
    """The rarest shingle of every window (ties: the first): keys by length,
    and for each key its (window words, offset, word count, items)."""
    texts = found["window"].to_pylist()
    shingles, lengths = _shingle_hashes(texts)
    out: dict[int, dict[int, list]] = {}
    for text, items, n, grams, k in zip(texts, found["item_list"].to_pylist(), found["n"].to_pylist(), shingles,
                                        lengths.tolist()):
        offset = min(range(len(grams)), key=lambda o: (counts[k].get(int(grams[o]), 0), o))
        out.setdefault(k, {}).setdefault(int(grams[offset]), []).append((text.encode("utf-8"), offset, n, items))
    return {k: (keys := np.array(sorted(v), dtype=np.uint64), [v[int(x)] for x in keys]) for k, v in out.items()}


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _scan(text: pa.Array, prefixes: dict) -> Iterator[tuple[int, list[tuple[int, int]], set[str]]]:
    """Words, hit spans and items of each row of one chunk."""
    buf, offsets = flat(text)
    hashes, first, starts, ends = word_table(buf, offsets, ALNUM, lower=True, spans=True)
    raw = memoryview(buf)
    spans: dict[int, set] = {}
    items: dict[int, set] = {}
    for k, (keys, held) in prefixes.items():
        for row, pos, at in zip(*(x.tolist() for x in _matches(hashes, first, k, keys))):
            size = int(first[row + 1] - first[row])
            for window, offset, n, names in held[at]:
                begin = pos - offset
                if begin < 0 or begin + n > size:  # positional and length bounds
                    continue
                w = int(first[row]) + begin
                span = bytes(raw[starts[w]:ends[w + n - 1]]).translate(_SPACED_OUT)
                if b" ".join(span.split()) == window:
                    spans.setdefault(row, set()).add((begin, begin + n))
                    items.setdefault(row, set()).update(names)
    counts = np.diff(first).tolist()
    for row, n in enumerate(counts):
        yield n, _union(list(spans.get(row, ()))), items.get(row, set())


def contamination(docs: DataFrame, items: DataFrame, width: int = 10, id_col: str = "item_id",
                  item_text: str = "text", text_col: str = "text", block_windows: int = 500_000,
                  block_bytes: int = 128 << 20) -> DataFrame:
    """``docs`` and the columns _n_words, _hits (array of word spans), _items (ids as sorted strings), in place of
    input columns of these names."""
    docs = docs.drop("_n_words", "_hits", "_items")
    spark = docs.sparkSession
    prepare(spark)
    n, at = len(docs.columns), docs.columns.index(text_col)
    plain = docs.toDF(*[f"c{i}" for i in range(n)])
    hit = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    added = [T.StructField("n_words", T.LongType()), T.StructField("hits", hit),
             T.StructField("items", T.ArrayType(T.StringType()))]
    schema = T.StructType([*plain.schema.fields, *added])
    found = materialize(windows(items, width, id_col, item_text), "decontaminate-windows")
    size = F.octet_length("window") + F.octet_length("item")
    pairs, volume = found.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    blocks = max(1, -(-pairs // block_windows), -(-volume // block_bytes))
    out = plain.select("*", F.lit(None).cast("long").alias("n_words"), F.lit(None).cast(hit).alias("hits"),
                       F.lit(None).cast("array<string>").alias("items"))
    for block in range(blocks):
        part = found.where(F.pmod(F.xxhash64("window", "item"), F.lit(blocks)) == block).toArrow()  # about block_windows
        part = part.group_by(["window", "n"]).aggregate([("item", "list")])
        shingles, lengths = _shingle_hashes(part["window"].to_pylist())
        wanted = {int(k): np.unique(np.concatenate([g for g, x in zip(shingles, lengths) if x == k]))
                  for k in np.unique(lengths)}
        counts: dict[int, dict[int, int]] = {k: {} for k in wanted}
        if wanted:
            shared = spark.sparkContext.broadcast(wanted)
            for row in _counts(plain.select(f"c{at}"), shared).toArrow().to_pylist():  # one row per wanted shingle
                counts[row["k"]][row["hash"] % (1 << 64)] = row["n"]
        prefixes = spark.sparkContext.broadcast(_prefixes(part, counts))
        out = out.mapInArrow(_scanner(prefixes, n, at), schema)
        if block + 1 < blocks:
            out = materialize(out, f"decontaminate-block{block}")
    return out.toDF(*docs.columns, "_n_words", "_hits", "_items")


def _scanner(prefixes, n: int, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = prefixes.value
        for batch in batches:
            words, hits, names = [], [], []
            text = batch.column(at)
            for lo, hi in row_groups(flat(text)[1], CHUNK_BYTES):
                for size, spans, items in _scan(text.slice(lo, hi - lo), table):
                    i = len(words)
                    words.append(size)
                    before = [(x["start"], x["end"]) for x in batch.column(n + 1)[i].as_py() or ()]
                    hits.append([{"start": a, "end": b} for a, b in _union(spans + before)])
                    names.append(sorted(items | set(batch.column(n + 2)[i].as_py() or ())))
            span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n], pa.array(words, pa.int64()), pa.array(hits, span),
                 pa.array(names, pa.list_(pa.string()))],
                names=[*(f"c{i}" for i in range(n)), "n_words", "hits", "items"])

    return run


def keep_clean(docs: DataFrame, items: DataFrame, width: int = 10, text_col: str = "text") -> DataFrame:
    """``docs`` without those that hold a window of an item."""
    plain, name = renamed(docs)
    found = contamination(plain, items, width, text_col=name[text_col])
    return found.where(F.size("_hits") == 0).select(*plain.columns).toDF(*docs.columns)
