r"""Substring dedup: Rabin-Karp hashes of every fixed-length word window.

A window (``width`` consecutive words ``[^\x20\x09-\x0D]+`` of one document) is
repeated if the same word sequence starts in a document with a smaller id.
Words covered by repeated windows go; windows are judged on the input.

How: a task hashes its documents in chunks. Within a chunk a window that also
starts in a smaller document of the chunk is settled at once; only the windows
of the smallest document are sent on, so a passage in a third of all documents
costs a row per chunk, not per document. What is left is grouped by hash range
(``bucket``), one packed row per chunk and bucket; the bucket finds the
smallest id of each hash and sends back the positions that lost. They meet
again by chunk and merge into maximal intervals per document, which are
written to the shared folder, and a merge join by document cuts the words.

The number of buckets follows the bytes of text (one Spark aggregate), so a
bucket's size does not grow with the corpus. A chunk splits its windows into
at most ``fan`` ranges; where more buckets are needed, rows of one range are
gathered from many chunks and split again, so the work and the rows of a
chunk do not grow with the corpus either.

Windows are equal if two hashes of them are: Rabin-Karp modulo 2^64 and modulo
2^31 - 1, over two independent word hashes without polynomial structure. Of n
windows about n^2 / 2^96 pairs are expected to agree by chance: 0.003 at the
1.6e13 windows of 100 TB.

A recomputed task must see its rows in the same order (row numbers name
documents between the steps): true of files and of written tables, so an input
that comes out of a shuffle is to be written first.

Cases: null, empty and short texts have no window and lose nothing (null text
stays null); rows with one id are never repeats of each other; a null id
counts as larger than every id; repeated rows give repeated results; an empty
table gives an empty result; other columns are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulwise.llm.store import materialize, prepare, renamed
from haulwise.llm.words import SPACED, flat, rolling, rolling_prime, sliced, text_slices, word_keys, word_table

NO_ID = np.iinfo(np.int64).max
CUT_BYTES = 4 << 20
#: Windows that a refining task holds before it sends them on.
REFINE_WINDOWS = 2 << 20
#: kind 0: windows; 1: positions lost within a chunk; 2: ids and text hashes of a chunk. chunks: of each run, null if all are ``chunk``.
_ENTRIES = ("chunk long, bucket int, kind int, hashes binary, checks binary, doc binary, chunks binary, row binary, "
            "runs binary, pos binary")
_LOST = "chunk long, kind int, row binary, runs binary, pos binary"
_SPANS = "doc_id long, text_hash long, starts array<int>, ends array<int>"


def _pack(values: np.ndarray) -> bytes:
    """Differences of integers as byte planes: small ones leave planes of zeros."""
    values = np.ascontiguousarray(values)
    step = np.diff(values, prepend=values.dtype.type(0))
    return step.view(np.uint8).reshape(len(values), values.dtype.itemsize).T.tobytes()


def _unpack(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(data, dtype=np.uint8).reshape(size, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(kind).ravel(), dtype=kind)


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of each run of equal neighbours."""
    if not len(values):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return first, np.diff(np.append(first, len(values)))


def _classes(hashes: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of equal windows (both hashes), and first index and length of each run of them."""
    order = np.argsort(hashes, kind="stable")
    h, c = hashes[order], checks[order]
    same = h[1:] == h[:-1]
    if (same & (c[1:] != c[:-1])).any():
        order = np.lexsort((checks, hashes))
        h, c = hashes[order], checks[order]
        same = (h[1:] == h[:-1]) & (c[1:] == c[:-1])
    first = np.flatnonzero(np.concatenate([[True], ~same])) if len(h) else np.empty(0, np.int64)
    return order, first, np.diff(np.append(first, len(h)))


def _row(chunk: int, bucket: int, kind: int, rows: np.ndarray, pos: np.ndarray, windows: tuple | None = None,
         ids: np.ndarray | None = None) -> dict:
    """Entries in order of (row, position), packed: hashes whole, the rest as runs and differences."""
    first, length = _runs(rows)
    return {"chunk": chunk, "bucket": bucket, "kind": kind,
            "hashes": None if windows is None else windows[0].tobytes(),
            "checks": None if windows is None else windows[1].tobytes(),
            "doc": None if ids is None else _pack(ids[rows[first]]), "chunks": None,
            "row": _pack(rows[first].astype(np.int32)),
            "runs": length.astype(np.uint32).tobytes(), "pos": _pack(pos.astype(np.int32))}


def _bucket(chunk: int, buckets: int) -> int:
    """Bucket of a chunk's own rows, from all bits of its number (the finaliser of SplitMix64)."""
    whole = (1 << 64) - 1
    chunk = (chunk ^ chunk >> 30) * 0xBF58476D1CE4E5B9 & whole
    chunk = (chunk ^ chunk >> 27) * 0x94D049BB133111EB & whole
    return (chunk ^ chunk >> 31) % buckets


def _range(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each hash: equal ranges of its upper half."""
    return (hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)


def _hash_chunk(ids: np.ndarray, column: pa.Array, chunk: int, width: int, buckets: int) -> Iterator[dict]:
    buf, offsets = flat(column)
    _, first, starts, ends = word_table(buf, offsets, SPACED, spans=True, hashes=False)
    one, two = word_keys(buf, starts, ends)
    counts = np.diff(first)
    row_of = np.repeat(np.arange(len(ids), dtype=np.int32), counts)
    pos = np.arange(len(one), dtype=np.int64) - first[row_of]
    windows, checks = rolling(one, width), rolling_prime(two, width)
    whole = np.flatnonzero(pos[:len(windows)] <= counts[row_of[:len(windows)]] - width)
    windows, checks, rows, pos = windows[whole], checks[whole], row_of[whole], pos[whole].astype(np.int32)
    if not len(windows):
        return
    order, start, length = _classes(windows, checks)
    doc = ids[rows[order]]
    lost = doc > np.repeat(np.minimum.reduceat(doc, start), length)
    here = np.sort(order[lost])
    if len(here):
        yield _row(chunk, _bucket(chunk, buckets), 1, rows[here], pos[here])
    order = order[~lost]
    edges = np.searchsorted(_range(windows[order], buckets), np.arange(buckets + 1, dtype=np.uint64))
    for bucket in np.flatnonzero(np.diff(edges)).tolist():
        at = np.sort(order[edges[bucket]:edges[bucket + 1]])
        yield _row(chunk, bucket, 0, rows[at], pos[at], (windows[at], checks[at]), ids)


def _windows(row: dict) -> dict:
    """The windows of a packed row, one array entry each."""
    length = np.frombuffer(row["runs"], dtype=np.uint32)
    each = lambda name, kind: np.repeat(_unpack(row[name], kind), length)
    n = int(length.sum())
    return {"hashes": np.frombuffer(row["hashes"], dtype=np.uint64), "checks": np.frombuffer(row["checks"], dtype=np.uint32),
            "doc": each("doc", np.int64), "row": each("row", np.int32), "pos": _unpack(row["pos"], np.int32),
            "chunk": np.full(n, row["chunk"], dtype=np.int64) if row["chunks"] is None else each("chunks", np.int64)}


def _refined(parts: list[dict], buckets: int) -> Iterator[dict]:
    """Windows of one range from many chunks, as one packed row per bucket."""
    found = {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}
    bucket = _range(found["hashes"], buckets)
    order = np.argsort(bucket, kind="stable")  # rows and positions of a chunk stay in order
    first, length = _runs(bucket[order])
    for a, n in zip(first, length):
        at = order[a:a + n]
        chunk, row = found["chunk"][at], found["row"][at]
        new = np.flatnonzero(np.concatenate([[True], (chunk[1:] != chunk[:-1]) | (row[1:] != row[:-1])]))
        yield {"chunk": None, "bucket": int(bucket[at[0]]), "kind": 0, "hashes": found["hashes"][at].tobytes(),
               "checks": found["checks"][at].tobytes(), "doc": _pack(found["doc"][at][new]), "chunks": _pack(chunk[new]),
               "row": _pack(row[new]), "runs": np.diff(np.append(new, len(at))).astype(np.uint32).tobytes(),
               "pos": _pack(found["pos"][at])}


def refine(batches: Iterator[pa.RecordBatch], fan: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``fan`` ranges as rows of ``buckets`` (a multiple) buckets."""
    schema = _arrow(_ENTRIES)
    held: dict[int, list[dict]] = {}
    size = 0

    def packed(rows) -> Iterator[pa.RecordBatch]:
        yield from pa.Table.from_pylist(list(rows), schema).combine_chunks().to_batches()

    for batch in batches:
        for row in batch.to_pylist():
            if row["kind"]:
                yield from packed([row | {"bucket": row["bucket"] * (buckets // fan)}])
                continue
            part = _windows(row)
            held.setdefault(row["bucket"], []).append(part)
            size += len(part["pos"])
            if size >= REFINE_WINDOWS:
                for parts in held.values():
                    yield from packed(_refined(parts, buckets))
                held, size = {}, 0
    for parts in held.values():
        yield from packed(_refined(parts, buckets))


def _judge(table: pa.Table) -> Iterator[dict]:
    """One bucket: positions of windows that a smaller document also has."""
    hashes, checks, docs, parts = [], [], [], []
    for row in table.to_pylist():
        if row["kind"] == 1:
            yield {k: row[k] for k in ("chunk", "kind", "row", "runs", "pos")}
            continue
        found = _windows(row)
        hashes.append(found["hashes"])
        checks.append(found["checks"])
        docs.append(found["doc"])
        parts.append((row["chunk"] if row["chunks"] is None else found["chunk"], found["row"], found["pos"]))
    if not parts:
        return
    hashes, checks, docs = np.concatenate(hashes), np.concatenate(checks), np.concatenate(docs)
    order, start, length = _classes(hashes, checks)
    low = np.minimum.reduceat(docs[order], start)
    lost = np.empty(len(hashes), dtype=bool)
    lost[order] = docs[order] > np.repeat(low, length)
    a = 0
    for chunk, rows, pos in parts:
        here = np.flatnonzero(lost[a:a + len(rows)])
        a += len(rows)
        if not len(here):
            continue
        of = np.full(len(here), chunk) if np.isscalar(chunk) else chunk[here]
        order = np.lexsort((pos[here], rows[here], of))
        here, of = here[order], of[order]
        for b, n in zip(*_runs(of)):
            out = _row(int(of[b]), 0, 1, rows[here[b:b + n]], pos[here[b:b + n]])
            yield {k: out[k] for k in ("chunk", "kind", "row", "runs", "pos")}


def _merge(table: pa.Table, width: int) -> dict:
    """One chunk: its documents' lost windows as maximal intervals."""
    ids = hashes = None
    rows, pos = [], []
    cols = [table.column(c).to_pylist() for c in ("kind", "row", "runs", "pos")]
    for kind, row, runs, p in zip(*cols):
        if kind == 2:
            ids, hashes = np.frombuffer(row, dtype=np.int64), np.frombuffer(runs, dtype=np.int64)
        else:
            rows.append(np.repeat(_unpack(row, np.int32), np.frombuffer(runs, dtype=np.uint32)))
            pos.append(_unpack(p, np.int32))
    out = {"doc_id": [], "text_hash": [], "starts": [], "ends": []}
    if not rows:
        return out
    key = np.sort(np.concatenate(rows).astype(np.int64) << 32 | np.concatenate(pos))
    row, at = key >> 32, key & 0xFFFFFFFF
    new = np.concatenate([[True], (row[1:] != row[:-1]) | (at[1:] > at[:-1] + width)])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(key)) - 1
    owner, starts, ends = row[first], at[first], at[last] + width
    begin, length = _runs(owner)
    for b, n in zip(begin, length):
        out["doc_id"].append(int(ids[owner[b]]))
        out["text_hash"].append(int(hashes[owner[b]]))
        out["starts"].append(starts[b:b + n])
        out["ends"].append(ends[b:b + n])
    return out


def repeated_spans(docs: DataFrame, width: int = 13, id_col: str = "doc_id", text_col: str = "text",
                   chunk_bytes: int = 4 << 20, bucket_bytes: int = 8 << 20, least_buckets: int = 64,
                   fan: int = 1024) -> DataFrame:
    """Maximal removal intervals: doc_id (NO_ID for null), text_hash, and word positions starts / ends (exclusive)."""
    spark = docs.sparkSession
    prepare(spark)
    cols = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(int(NO_ID))).alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.xxhash64(F.col(text_col)).alias("text_hash"))
    size = docs.agg(F.sum(F.octet_length(F.col(text_col))).alias("n")).first()["n"] or 0
    buckets = max(least_buckets, -(-size // bucket_bytes))
    fan = min(fan, buckets)
    buckets = fan * -(-buckets // fan)

    def hash_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _arrow(_ENTRIES)
        chunk = TaskContext.get().partitionId() << 32
        for batch in sliced(batches, 1, chunk_bytes):
            order = pa.array(np.argsort(batch.column(0).to_numpy(), kind="stable"))
            doc_ids, texts, text_hashes = (column.take(order) for column in batch.columns)
            ids = doc_ids.to_numpy()
            rows = list(_hash_chunk(ids, texts, chunk, width, fan))
            rows.append({"chunk": chunk, "bucket": _bucket(chunk, fan), "kind": 2,
                         "row": ids.tobytes(), "runs": text_hashes.to_numpy().tobytes()})
            yield from pa.Table.from_pylist(rows, schema).combine_chunks().to_batches()
            chunk += 1

    def judge(table: pa.Table) -> pa.Table:
        keep = table.filter(pc.equal(table["kind"], 2)).select(["chunk", "kind", "row", "runs", "pos"])
        found = pa.Table.from_pylist(list(_judge(table.filter(pc.less(table["kind"], 2)))), _arrow(_LOST))
        return pa.concat_tables([keep.cast(found.schema), found])

    def merge(table: pa.Table) -> pa.Table:
        return pa.table(_merge(table, width), schema=_arrow(_SPANS))

    rows = cols.mapInArrow(hash_rows, _ENTRIES)
    if buckets > fan:
        rows = rows.repartition("bucket").mapInArrow(lambda batches: refine(batches, fan, buckets), _ENTRIES)
    lost = (rows.groupBy("bucket").applyInArrow(judge, _LOST)
            .groupBy("chunk").applyInArrow(merge, _SPANS))
    return materialize(lost, "substring-spans")


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}
    return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in ddl.split(", ")])


def cut(text: bytes, starts, ends) -> tuple[int, int, bytes]:
    """Words, words removed, and the kept words joined by one space."""
    kept, seen, removed, k = [], 0, 0, 0
    for piece in text_slices(text):
        words = piece.split()
        at, end = 0, len(words)
        while k < len(starts) and starts[k] < seen + end:
            a, b = max(int(starts[k]) - seen, 0), min(int(ends[k]) - seen, end)
            kept += words[at:a]
            removed += b - max(a, at)
            at = b
            if int(ends[k]) > seen + end:
                break
            k += 1
        kept.append(b" ".join(words[at:])) if at < end else None
        seen += end
    return seen, removed, b" ".join(kept)


def remove_repeats(docs: DataFrame, width: int = 13, id_col: str = "doc_id", text_col: str = "text",
                   **sizes) -> DataFrame:
    """``docs`` with ``text_col`` reduced to the kept words joined by one space,
    and the columns _n_words and _n_removed added (in place of input columns of these names)."""
    docs = docs.drop("_n_words", "_n_removed")
    spans = repeated_spans(docs, width, id_col, text_col, **sizes) \
        .groupBy("doc_id", "text_hash").agg(F.first("starts").alias("_starts"), F.first("ends").alias("_ends"))
    spans = spans.select(F.col("doc_id").alias("_span_id"), F.col("text_hash").alias("_span_hash"), "_starts", "_ends")
    n, at = len(docs.columns), docs.columns.index(text_col)
    plain = docs.toDF(*[f"c{i}" for i in range(n)])
    key = F.coalesce(F.col(f"c{docs.columns.index(id_col)}").cast("long"), F.lit(int(NO_ID)))
    joined = plain.withColumns({"_span_id": key, "_span_hash": F.xxhash64(F.col(f"c{at}"))}) \
        .join(spans.hint("merge"), ["_span_id", "_span_hash"], "left").drop("_span_id", "_span_hash")

    def cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, at, CUT_BYTES):
            texts, words, gone = [], [], []
            for text, s, e in zip(batch.column(at).cast(pa.binary()), batch.column(n), batch.column(n + 1)):
                text = text.as_py()
                total, removed, kept = cut(text or b"", s.as_py() or (), e.as_py() or ())
                texts.append(None if text is None else kept)
                words.append(total)
                gone.append(removed)
            arrays = list(batch.columns[:n])
            arrays[at] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(words, pa.int64()), pa.array(gone, pa.int64())],
                                             names=[f"c{i}" for i in range(n + 2)])

    schema = T.StructType([*plain.schema.fields, T.StructField(f"c{n}", T.LongType()),
                           T.StructField(f"c{n + 1}", T.LongType())])
    return joined.mapInArrow(cut_rows, schema).toDF(*docs.columns, "_n_words", "_n_removed")


def keep_rest(docs: DataFrame, width: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the texts that remove_repeats leaves; a document that loses all words stays, empty."""
    plain, name = renamed(docs)
    return remove_repeats(plain, width, name[id_col], name[text_col]).select(*plain.columns).toDF(*docs.columns)
