r"""SimHash near-duplicates by multi-index hashing.

Fingerprints: lower-cased (A-Z) words ``[^\x20\x09-\x0D]+``, shingles of
``shingle`` words with repeats, XXH64 (seed 42) of each, majority vote per bit.

Search: a 64-bit fingerprint has four 16-bit segments. For a pair at distance
1..r take the last segment j that differs: outside j it differs in at most r-1
bits, all in earlier segments. So table j is keyed by the 48 bits outside
segment j, and each fingerprint probes it with every Hamming ball of radius
r-1 over the earlier segments. Of the two sides of a pair only the one whose
lowest flipped bit is 0 probes, so a pair is met once. Every match is verified
by its whole distance. Keys have 48 bits, so a group of near copies spreads
over many keys, and equal fingerprints are one row before the search: a
fingerprint that a third of all documents share costs one row.

Cases: null and empty texts and texts without words have fingerprint zero and
link like any other; fewer words than a shingle make one shingle; repeated
rows each get a row; a null id gets a row and never names a component unless
all its members have null ids (then the component is null); an empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulwise.llm.components import components
from haulwise.llm.store import materialize, prepare
from haulwise.llm.words import LOWER, text_slices

SEED = 42
SEGMENT = 16


def fingerprint(text: bytes, shingle: int) -> int:
    """Unsigned 64-bit SimHash of one text (UTF-8)."""
    ones, n = np.zeros(64, dtype=np.int64), 0
    tail: list[bytes] = []
    digest = xxhash.xxh64_digest
    for piece in text_slices(text):
        words = tail + piece.translate(LOWER).split()
        if len(words) >= shingle:
            runs = zip(*(words[i:] for i in range(shingle)))
            hashes = b"".join([digest(b" ".join(run), SEED) for run in runs])
            bits = np.unpackbits(np.frombuffer(hashes, dtype=np.uint8).reshape(-1, 8), axis=1)
            ones += bits.sum(axis=0, dtype=np.int32)
            n += len(bits)
            tail = words[len(words) - shingle + 1:]
        else:
            tail = words
    if n == 0 and tail:
        hashes = digest(b" ".join(tail), SEED)
        ones, n = np.unpackbits(np.frombuffer(hashes, dtype=np.uint8)).astype(np.int64), 1
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fp (the 64 bits as a signed long), text_hash."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.encode("utf-8") if t else b"", shingle) for t in (x.as_py() for x in batch.column(1))]
            signed = np.array(fps, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed), batch.column(2)],
                                             names=["doc_id", "fp", "text_hash"])

    cols = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(F.col(text_col)).alias("text_hash"))
    return cols.mapInArrow(run, "doc_id long, fp long, text_hash long")


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def links(fps: DataFrame, max_distance: int) -> DataFrame:
    """Pairs (a, b) of the distinct values ``fp`` at distance 1..max_distance, each once."""
    segments = 64 // SEGMENT
    ones = (1 << SEGMENT) - 1
    free = [_signed(ones << (SEGMENT * j)) for j in range(segments)]
    probes = []
    for j in range(segments):
        for r in range(max_distance):
            for flipped in itertools.combinations(range(SEGMENT * j), r):
                mask = sum(1 << b for b in flipped)
                probes.append((j, mask, 1 << flipped[0] if flipped else 0))
    if not probes:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    outside = F.array(*[F.lit(~m) for m in free])
    table = fps.select(F.explode(F.array(*[F.lit(j) for j in range(segments)])).alias("j"), F.col("fp").alias("b"))
    table = table.select("j", F.col("b").bitwiseAND(outside[F.col("j")]).alias("key"), "b")
    ball = F.array(*[F.struct(F.lit(j).alias("j"), F.lit(_signed(m)).alias("mask"), F.lit(_signed(low)).alias("low"))
                     for j, m, low in probes])
    probing = fps.select(F.col("fp").alias("a"), F.explode(ball).alias("p"))
    probing = probing.where(F.col("a").bitwiseAND(F.col("p.low")) == 0).select(
        F.col("p.j").alias("j"), (F.col("p.mask") == 0).alias("same"),
        F.col("a").bitwiseXOR(F.col("p.mask")).bitwiseAND(outside[F.col("p.j")]).alias("key"), "a")
    apart = F.col("a").bitwiseXOR(F.col("b"))
    free_part = apart.bitwiseAND(F.array(*[F.lit(m) for m in free])[F.col("t.j")])
    # both sides hold many rows a fingerprint: a merge join, never a broadcast by the size of the fingerprint table
    return probing.alias("q").hint("merge").join(
        table.alias("t"),
        (F.col("q.j") == F.col("t.j")) & (F.col("q.key") == F.col("t.key"))
        & (F.bit_count(apart) <= max_distance) & (free_part != 0) & (~F.col("same") | (F.col("a") < F.col("b"))),
    ).select("a", "b")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_distance: int = 2, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fp, text_hash, group (a fingerprint that names
    the component) and component_id (the smallest id in it)."""
    spark = docs.sparkSession
    fps = materialize(fingerprints(docs, shingle, id_col, text_col), "simhash-fp")
    nodes = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-nodes")
    roots = components(links(nodes.select("fp"), max_distance), "simhash")
    named = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left") \
        .select("fp", "low", F.coalesce("root", "fp").alias("group"))
    lows = named.groupBy("group").agg(F.min("low").alias("component_id"))
    named = materialize(named.join(lows, "group").select("fp", "group", "component_id"), "simhash-named")
    return fps.join(named, "fp").select("doc_id", "fp", "text_hash", "group", "component_id")


def fingerprint_hex(fp) -> F.Column:
    """16 lower-case hex digits of a signed long."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one_per_group(docs: DataFrame, shingle: int = 3, max_distance: int = 2, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """``docs`` with the document of the smallest id of each component; of rows
    with that same id the one with the smallest text hash, once."""
    found = near_duplicates(docs, shingle, max_distance, id_col, text_col)
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"),
                     F.col("text_hash").alias("hash"))
    best = materialize(found.groupBy("group").agg(F.min(order).alias("best"))
                       .select(F.col("best.none").alias("_none"), F.col("best.id").alias("_id"),
                               F.col("best.hash").alias("_hash")), "simhash-kept")
    n = len(docs.columns)
    plain = docs.toDF(*[f"c{i}" for i in range(n)])
    own, text = (F.col(f"c{docs.columns.index(c)}") for c in (id_col, text_col))
    keyed = plain.withColumns({"_none": own.isNull(), "_id": F.coalesce(own.cast("long"), F.lit(0)),
                               "_hash": F.xxhash64(text)})
    # repeated rows are dropped on the join's own keys: no second shuffle of the texts
    hit = keyed.join(best, ["_none", "_id", "_hash"], "left_semi").dropDuplicates(["_none", "_id", "_hash"])
    return hit.select(*plain.columns).toDF(*docs.columns)
