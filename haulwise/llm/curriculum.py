r"""Mixing sources to target weights along a time-varying curriculum; DataFrame functions only.

Sources, by code point with null last, take ``weights`` and ``curves`` in turn.
They share the words (``[^\x20\x09-\x0D]+``) of all documents by weight; a
target stops at ``passes`` times its source's words and the excess is shared
again by weight until none is above. A curve is the source's weight over
training time 0 to 1 (knots of a piecewise linear function, scaled to area 1).

How: a source's curve is integrated; times its target this is the cumulative
demand for its words. The documents of a source stand in the order of a hash of
id and text and are read over and over; where an occurrence begins ``x`` words
into the source's stream, the demand is inverted for ``x`` and gives its
training position. What begins beyond the target has no position; the
occurrence that crosses it is cut there, so a source's words meet its target.
Rows are range-sorted by position.

At scale: texts are read once and never shuffled. Equal rows become one row per
input partition first. A source's running sum comes from two windows: one over the
rows of a hash range of a source, one over the range totals of a source, with
as many ranges as the square root of the rows, so that neither holds more than
about that many rows and a source with a third of all rows has as many tasks.
Sources are numbered by range partitions, and the shares are solved in rounds
of one aggregate each, so nothing rests on the number of sources.

The order depends on ids and texts only, not on files or partitions: reruns
agree. Cases: null, empty and blank texts have size 0 and are never taken; a
null id is hashed like an empty one; rows that share an id are told apart by
their texts, and equal rows stand one after another; an empty table gives an
empty result, a table without words targets of 0; other columns are not read,
so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulwise.llm.store import materialize

WORD = r"[^\x20\x09-\x0D]+"
Curve = Sequence[tuple[float, float]]
#: Early, even and late: knots (time, weight).
CURVES: tuple[Curve, ...] = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (1.0, 1.5)))
WEIGHTS = (5, 2, 1)
_SOURCE = ["absent", "source"]
_ROW = [*_SOURCE, "key", "id", "size", "text_hash", "salt"]


def pieces(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """Equal rows of one input partition as one: source, key (60 bits of an MD5 of id and text), id, size, text_hash, salt, n."""
    text, doc, source = F.col(text_col), F.col(id_col), F.col(source_col).cast("string")
    parts = [F.coalesce(doc.cast("string"), F.lit("")), F.coalesce(F.md5(text.cast("binary")), F.lit(""))]
    digest = F.md5(F.concat_ws(":", *parts).cast("binary"))
    return docs.select(
        source.isNull().alias("absent"), F.coalesce(source, F.lit("")).alias("source"),
        F.conv(F.substring(digest, 1, 15), 16, 10).cast("long").alias("key"), doc.alias("id"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(text).alias("text_hash"), F.spark_partition_id().alias("salt")) \
        .groupBy(*_ROW).agg(F.count("*").alias("n"))


def numbered(sources: DataFrame) -> DataFrame:
    """``sources`` with ``rank`` (from 0) by code point, null last: places in range partitions plus the rows before."""
    ranged = materialize(sources.repartitionByRange(*_SOURCE).withColumn("part", F.spark_partition_id()),
                         "curriculum-sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    offsets = ranged.groupBy("part").agg(F.count("*").alias("rows")) \
        .select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(*_SOURCE)) - 1
    return ranged.withColumn("place", place).join(offsets, "part") \
        .withColumn("rank", F.col("offset") + F.col("place")).drop("part", "place", "offset")


def targets(sources: DataFrame, weights: Sequence[int], passes: int) -> DataFrame:
    """``sources`` (with source_size and rank) with weight and target: shares of the whole by weight, each at most
    ``passes`` times its source, the excess shared again until none is above."""
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    limit = F.lit(passes) * F.col("source_size")
    rows = materialize(sources.withColumns({"weight": weight.cast("double"), "limit": limit.cast("double")}),
                       "curriculum-weights")
    whole = rows.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight"), F.count("*").alias("n")).first()
    words, share, free = float(whole.words or 0), whole.weight or 0.0, whole.n
    while True:
        raised = F.col("weight") * F.lit(words) / F.lit(share or 1.0)
        left = rows.where(raised < F.col("limit")) \
            .agg(F.sum("weight").alias("weight"), F.count("*").alias("n")).first()
        if left.n == free or not left.n:
            return rows.withColumn("target", F.least(raised, F.col("limit")))
        full = rows.where(raised >= F.col("limit")).agg(F.sum("limit").alias("words")).first()
        words, share, free = float(whole.words) - full.words, left.weight, left.n


def position(share: Column, curve: Curve) -> Column:
    """Time at which the integral of ``curve`` reaches ``share`` (0 to 1) of its area."""
    spans = [(a, b, v, w) for (a, v), (b, w) in zip(curve, curve[1:]) if b > a and v + w > 0]
    if not spans or min(min(v, w) for _, _, v, w in spans) < 0:
        raise ValueError("a curve needs ascending knots, weights of 0 or more and an area")
    area = sum((b - a) * (v + w) / 2 for a, b, v, w in spans)
    found, seen = None, 0.0
    for a, b, v, w in spans:
        rest = (share - F.lit(seen / area)) * F.lit(area)
        if v == w:
            at = F.lit(a) + rest / F.lit(v)
        else:
            slope = (w - v) / (b - a)
            at = F.lit(a) + (F.sqrt(F.greatest(F.lit(v * v) + F.lit(2 * slope) * rest, F.lit(0.0))) - F.lit(v)) / F.lit(slope)
        seen += (b - a) * (v + w) / 2
        found = F.when(share < F.lit(seen / area), at) if found is None else found.when(share < F.lit(seen / area), at)
    return F.least(found.otherwise(F.lit(spans[-1][1])), F.lit(spans[-1][1]))


def placed(docs: DataFrame, weights: Sequence[int], curves: Sequence[Curve], passes: int, id_col: str, text_col: str,
           source_col: str) -> DataFrame:
    """A row per document: source columns, id, size, text_hash, source_size, target, offset (words of its source in
    front of it) and takes: pass, words and position of each occurrence that the mix takes."""
    rows = materialize(pieces(docs, id_col, text_col, source_col), "curriculum-pieces")
    ranges = max(1, int(rows.count() ** 0.5))
    rows = rows.withColumn("range", F.shiftright(F.shiftright("key", 30) * ranges, 30))
    words = F.col("size") * F.col("n")
    totals = rows.groupBy(*_SOURCE, "range").agg(F.sum(words).alias("words"))
    sources = totals.groupBy(*_SOURCE).agg(F.sum("words").alias("source_size"))
    sources = targets(numbered(sources), weights, passes)
    before = lambda *keys: Window.partitionBy(*_SOURCE, *keys).rowsBetween(Window.unboundedPreceding, -1)
    front = totals.withColumn("front", F.coalesce(F.sum("words").over(before().orderBy("range")), F.lit(0))) \
        .join(sources.hint("merge"), _SOURCE).select(*_SOURCE, "range", "front", "source_size", "target", "rank")
    inner = F.coalesce(F.sum(words).over(before("range").orderBy("key", "id", "size", "text_hash", "salt")), F.lit(0))
    found = rows.withColumn("inner", inner).join(front.hint("merge"), [*_SOURCE, "range"])
    # n is at most the rows of one input partition
    found = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))) \
        .withColumn("offset", F.col("front") + F.col("inner") + (F.col("copy") - 1) * F.col("size"))
    starts = F.array(*[F.lit(k) * F.col("source_size") + F.col("offset") for k in range(passes)])

    def take(start: Column, k: Column) -> Column:
        share = start / F.col("target")
        at = [position(share, c) for c in curves]
        curve = F.col("rank") % len(curves)
        when = at[-1]
        for i in range(len(curves) - 1):
            when = F.when(curve == i, at[i]).otherwise(when)
        rest = F.floor("target") - start
        return F.struct((k + 1).cast("int").alias("pass"), F.greatest(F.least(rest, F.col("size")), F.lit(0)).alias("words"),
                        F.when(F.col("target") > 0, when).alias("position"))

    takes = F.filter(F.transform(starts, take), lambda t: t["words"] > 0)
    return found.select(*_SOURCE, "id", "size", "text_hash", "source_size", "target", "offset", "salt", "copy",
                        takes.alias("takes"))


def curriculum(docs: DataFrame, weights: Sequence[int] = WEIGHTS, curves: Sequence[Curve] = CURVES, passes: int = 3,
               id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """A row per document, range-sorted by the position of its first occurrence (those never taken last): ``id_col``,
    source, size, text_hash, source_size, target, taken (words, repeats counted) and takes (pass, words, position)."""
    found = placed(docs, weights, curves, passes, id_col, text_col, source_col)
    # offset, salt and copy tell equal positions apart, so that no range takes all documents without one
    return found.orderBy(F.get("takes", F.lit(0))["position"].asc_nulls_last(), "offset", "salt", "copy").select(
        F.col("id").alias(id_col), F.when(~F.col("absent"), F.col("source")).alias("source"), "size", "text_hash",
        "source_size", "target",
        F.aggregate("takes", F.lit(0).cast("long"), lambda n, t: n + t["words"]).alias("taken"), "takes")


def training_order(docs: DataFrame, weights: Sequence[int] = WEIGHTS, curves: Sequence[Curve] = CURVES, passes: int = 3,
                   id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: a row per occurrence, range-sorted by position, with ``id_col``, source, pass, words (the
    first so many words of the text), position and text."""
    found = placed(docs, weights, curves, passes, id_col, text_col, source_col)
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_hash"),
                        F.col(text_col).alias("text")).groupBy("id", "text_hash").agg(F.first("text").alias("text")) \
        .withColumnsRenamed({"id": "text_id", "text_hash": "hash"})
    takes = found.withColumn("take", F.explode("takes")).select("*", "take.*")
    return takes.join(texts, F.col("id").eqNullSafe(F.col("text_id")) & (F.col("text_hash") == F.col("hash"))) \
        .orderBy("position", "source", "offset", "pass", "salt", "copy").select(
            F.col("id").alias(id_col), F.when(~F.col("absent"), F.col("source")).alias("source"), "pass", "words",
            "position", "text")
