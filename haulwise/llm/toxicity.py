r"""Toxicity: a character n-gram linear classifier on naive Bayes features.

Features are the distinct character n-grams (``SIZES`` code points, lower-cased,
everything but letters and digits a space) of a whole text, hashed to ``CELLS``
cells. Each is scaled by its naive Bayes log-count ratio between toxic and
other documents; a logistic regression is fitted on the scaled features.

Learning uses the documents of at most ``SAMPLE_ROWS`` labelled ids (those of
the smallest hash), so the sampled labels can be broadcast: texts are never
shuffled. Documents of equal features and label are one weighted row of the
fit, and of such rows at most ``SAMPLE_ROWS`` (those of the smallest hash) come
to the driver, however many documents share an id. Counts of the n-grams are
summed in Spark; of the cells only the ``FEATURES`` with the greatest absolute
z-score of the log-odds (``LEAST_Z`` at least) are fitted. Every document is scored over its whole
text, slice by slice.

Cases: null and empty texts have no features and get the score of the
intercept; rows without a label are not learnt from; several labels of one id
count as toxic if one is; repeated documents each count and each get a row;
without labels of both kinds the score is the share of toxic ones (0 if none);
an empty table gives an empty result. Input columns are kept and the result
comes after them.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulwise.llm.store import prepare

SIZES = (3, 4, 5)
CELLS = 1 << 18
SAMPLE_ROWS = 20_000
FEATURES = 2048
LEAST_Z = 2.5
ROUNDS = 400
RIDGE = 1.0
SLICE_CHARS = 1 << 19

_FOLDED = 0x250
#: Code points up to U+024F: letters lower-cased where that is one character, digits as they are, the rest a space.
_NORMAL = np.array([ord(low) if len(low := chr(c).lower()) == 1 and low.isalnum() else 32 for c in range(_FOLDED)],
                   dtype=np.uint32)


class Model(NamedTuple):
    """Cells of the features in order, their weights (ratio x coefficient), and the intercept."""

    cells: np.ndarray
    weights: np.ndarray
    intercept: float


def _cells(text: str) -> Iterator[np.ndarray]:
    """Cells of all n-grams of one text, slice by slice (slices overlap by an n-gram less one)."""
    step, most = SLICE_CHARS, max(SIZES)
    for a in range(0, len(text), step):
        codes = np.frombuffer(f" {text} "[a:a + step + most + 1].encode("utf-32-le"), dtype=np.uint32)
        codes = np.where(codes < _FOLDED, _NORMAL[np.minimum(codes, _FOLDED - 1)], codes)
        h = np.zeros(len(codes), dtype=np.uint32)
        for size in range(1, most + 1):
            h = h[:len(codes) - size + 1] * np.uint32(0x01000193) + codes[size - 1:]
            if size in SIZES and len(h):
                mixed = (h ^ h >> np.uint32(15)) * np.uint32(0x85EBCA6B) + np.uint32(size)
                yield (mixed ^ mixed >> np.uint32(13)) >> np.uint32(14)


def _sample(docs: DataFrame, labels: DataFrame, rows: int, id_col: str, label_col: str, text_col: str) -> DataFrame:
    """text and label of the documents of at most ``rows`` labelled ids."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()) \
        .groupBy(F.col(id_col).cast("long").alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
    known = known.orderBy(F.xxhash64("_id"), "_id").limit(rows)  # the documented bound of the learning sample
    return docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("text")) \
        .join(F.broadcast(known), "_id").select("text", "label")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each label that have each cell; cell -1 counts the documents."""
    totals = np.zeros((2, CELLS), dtype=np.int64)
    docs = np.zeros(2, dtype=np.int64)
    seen = np.zeros(CELLS, dtype=bool)
    for batch in batches:
        for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
            seen[:] = False
            for cells in _cells(text.as_py() or ""):
                seen[cells] = True
            totals[int(label > 0)] += seen
            docs[int(label > 0)] += 1
    for label in (0, 1):
        cells = np.flatnonzero(totals[label])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(cells) + 1, label, np.int32)), pa.array(np.append(cells, -1).astype(np.int32)),
             pa.array(np.append(totals[label][cells], docs[label]))], names=["label", "cell", "n"])


def present(text: str, table: np.ndarray) -> np.ndarray:
    """Distinct features of a text; ``table`` has the feature of each cell, or -1."""
    found = [np.unique(hit[hit >= 0]) for hit in (table[c] for c in _cells(text))]
    return np.unique(np.concatenate(found)) if found else np.empty(0, table.dtype)


def _table(cells: np.ndarray) -> np.ndarray:
    table = np.full(CELLS, -1, dtype=np.int32)
    table[cells] = np.arange(len(cells), dtype=np.int32)
    return table


def _fit(rows: pa.ListArray, labels: np.ndarray, ratio: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Ridge logistic regression on features of value ``ratio`` where present, of rows that count ``weight`` times
    (accelerated gradient)."""
    index = rows.flatten().to_numpy().astype(np.int64)
    owner = np.repeat(np.arange(len(rows)), rows.value_lengths().to_numpy())
    rate = np.clip(np.average(labels, weights=weight), 1e-6, 1 - 1e-6)  # the bounded rows may be of one label
    w, b = np.zeros(len(ratio)), float(np.log(rate / (1 - rate)))
    squares = np.bincount(owner, (ratio * ratio)[index], len(rows)) + 1
    step = 4.0 / max(float(squares @ weight), 1.0)
    fast_w, fast_b, t = w.copy(), b, 1.0

    def margin_and_loss(w, b):
        margin = np.bincount(owner, (ratio * w)[index], len(rows)) + b
        return margin, weight @ (np.logaddexp(0, margin) - labels * margin) + RIDGE / 2 * (w @ w)

    for _ in range(ROUNDS):
        margin, loss = margin_and_loss(fast_w, fast_b)
        error = weight * (1 / (1 + np.exp(-np.clip(margin, -35, 35))) - labels)
        slope, slope_b = np.bincount(index, error[owner], len(ratio)) * ratio + RIDGE * fast_w, error.sum()
        norm = slope @ slope + slope_b * slope_b
        if norm < 1e-10:
            break
        while step > 1e-12:  # backtrack to a sufficient decrease
            new_w, new_b = fast_w - step * slope, fast_b - step * slope_b
            if margin_and_loss(new_w, new_b)[1] <= loss - step / 2 * norm + 1e-9:
                break
            step /= 2
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        fast_w, fast_b = new_w + (t - 1) / after * (new_w - w), new_b + (t - 1) / after * (new_b - b)
        w, b, t = new_w, new_b, after
    return w, b


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic",
          text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit the classifier on the labelled documents (at most ``sample_rows``)."""
    prepare(docs.sparkSession)
    sample = _sample(docs, labels, sample_rows, id_col, label_col, text_col)
    sums = sample.mapInArrow(_count, "label int, cell int, n long").groupBy("label", "cell").agg(F.sum("n").alias("n"))
    found = sums.toArrow()  # at most 2 x CELLS rows
    label, cell, n = (found[c].to_numpy() for c in ("label", "cell", "n"))
    total = [int(n[(label == x) & (cell < 0)].sum()) for x in (0, 1)]
    if not all(total):
        rate = total[1] / max(sum(total), 1)
        return Model(np.empty(0, np.int64), np.empty(0), float(np.log(max(rate, 1e-6) / max(1 - rate, 1e-6))))
    count = np.zeros((2, CELLS))
    inside = cell >= 0
    count[label[inside], cell[inside]] = n[inside]
    has, lacks = count + 0.5, np.array(total)[:, None] - count + 0.5
    odds = np.log(has[1] / lacks[1]) - np.log(has[0] / lacks[0])
    z = np.abs(odds) / np.sqrt((1 / has + 1 / lacks).sum(axis=0))
    cells = np.sort(np.argsort(-z, kind="stable")[:FEATURES])
    cells = cells[z[cells] >= LEAST_Z]
    smooth = count + 1
    ratio = np.log(smooth[1] / smooth[1].sum()) - np.log(smooth[0] / smooth[0].sum())
    table = docs.sparkSession.sparkContext.broadcast(_table(cells))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [present(t.as_py() or "", table.value) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int32())), batch.column(1)],
                                             names=["features", "label"])

    fitted = sample.mapInArrow(features, "features array<int>, label int") \
        .groupBy("features", F.col("label") > 0).agg(F.count(F.lit(1)).alias("weight")).toDF("features", "label", "weight")
    fitted = fitted.orderBy(F.xxhash64("features"), "features", "label").limit(sample_rows).toArrow()
    weights, intercept = _fit(fitted["features"].combine_chunks(), fitted["label"].to_numpy().astype(float), ratio[cells],
                              fitted["weight"].to_numpy().astype(float))
    return Model(cells, weights * ratio[cells], float(intercept))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` and the column _score, the probability of label 1, in place of an input column of this name."""
    docs = docs.drop("_score")
    spark = docs.sparkSession
    prepare(spark)
    at = docs.columns.index(text_col)
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    schema = T.StructType([*plain.schema.fields, T.StructField("score", T.DoubleType())])
    shared = spark.sparkContext.broadcast((_table(model.cells), model.weights, model.intercept))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, weights, intercept = shared.value
        for batch in batches:
            margin = np.array([intercept + weights[present(t.as_py() or "", table)].sum() for t in batch.column(at)])
            values = pa.array(1 / (1 + np.exp(-np.clip(margin, -35, 35))), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, values], names=schema.names)

    return plain.mapInArrow(run, schema).toDF(*docs.columns, "_score")
