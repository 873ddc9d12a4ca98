r"""Language ID by multilingual mixture inference.

Learning: counts of byte trigrams inside words (word edges marked, A-Z
lower-cased, hashed to ``GRAMS`` cells) per language over all learning rows,
summed per task and then in Spark; add-``SMOOTHING`` estimates. The model is
languages x GRAMS floats, whatever the number of documents.

Inference per document: every word has a likelihood under each language (the
product over its trigrams). Expectation-maximisation finds the proportions of
the languages that best explain the words; the language set is the one of the
greatest likelihood less ``PENALTY`` * log(words) for every language after the
first, found by dropping languages from the full mixture one by one. The
prediction is the language of the largest proportion in the chosen set and the
score that proportion.

Cases: a null text or one without a letter is ``und`` with score 0, and so is
every text if there was nothing to learn from; rows whose label is null are
not learnt from; repeated rows each count and each get a row; an empty table
gives an empty result; long texts are taken whole, in slices. Input columns
are kept and results come after them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulwise.llm.store import prepare, renamed
from haulwise.llm.words import flat, row_groups, word_slices

UNKNOWN = "und"
GRAMS = 1 << 15
SMOOTHING = 0.5
PENALTY = 2.0
ROUNDS = 25
CHUNK_BYTES = 4 << 20

_SPACE = 32
#: ASCII letters lower-cased, other ASCII a space, the bytes of other characters as they are.
_NORMAL = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else _SPACE for b in range(256)],
                   dtype=np.uint8)


def _trigrams(buf: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Slice by slice: the trigram cells of all word bytes, and for each word its byte position and first cell."""
    normal = _NORMAL[buf]
    word = normal != _SPACE
    for a, b in word_slices(word):
        here = normal[a:b].astype(np.uint32)
        before = np.empty(b - a, dtype=np.uint32)
        before[0], before[1:] = normal[a - 1] if a else _SPACE, here[:-1]
        after = np.empty(b - a, dtype=np.uint32)
        after[-1], after[:-1] = normal[b] if b < len(normal) else _SPACE, here[1:]
        cut = offsets[np.searchsorted(offsets, a, "left"):np.searchsorted(offsets, b, "right")] - a
        before[cut[cut < b - a]] = _SPACE
        after[cut[cut > 0] - 1] = _SPACE
        at = np.flatnonzero(word[a:b])
        cell = (before[at] << np.uint32(16) | here[at] << np.uint32(8) | after[at]) * np.uint32(0x9E3779B1)
        first = np.flatnonzero(before[at] == _SPACE)
        yield cell >> np.uint32(17), np.stack([at[first] + a, first])


def learn(docs: DataFrame, label_col: str = "lang", text_col: str = "text") -> tuple[list[str], np.ndarray]:
    """Languages in order of name, and log probabilities (GRAMS x languages)."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for label in pc.unique(batch.column(0)).to_pylist():
                text = batch.column(1).filter(pc.equal(batch.column(0), label))
                own = totals.setdefault(label, np.zeros(GRAMS, dtype=np.int64))
                for lo, hi in row_groups(flat(text)[1], CHUNK_BYTES):
                    for cells, _ in _trigrams(*flat(text.slice(lo, hi - lo))):
                        own += np.bincount(cells, minlength=GRAMS)
        for label, counts in totals.items():
            cells = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([label] * len(cells), pa.string()), pa.array(cells.astype(np.int32)),
                 pa.array(counts[cells])], names=["label", "cell", "n"])

    labelled = docs.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
    sums = labelled.select(F.col(label_col).cast("string"), text_col) \
        .mapInArrow(run, "label string, cell int, n long").groupBy("label", "cell").agg(F.sum("n").alias("n"))
    found = sums.toArrow()  # at most languages x GRAMS rows
    languages = sorted(set(found["label"].to_pylist()))
    counts = np.zeros((GRAMS, len(languages)))
    column = {name: i for i, name in enumerate(languages)}
    counts[found["cell"].to_numpy(), [column[x] for x in found["label"].to_pylist()]] = found["n"].to_numpy()
    log_p = np.log((counts + SMOOTHING) / (counts.sum(axis=0) + SMOOTHING * GRAMS))
    return languages, log_p.astype(np.float32)


def _likelihoods(text: pa.Array, log_p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-likelihood of every word under every language, and the first word of each row (n+1)."""
    buf, offsets = flat(text)
    words, places = [np.empty((0, log_p.shape[1]), np.float32)], [np.empty(0, np.int64)]
    for cells, (place, first) in _trigrams(buf, offsets):
        if len(first):
            words.append(np.add.reduceat(log_p[cells], first, axis=0))
            places.append(place)
    return np.concatenate(words), np.searchsorted(np.concatenate(places), offsets, "left")


def _mixture(likely: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Proportions of the languages in every row (each with a word), by EM over the rows together."""
    counts = np.diff(first)
    share = np.full((len(counts), likely.shape[1]), 1 / likely.shape[1], dtype=np.float32)
    open_ = np.arange(len(counts))  # rows that still change
    own, begin = likely, first[:-1]
    for _ in range(ROUNDS):
        part = own * np.repeat(share[open_], counts[open_], axis=0)
        part /= part.sum(axis=1, keepdims=True)
        new = np.add.reduceat(part, begin, axis=0) / counts[open_][:, None]
        moved = np.abs(new - share[open_]).max(axis=1) > 1e-3
        share[open_] = new
        if not moved.any():
            break
        if moved.mean() < 0.7:
            own = own[np.repeat(moved, counts[open_])]
            open_ = open_[moved]
            begin = np.cumsum(counts[open_]) - counts[open_]
    return share


def _one_mixture(likely: np.ndarray) -> tuple[np.ndarray, float]:
    """Proportions for one document and the log-likelihood they reach."""
    share = _mixture(likely, np.array([0, len(likely)]))[0]
    return share, float(np.log(likely @ share + 1e-30).sum())


def infer(text: pa.Array, log_p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Language index (-1: none) and score of every text."""
    log_likely, first = _likelihoods(text, log_p)
    counts = np.diff(first)
    rows = np.flatnonzero(counts)
    best, score = np.full(len(counts), -1), np.zeros(len(counts))
    if not len(rows) or not log_p.shape[1]:
        return best, score
    begin = first[rows]
    top = log_likely.max(axis=1, keepdims=True)
    likely = np.exp(np.maximum(log_likely - top, -60))
    alone = np.add.reduceat(log_likely - top, begin, axis=0).astype(np.float64)  # one language for the whole row
    share = _mixture(likely, np.append(begin, first[-1]))
    mixed = np.add.reduceat(np.log((likely * np.repeat(share, counts[rows], axis=0)).sum(axis=1)), begin)
    single = alone.argmax(axis=1)
    penalty = PENALTY * np.log(counts[rows] + 1.0)
    best[rows], score[rows] = single, 1.0
    for i in np.flatnonzero(mixed - alone.max(axis=1) > penalty):  # more than one language may pay
        own = likely[begin[i]:begin[i] + counts[rows[i]]]
        chosen, value = np.array([single[i]]), alone[i, single[i]]
        inside, proportions = chosen, np.ones(1)
        left = np.flatnonzero(share[i] > 0.5 / len(own))
        while len(left) > 1:
            part, reached = _one_mixture(own[:, left])
            if reached - penalty[i] * (len(left) - 1) > value:
                inside, proportions, value = left, part, reached - penalty[i] * (len(left) - 1)
            left = np.delete(left, part.argmin())
        best[rows[i]], score[rows[i]] = inside[proportions.argmax()], proportions.max()
    return best, np.clip(score, 0.0, 1.0)


def predict(docs: DataFrame, languages: list[str], log_p: np.ndarray, text_col: str = "text") -> DataFrame:
    """``docs`` and the columns _lang_pred and _score, in place of input columns of these names."""
    docs = docs.drop("_lang_pred", "_score")
    spark = docs.sparkSession
    prepare(spark)
    n, at = len(docs.columns), docs.columns.index(text_col)
    plain = docs.toDF(*[f"c{i}" for i in range(n)])
    schema = T.StructType([*plain.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    model = spark.sparkContext.broadcast((languages, log_p))  # languages x GRAMS floats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, table = model.value
        limit = max(CHUNK_BYTES // 16, CHUNK_BYTES * 4 // max(len(names), 4))
        for batch in batches:
            found, scores = [], []
            text = batch.column(at)
            for lo, hi in row_groups(flat(text)[1], limit):
                best, score = infer(text.slice(lo, hi - lo), table)
                found += [names[b] if b >= 0 else UNKNOWN for b in best]
                scores.append(score)
            scores = pa.array(np.concatenate(scores) if scores else np.empty(0))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string()), scores],
                                             names=schema.names)

    letter = F.coalesce(F.col("_text").rlike(r"\p{L}"), F.lit(False))
    out = plain.mapInArrow(run, schema).toDF(*[f"c{i}" for i in range(n)], "_pred", "_score")
    out = out.withColumn("_text", F.col(f"c{at}")).withColumn("_letter", letter)
    return out.select(*[F.col(f"c{i}") for i in range(n)],
                      F.when(F.col("_letter"), F.col("_pred")).otherwise(UNKNOWN).alias("_pred"),
                      F.when(F.col("_letter"), F.col("_score")).otherwise(0.0).alias("_score")) \
        .toDF(*docs.columns, "_lang_pred", "_score")


def held_out(id_col) -> F.Column:
    """crc32 of the id as text, mod 4, is 2; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", label_col: str = "lang", text_col: str = "text") -> DataFrame:
    """Learn from the labelled rows that are not held out (nor have a null id),
    predict every row: ``docs`` and _lang_pred, _score."""
    rows = docs.where(F.col(id_col).isNotNull() & ~held_out(id_col)).select(label_col, text_col)
    return predict(docs, *learn(rows, label_col, text_col), text_col)


def keep_identified(docs: DataFrame, id_col: str = "doc_id", label_col: str = "lang",
                    text_col: str = "text") -> DataFrame:
    """``docs`` without those that are ``und``, and with the predicted language in ``label_col``, so that what follows
    reads a language for every text, labelled or not; texts that mix languages stay, however even the mixture."""
    plain, name = renamed(docs)
    found = identify(plain, name[id_col], name[label_col], name[text_col])
    kept = found.where(F.col("_lang_pred") != UNKNOWN).withColumn(name[label_col], F.col("_lang_pred"))
    return kept.select(*plain.columns).toDF(*docs.columns)
