r"""Periodic runs: stretches of words that repeat with a period.

A run is a stretch of consecutive words ``[^\x20\x09-\x0D]+`` of one text whose
words ``q`` apart are identical (``q`` its smallest period), of at least
``max(least, 3 * q)`` words, that neither neighbouring word extends. A word is
dropped if a run holds it after that run's first ``q`` words.

How: an online sparse diagonal DP. Words are read in order; on the diagonal
``lag`` the match length counts the words so far that equal the word ``lag``
earlier. A word's earlier occurrences open diagonals, equal words increment
the active ones, and a diagonal that ends after enough matches emits its run
at once. A text never leaves its task; nothing is shuffled.

Sparse: a run of period ``q`` holds ``max(least - q, 2 * q)`` matches in a row,
so an earlier occurrence can open a diagonal only where that many words match.
Occurrences are therefore looked up by word grams whose length doubles with
the lag (``GRAM`` words up to lag ``GRAM - 1``, then ``g`` words for lags
``g / 2`` to ``g - 1``); grams are numbered by sorting pairs of half grams, so
equality is exact and no hash is trusted. Only grams that occur again in
their text go on to the next length, and occurrences with the same word in front
are stepped over together, as they lie on a diagonal that is open already.
Openings stay in proportion to the words (times the logarithm of the longest
period) also where one word fills a text.

A diagonal whose stretch begins with that of an open one of a divisor lag and
enough matches ends with it too and is not opened; of the stretches with equal
bounds the smallest lag is the period.

Cases: null, empty and blank texts have no words and no run (``collapsed`` is
null for null, else empty); ids are not read; repeated rows give repeated
results; an empty table gives an empty result; other columns are kept, one
that is named like a result column is replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulwise.llm.store import prepare, renamed
from haulwise.llm.words import SPACED, flat, sliced, word_table

LEAST = 24
SLICE = 2 << 20
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def gram_words(least: int) -> int:
    """Length of the shortest gram (a power of two): a run of any period up to
    it holds at least so many matches in a row."""
    g = 1
    while min(max(least - q, 2 * q) for q in range(1, 2 * g)) >= 2 * g:
        g *= 2
    return g


def _numbered(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dense numbers of equal keys, and which keys occur more than once."""
    _, number, count = np.unique(key, return_inverse=True, return_counts=True)
    return number, count[number] > 1


def _word_numbers(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number per distinct word (compared as bytes)."""
    offsets = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    packed = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(buf[SPACED[buf]])])
    return pc.dictionary_encode(packed).indices.to_numpy().astype(np.int64)


def _opened(at: np.ndarray, gram: np.ndarray, before: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Places whose gram also stands ``low <= lag < high`` words earlier behind another word, and the lags.

    ``at`` ascends, ``before`` is the word in front of each place (one of its
    own for the first word of a text).
    """
    order = np.argsort(gram, kind="stable")
    at, gram, before = at[order], gram[order], before[order]
    n = len(at)
    edge = np.ones(n, dtype=bool)
    edge[1:] = (gram[1:] != gram[:-1]) | (before[1:] != before[:-1])
    segment = np.maximum.accumulate(np.where(edge, np.arange(n), 0))
    span = int(at.max()) + high + 1
    key = gram * span + at
    here = np.arange(n)
    seen = np.searchsorted(key, np.maximum(key - low, gram * span), "right") - 1
    seen[at < low] = -1
    found, lags = [], []
    while len(here):
        ok = seen >= 0
        ok[ok] = (gram[seen[ok]] == gram[here[ok]]) & (at[here[ok]] - at[seen[ok]] < high)
        here, seen = here[ok], seen[ok]
        same = before[seen] == before[here]
        found.append(at[here[~same]])
        lags.append(at[here[~same]] - at[seen[~same]])
        seen = np.where(same, segment[seen], seen) - 1
    return np.concatenate(found), np.concatenate(lags)


def openings(word: np.ndarray, first: np.ndarray, least: int = LEAST) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Diagonals that may last: for each gram length the places of their first match, their lags, and the length.

    ``word``: word numbers of texts laid end to end; ``first``: where each text begins, and the end.
    """
    n = len(word)
    if not n:
        return []
    counts = np.diff(first)
    text = np.repeat(np.arange(len(counts), dtype=np.int64), counts)
    left = np.repeat(first[1:], counts) - np.arange(n)
    before = np.empty(n, dtype=np.int64)
    before[1:] = word[:-1]
    heads = first[:-1][counts > 0]
    before[heads] = -1
    gram = np.full(n, -1, dtype=np.int64)
    number, again = _numbered(text * (int(word.max()) + 1) + word)
    at = np.flatnonzero(again)
    gram[at] = number[at]
    shortest = gram_words(least)
    size, found = 1, []
    while len(at):
        if size >= shortest:
            places, lags = _opened(at, gram[at], before[at], 1 if size == shortest else size // 2, size)
            if len(places):
                found.append((places, lags, size))
        both = at[left[at] >= 2 * size]
        both = both[gram[both + size] >= 0]
        number, again = _numbered(gram[both] * n + gram[both + size])
        gram[:] = -1
        at = both[again]
        gram[at] = number[again]
        size *= 2
    return found


def scan(words: list, opens: list[tuple[int, int, int]], least: int = LEAST) -> list[tuple[int, int, int]]:
    """Runs (start, length, period) of one text, by start, then period.

    ``words`` compare equal if the words do; ``opens`` holds (place where the
    diagonal has matched ``length`` words, lag, length), by place.
    """
    n, k, i = len(words), 0, 0
    active: dict[int, int] = {}  # lag: words matched so far
    begun: dict[int, list[int]] = {}  # first word of a stretch: its active lags
    runs: dict[tuple[int, int], int] = {}  # (start, end): smallest lag
    while active or k < len(opens):
        if not active:
            i = opens[k][0]
        while k < len(opens) and opens[k][0] == i:
            _, lag, length = opens[k]
            k += 1
            lags = begun.setdefault(i - length - lag, [])
            if not any(lag % q == 0 and active[q] >= max(least - q, 2 * q) for q in lags):
                active[lag] = length
                lags.append(lag)
        ended = []
        for lag in active:
            if i < n and words[i] == words[i - lag]:
                active[lag] += 1
            else:
                ended.append(lag)
        for lag in ended:
            length = active.pop(lag)
            start = i - length - lag
            begun[start].remove(lag)
            if not begun[start]:
                del begun[start]
            if length >= max(least - lag, 2 * lag):
                runs[start, i] = min(lag, runs.get((start, i), lag))
        i += 1
    return sorted((start, end - start, lag) for (start, end), lag in runs.items())


def runs_of(column: pa.Array, least: int = LEAST) -> tuple[np.ndarray, dict[int, list[tuple[int, int, int]]]]:
    """Words of each text, and the runs of the texts that have any."""
    buf, offsets = flat(column)
    _, first, starts, ends = word_table(buf, offsets, SPACED, spans=True, hashes=False)
    word = _word_numbers(buf, starts, ends)
    found = openings(word, first, least)
    if not found:
        return np.diff(first), {}
    place = np.concatenate([p + size for p, _, size in found])
    lag = np.concatenate([lags for _, lags, _ in found])
    length = np.concatenate([np.full(len(p), size) for p, _, size in found])
    order = np.lexsort((lag, place))
    place, lag, length = place[order], lag[order], length[order]
    text = np.searchsorted(first, place - length, "right") - 1
    edges = np.append(np.flatnonzero(np.diff(text, prepend=-1)), len(text))
    out = {}
    for a, b in zip(edges[:-1], edges[1:]):
        t = int(text[a])
        opens = list(zip((place[a:b] - first[t]).tolist(), lag[a:b].tolist(), length[a:b].tolist()))
        if runs := scan(word[first[t]:first[t + 1]].tolist(), opens, least):
            out[t] = runs
    return np.diff(first), out


def collapse(text: bytes, runs: list[tuple[int, int, int]]) -> bytes:
    """The kept words joined by one space."""
    words = text.split()  # ASCII white space, as SPACED has it
    kept, at = [], 0
    for a, b in sorted((start + period, start + length) for start, length, period in runs):
        kept += words[at:max(a, at)]
        at = max(at, b)
    return b" ".join(kept + words[at:])


def periodic_runs(docs: DataFrame, least: int = LEAST, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words`` (long), ``runs`` (array of start, length, period; by start, then period) and
    ``collapsed`` (the text without the words that runs repeat)."""
    prepare(docs.sparkSession)
    plain, name = renamed(docs)
    at, names = docs.columns.index(text_col), [*plain.columns, "n_words", "runs", "collapsed"]
    added = T.StructType.fromDDL(f"n_words long, runs {RUNS}, collapsed string")
    runs_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, at, SLICE):
            column = batch.column(at)
            counts, found = runs_of(column, least)
            plain_texts = column.cast(pa.binary())
            runs = [[dict(zip(("start", "length", "period"), r)) for r in found.get(t, ())] for t in range(len(column))]
            texts = [None if not x.is_valid else collapse(x.as_py(), found.get(t, ())) for t, x in enumerate(plain_texts)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(counts, pa.int64()), pa.array(runs, runs_type),
                 pa.array(texts, pa.binary()).cast(pa.string())], names=names)

    found = plain.mapInArrow(work, T.StructType([*plain.schema.fields, *added.fields]))
    kept = [c for c in docs.columns if c.lower() not in added.names]
    return found.select(*[F.col(name[c]).alias(c) for c in kept], *added.names)


def strongest(runs: Column) -> Column:
    """The run of greatest exact length / period; ties: smallest start, then period; null without runs."""
    def better(a: Column, b: Column) -> Column:
        left, right = a["length"] * b["period"], b["length"] * a["period"]
        return (left > right) | (left == right) & ((a["start"] < b["start"])
                                                   | (a["start"] == b["start"]) & (a["period"] < b["period"]))
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate(runs, none, lambda best, r: F.when(best.isNull() | better(r, best), r).otherwise(best))


def run_lines(runs: Column) -> Column:
    """Every run as ``start,length,period`` and a line feed."""
    line = F.transform(runs, lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"),
                                                F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return F.array_join(line, "")


def planted(text: Column, doc_id: Column) -> Column:
    """The text op13 reads: of the documents with crc32(id) % 10 = 0, the words from ``a`` on become a repetition of
    the ``p`` words that start there; other texts stay as they are."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n = F.size(words)
    a = (g % F.greatest(n, F.lit(1))).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    times = F.ceil((n - a) / p).cast("int")
    cycle = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), times)), F.lit(1), n - a)
    return F.when((h % 10 == 0) & (n > 0), F.array_join(F.concat(F.slice(words, F.lit(1), a), cycle), " ")) \
        .otherwise(text)
