"""Periodic runs against brute force and the DuckDB twin."""

import random
import time
import zlib

import duckdb
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from haulwise.llm import periodic, queries
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.conftest import by_row


def runs(words, least=24):
    """Every lag, every stretch of matches; the smallest lag of equal bounds."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = q
        while i < n:
            s = i
            while i < n and words[i] == words[i - q]:
                i += 1
            if i > s and i - s + q >= max(least, 3 * q):
                found.setdefault((s - q, i), q)
            i += i == s
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def planted(words, doc_id):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


piece = st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=9), st.integers(1, 90))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(piece, max_size=5), min_size=1, max_size=4), st.sampled_from([1, 5, 24, 60]))
def test_runs_are_those_of_brute_force(texts, least):
    texts = [[base[i % len(base)] for base, n in pieces for i in range(n)] for pieces in texts]
    counts, found = periodic.runs_of(pa.array([" ".join(w) for w in texts]), least)
    assert list(counts) == [len(w) for w in texts]
    assert [found.get(t, []) for t in range(len(texts))] == [runs(w, least) for w in texts]


def test_texts_full_of_repetition_stay_near_linear():
    fib = ["a", "ab"]
    while len(fib[-1]) < 30_000:
        fib.append(fib[-1] + fib[-2])
    lines = [w for i in range(1500) for w in [*(f"x{j}" for j in range(20)), f"n{i}"]]
    start = time.time()
    counts, found = periodic.runs_of(pa.array([" ".join(x) for x in (
        ["a"] * 50_000, ["a", "b"] * 25_000, (["a"] * 200 + ["b"]) * 100, lines, fib[-1])]))
    assert time.time() - start < 20
    assert found[0] == [(0, 50_000, 1)] and found[1] == [(0, 50_000, 2)] and 3 not in found
    assert found[2] == sorted([(0, 20_100, 201)] + [(201 * i, 200, 1) for i in range(100)], key=lambda r: (r[0], r[2]))


def test_words_that_collide_modulo_2_64_differ():
    a = "".join("xy"[i.bit_count() % 2] for i in range(2048))
    b = a.translate(str.maketrans("xy", "yx"))
    counts, found = periodic.runs_of(pa.array([" ".join([a] * 12 + [b] + [a] * 12)]))
    assert list(counts) == [25] and found == {}


def test_odd_rows(tricky, no_docs):
    rows, docs = tricky
    extra = [(60, "go " * 30), (60, "go " * 30), (61, "\t".join(["a", "b", "c"] * 9) + "  tail"), (None, "x " * 24)]
    more = docs.sparkSession.createDataFrame(extra, "doc_id long, text string")
    found = periodic.periodic_runs(docs.unionByName(more, allowMissingColumns=True)
                                   .withColumns({"RUNS": F.lit(7), "n_words": F.lit(1), "c1": F.lit("kept")}))
    assert len({c.lower() for c in found.columns}) == len(found.columns) and found.where("c1 = 'kept'").count()
    want = []
    for d, t in [*rows, *extra]:
        words = brute.spaced(t)
        want.append((d, len(words), runs(words), None if t is None else collapsed(words, runs(words))))
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert periodic.periodic_runs(no_docs).collect() == []


def test_query_rows(spark, tmp_path):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abcdefg") * rng.randint(1, 2) for _ in range(rng.randint(0, 160))) for _ in range(60)]
    rows = [*enumerate(texts), (100, None), (101, ""), (102, "go " * 40), (103, "go " * 40 + "on " * 40), (None, "a b")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for d, t in rows:
        words = planted(brute.spaced(t), d)
        found = runs(words)
        best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
        want.append((d, len(found), *best, found and 1000 * best[1] // best[2] or None,
                     brute.sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), brute.sha(collapsed(words, found))))
    got = queries.op13_periodic_runs(spark, str(tmp_path))
    assert by_row(got, *got.columns) == sorted(want, key=repr)
    assert sum(w[1] > 0 for w in want) >= 5


def test_twin_agrees(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    found = queries.op13_periodic_runs(spark, SF_SMALL)
    assert by_row(found, *found.columns) == sorted(con.sql(queries.ORACLE["op13_periodic_runs"]).fetchall(), key=repr)
