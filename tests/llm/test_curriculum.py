"""Source mixing against a plain version and the DuckDB twin."""

import duckdb
import pytest
from pyspark.sql import functions as F

from haulwise.llm import curriculum, queries
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.conftest import by_row


def targets(sizes, weights=(5, 2, 1), passes=3):
    """Share, cap, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(passes * sizes[s] for s in full)
        share = sum(weight[s] for s in order if s not in full)
        now = {s: passes * sizes[s] if s in full else weight[s] * left / share for s in order}
        over = {s for s in order if s not in full and now[s] >= passes * sizes[s]}
        if not over:
            return now
        full |= over
        if len(full) == len(order):
            return {s: float(passes * sizes[s]) for s in order}


def sizes_of(rows):
    out = {}
    for _, text, source in rows:
        out[source] = out.get(source, 0) + len(brute.spaced(text))
    return out


def check(rows, found, passes=3):
    sizes = sizes_of(rows)
    want = targets(sizes, passes=passes)
    got = found.collect()
    assert sorted(((r.doc_id, r.size, r.source) for r in got), key=repr) \
        == sorted(((d, len(brute.spaced(t)), s) for d, t, s in rows), key=repr)
    taken = {s: 0 for s in sizes}
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source], rel=1e-12, abs=1e-9)
        assert r.taken == sum(t.words for t in r.takes) <= passes * r.size
        assert len(r.takes) <= passes and all(0 <= t.position <= 1 for t in r.takes)
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 1
    firsts = [r.takes[0].position for r in got if r.takes]
    assert firsts == sorted(firsts) and not any(r.takes for r in got[len(firsts):])
    return got


def mixed(n=300):
    sources = ["b", "a", None, "Z", "é", "漢", "", "empty"]
    rows = [(i, " ".join(["w"] * (i * 7 % 41)), "a" if i % 3 == 0 else sources[i % 7]) for i in range(n)]
    return [*rows, (n, "", "empty"), (n + 1, None, "empty"), (5, "x y", "a"), (5, "x y", "a"), (5, "x z", "a"),
            (None, "n n n", None), (None, "n n n", None), (None, None, None), *((900, "hot hot", "b") for _ in range(150)),
            *((None, f"many {i}", "a") for i in range(150))]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_mix(spark):
    rows = mixed()
    docs = frame(spark, rows).withColumns({"size": F.lit(9), "key": F.lit("x"), "takes": F.lit(0), "target": F.lit(1)})
    got = check(rows, curriculum.curriculum(docs.repartition(7)))
    again = curriculum.curriculum(docs.repartition(2)).collect()
    plain = lambda found: sorted(((r.doc_id, r.size, r.source, r.taken, r.takes) for r in found), key=repr)
    assert plain(got) == plain(again)


def test_odd_rows(tricky, no_docs):
    rows, docs = tricky
    check([(d, t, "s") for d, t in rows], curriculum.curriculum(docs))
    assert curriculum.curriculum(no_docs).collect() == []
    blank = docs.withColumn("text", F.lit(None).cast("string"))
    assert {(r.target, r.taken) for r in curriculum.curriculum(blank).collect()} == {(0.0, 0)}


def test_small_sources_fill_up_in_turn(spark):
    rows = [(i, " ".join(["w"] * n), s) for i, (s, n) in enumerate([("a", 1), ("b", 40), ("c", 9), ("d", 500), ("e", 3)])]
    got = check(rows, curriculum.curriculum(frame(spark, rows), passes=2), passes=2)
    by = {r.source: r for r in got}
    assert by["a"].taken == 2 and by["b"].taken == 80 and by["e"].taken == 6


@pytest.mark.parametrize("curve", [*curriculum.CURVES, ((0, 0), (0.3, 2), (0.3, 1), (0.7, 1), (1, 0))])
def test_positions_invert_the_integral(spark, curve):
    def integral(t):
        out = 0.0
        for (a, v), (b, w) in zip(curve, curve[1:]):
            if b > a and t > a:
                u = min(t, b)
                out += (u - a) * (v + v + (w - v) * (u - a) / (b - a)) / 2
        return out
    shares = spark.range(200).select((F.col("id") / 200).alias("y"))
    for y, t in shares.select("y", curriculum.position(F.col("y"), curve)).collect():
        assert integral(t) / integral(1) == pytest.approx(y, abs=1e-9)
    with pytest.raises(ValueError):
        curriculum.position(F.lit(0.5), ((0, -1), (1, 2)))


def test_training_order(spark):
    rows = mixed(80)
    docs = frame(spark, rows).repartition(3)
    got = curriculum.training_order(docs).collect()
    taken = {}
    for r in got:
        assert r.words <= len(brute.spaced(r.text))
        taken[r.source] = taken.get(r.source, 0) + r.words
    want = targets(sizes_of(rows))
    assert all(abs(taken.get(s, 0) - w) <= 1 for s, w in want.items())
    places = [r.position for r in got]
    assert places == sorted(places)


def test_early_and_late_sources(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 5)), "abc"[i % 3]) for i in range(3000)]
    got = curriculum.training_order(frame(spark, rows)).collect()
    half = {s: sum(r.words for r in got if r.source == s and r.position < 0.5) / sum(r.words for r in got if r.source == s)
            for s in "abc"}
    assert half["a"] == pytest.approx(0.625, abs=0.01) and half["b"] == pytest.approx(0.5, abs=0.01) \
        and half["c"] == pytest.approx(0.375, abs=0.01)


def test_no_python_in_plans(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for df in (curriculum.pieces(docs, "doc_id", "text", "source"), curriculum.curriculum(docs), curriculum.training_order(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Nested", "Cartesian", "ExistingRDD"))


def test_twin_agrees(spark, tmp_path):
    frame(spark, mixed()).write.parquet(f"{tmp_path}/documents.parquet")
    for sf, files in ((SF_SMALL, "documents.parquet"), (str(tmp_path), "documents.parquet/*.parquet")):
        con = duckdb.connect()
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/{files}'")
        found = queries.op12_source_mix(spark, sf)
        assert by_row(found, *found.columns) == sorted(con.sql(queries.ORACLE["op12_source_mix"]).fetchall(), key=repr)
