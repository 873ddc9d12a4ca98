"""Centroid clustering against brute force and the DuckDB twin."""

import hashlib
import math
import struct

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from haulwise.llm import queries, simplex
from tests.conftest import SF_SMALL
from tests.llm.conftest import by_row


def f32(x):
    return struct.unpack("f", struct.pack("f", x))[0]


def brute(rows, k=16, rounds=3, dims=64):
    """(vec_id, vector) -> [(vec_id, cluster, distance)], centroids; plain integers throughout."""
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted((r for r in kept if r[0] is not None), key=key)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        of = [nearest(v)[1] for _, v in kept]
        for n in range(len(centroids)):
            own = [v for (_, v), c in zip(kept, of) if c == n]
            if own:
                centroids[n] = [sum(x) // len(own) for x in zip(*own)]
    return [(i, *nearest(v)[::-1]) for i, v in kept], centroids


def vectors(n, dims=64, groups=12, seed=1, spread=0.2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dims))
    rows = centres[rng.integers(0, groups, n)] + spread * rng.normal(size=(n, dims))
    return [(i, [f32(x) for x in r]) for i, r in enumerate(rows.tolist())]


def odd_rows():
    rows = vectors(150)
    same = rows[0][1]
    nan, inf = float("nan"), float("inf")
    return [*rows, *((1000 + i, same) for i in range(40)), (7, rows[8][1]), (7, rows[9][1]), (7, rows[9][1]),
            (None, rows[3][1]), (None, same), (900, None), (901, []), (902, same[:63]), (903, [*same, 1.0]),
            (904, [nan, *same[1:]]), (905, [inf, *same[1:]]), (906, [None, *same[1:]]), (907, [0.0] * 64),
            (908, [-0.0] * 64), (909, [-1e-9] * 64)]


SCHEMA = "vec_id long, embedding array<float>"


def test_odd_rows(spark):
    rows = odd_rows()
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"cluster": F.lit(3), "point": F.lit("x"), "hash": F.lit(0)})
    found = simplex.cluster(df.repartition(5))
    want, centroids = brute(rows)
    assert by_row(found.rows, "vec_id", "cluster", "distance") == sorted(want, key=repr)
    table = {r.cluster: r for r in found.centroids.collect()}
    assert [table[i].centroid for i in range(16)] == centroids
    assert sum(r.n for r in table.values()) == len(want)
    assert sum(r.inertia for r in table.values()) == sum(d for _, _, d in want)


@pytest.mark.parametrize("rows", [[], [(1, None), (2, [1.0])], vectors(5), [(i, [0.5] * 64) for i in range(30)]])
def test_few_or_equal_vectors(spark, rows):
    found = simplex.cluster(spark.createDataFrame(rows, SCHEMA))
    assert by_row(found.rows, "vec_id", "cluster", "distance") == sorted(brute(rows)[0], key=repr)


def test_query_rows(spark, tmp_path):
    rows = odd_rows()
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    placed, centroids = brute(rows)
    of = {}
    for _, c, d in placed:
        of[c] = of.get(c, 0) + d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    want = [(i, c, d, of[c], sum(of.values()), digest[c]) for i, c, d in placed]
    got = queries.op11_centroid_clusters(spark, str(tmp_path))
    assert by_row(got, *got.columns) == sorted(want, key=repr)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    assert sorted(con.sql(queries.ORACLE["op11_centroid_clusters"]).fetchall(), key=repr) == sorted(want, key=repr)


def test_twin_agrees(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_SMALL}/embeddings.parquet'")
    found = queries.op11_centroid_clusters(spark, SF_SMALL)
    assert by_row(found, *found.columns) == sorted(con.sql(queries.ORACLE["op11_centroid_clusters"]).fetchall(), key=repr)


@pytest.mark.parametrize("dims, most", [(64, 8), (64, 1), (3, 8), (1, 4)])
def test_bounds_hold_and_never_decide(dims, most):
    points = np.array([[math.floor(64 * x) for x in v] for _, v in vectors(800, dims)])
    centroids = np.vstack([points[:12], points[3:4], points[3:4] + 1, points[:2] * 3])
    pivots = simplex.choose_pivots(centroids, most)
    spots = simplex.apexes(simplex.squared(points, pivots.points), pivots.simplex)
    heads = simplex.apexes(simplex.squared(centroids, pivots.points), pivots.simplex)
    exact = simplex.squared(points, centroids)
    low = ((spots[:, None] - heads[None]) ** 2).sum(axis=2)
    assert (low <= exact * (1 + 1e-9) + 1e-6).all()
    assert (low + 4 * spots[:, -1:] * heads[:, -1] >= exact * (1 - 1e-9) - 1e-6).all()
    cluster, distance, compared = simplex.nearest(points, spots, centroids, pivots)
    assert (cluster == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
    assert len(pivots.points) <= min(most, dims + 1)
    if most > 1:
        assert compared.mean() < len(centroids) / 2


def test_large_components_are_refused(spark):
    from pyspark.errors import PythonException
    rows = spark.createDataFrame([(1, [1e30] * 64)], SCHEMA)
    with pytest.raises(PythonException, match="overflow"):
        simplex.cluster(rows)
