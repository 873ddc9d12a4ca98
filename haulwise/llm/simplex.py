r"""Centroid clustering with exact integer distances, filtered by an n-simplex projection.

Vectors of ``dims`` components become integers ``floor(scale * x)``. Centroids
start as the vectors whose ids hash lowest; every round assigns each vector to
its nearest centroid (squared Euclidean distance, ties to the smaller number)
and moves every centroid to the componentwise floor of its vectors' mean.

How: a few of the starting vectors are pivots, chosen so that each stands far
off the simplex of those before it. Every vector's distances to the pivots are
worked out once and kept, as its apex over the pivots' simplex: coordinates
whose Euclidean distance bounds the true distance from below, and with the
last coordinate's sign turned from above. In each round a centroid is compared
exactly, in integers, only if its lower bound reaches the least upper bound of
the vector, so the bounds (with room for rounding) decide what is skipped and
never a result. Tables of vectors and apexes are written to the shared folder;
a task sums its vectors per centroid, so a round shuffles ``k`` rows a task and
the driver sees ``k`` centroids.

Cases: vectors that are null, have another number of components or hold null
or non-finite ones are left out; a null id starts no centroid, its vector is
assigned like any other; repeated rows count each; equal hashes are ordered
by components; fewer vectors than ``k`` start fewer centroids; a table without
vectors gives an empty result; other columns are not read. Integers beyond
``LARGEST`` would overflow the distances and raise ValueError.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulwise.llm.store import materialize, prepare

#: Of a component: 2^14 components at this bound keep squared distances below 2^63.
LARGEST = 1 << 23
SLICE = 2048
#: Rounding allowed for in the bounds, as a share of the squared lengths.
SLACK = 1e-6


class Pivots(NamedTuple):
    """``points`` (p x dims integers), their simplex (p - 1 lower triangular rows; the first is the origin)."""

    points: np.ndarray
    simplex: np.ndarray


class Clusters(NamedTuple):
    """``rows``: vec_id, cluster, distance, n_compared; ``centroids``: cluster, centroid, n, inertia."""

    rows: DataFrame
    centroids: DataFrame


def squared(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Exact squared distances (n x m) of integer rows."""
    out = np.empty((len(points), len(others)), dtype=np.int64)
    for j, other in enumerate(others):
        step = points - other
        out[:, j] = np.einsum("ij,ij->i", step, step)
    return out


def apexes(distances: np.ndarray, simplex: np.ndarray) -> np.ndarray:
    """Apex coordinates from squared distances to the pivots (n x p); the last is the height, never negative."""
    d = distances.astype(np.float64)
    right = (d[:, :1] + np.einsum("ij,ij->i", simplex, simplex) - d[:, 1:]) / 2
    base = np.linalg.solve(simplex, right.T).T if len(simplex) else right
    height = np.sqrt(np.maximum(d[:, 0] - np.einsum("ij,ij->i", base, base), 0))
    return np.column_stack([base, height])


def choose_pivots(points: np.ndarray, most: int, least_share: float = 1e-3) -> Pivots:
    """Up to ``most`` of ``points``, each the highest above the simplex so far; points nearly inside it are none."""
    chosen, simplex = [0], np.zeros((0, 0))
    width = float(squared(points, points[:1]).max()) ** 0.5
    while len(chosen) < most:
        spots = apexes(squared(points, points[chosen]), simplex)
        best = int(np.argmax(spots[:, -1]))
        if spots[best, -1] <= least_share * width:
            break
        size = len(chosen)
        grown = np.zeros((size, size))
        grown[:size - 1, :size - 1] = simplex
        grown[size - 1] = spots[best]
        chosen.append(best)
        simplex = grown
    return Pivots(points[chosen], simplex)


def nearest(points: np.ndarray, spots: np.ndarray, centroids: np.ndarray,
            pivots: Pivots) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cluster, squared distance and number of centroids compared exactly, for each row."""
    heads = apexes(squared(centroids, pivots.points), pivots.simplex)
    step = spots[:, None, :] - heads[None]
    low = np.einsum("ijk,ijk->ij", step, step)
    high = low + 4 * spots[:, -1:] * heads[:, -1]
    room = SLACK * (1 + np.einsum("ij,ij->i", spots, spots) + np.einsum("ij,ij->i", heads, heads).max())
    row, at = np.nonzero(low <= (high.min(axis=1) + room)[:, None])
    step = points[row] - centroids[at]
    distances = np.full(low.shape, np.iinfo(np.int64).max)
    distances[row, at] = np.einsum("ij,ij->i", step, step)
    cluster = distances.argmin(axis=1)
    return cluster, distances[np.arange(len(points)), cluster], np.bincount(row, minlength=len(points))


def _rows(column: pa.Array, kind) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1).astype(kind, copy=False)


def quantized(vectors: DataFrame, dims: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and point (integers) of the vectors that count."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.col(vector_col).cast("array<double>").alias("v"))
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = np.floor(scale * _rows(batch.column(1), np.float64))
            if len(points) and np.abs(points).max() > LARGEST:
                raise ValueError(f"a component times {scale} is beyond {LARGEST}: distances would overflow")
            offsets = np.arange(len(points) + 1, dtype=np.int32) * dims
            column = pa.ListArray.from_arrays(offsets, points.astype(np.int32).ravel())
            yield pa.RecordBatch.from_arrays([batch.column(0), column], names=["vec_id", "point"])

    return rows.where((F.size("v") == dims) & whole).mapInArrow(run, "vec_id long, point array<int>")


def start(points: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` points with the smallest hash of ``seed:vec_id``, in that order."""
    hashed = points.withColumn("hash", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256))
    first = hashed.where("hash IS NOT NULL").orderBy("hash", "point").limit(k).select("point").collect()
    return np.array([r.point for r in first], dtype=np.int64)


def projected(points: DataFrame, pivots: Pivots) -> DataFrame:
    """``points`` with the column ``spot``: the apex over the pivots' simplex."""
    p = len(pivots.points)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spots = apexes(squared(_rows(batch.column(1), np.int64), pivots.points), pivots.simplex)
            offsets = np.arange(len(spots) + 1, dtype=np.int32) * p
            column = pa.ListArray.from_arrays(offsets, spots.ravel())
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=["vec_id", "point", "spot"])

    return points.mapInArrow(run, "vec_id long, point array<int>, spot array<double>")


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, pivots: Pivots):
    """Slices of at most SLICE rows: ids, points, cluster, distance, centroids compared."""
    for batch in batches:
        for a in range(0, batch.num_rows, SLICE):
            part = batch.slice(a, SLICE)
            points = _rows(part.column(1), np.int64)
            yield part.column(0), points, *nearest(points, _rows(part.column(2), np.float64), centroids, pivots)


def moved(cached: DataFrame, centroids: np.ndarray, pivots: Pivots) -> np.ndarray:
    """Centroids after one round: the exact floor of the mean; one without vectors stays."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(k, dtype=np.int64), np.zeros((k, dims), dtype=np.int64)
        for _, points, cluster, _, _ in _assigned(batches, centroids, pivots):
            order = np.argsort(cluster, kind="stable")
            found, first = np.unique(cluster[order], return_index=True)
            sums[found] += np.add.reduceat(points[order], first, axis=0)
            n += np.bincount(cluster, minlength=k)
        yield pa.RecordBatch.from_pydict({"cluster": np.arange(k, dtype=np.int32), "n": n, "sums": sums.tolist()},
                                         pa.schema({"cluster": pa.int32(), "n": pa.int64(), "sums": pa.list_(pa.int64())}))

    parts = cached.mapInArrow(run, "cluster int, n long, sums array<long>").where("n > 0")
    total = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[
        F.sum(F.col("sums")[i]) for i in range(dims)]).alias("sums"))
    out = centroids.copy()
    for r in total.collect():  # one row per centroid
        out[r.cluster] = [s // r.n for s in r.sums]
    return out


def assigned(cached: DataFrame, centroids: np.ndarray, pivots: Pivots) -> DataFrame:
    """vec_id, cluster, distance (squared), n_compared (centroids whose distance was worked out)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, cluster, distance, compared in _assigned(batches, centroids, pivots):
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(cluster, pa.int32()), pa.array(distance), pa.array(compared, pa.int32())],
                names=["vec_id", "cluster", "distance", "n_compared"])

    return cached.mapInArrow(run, "vec_id long, cluster int, distance long, n_compared int")


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1,
            pivots: int = 8, id_col: str = "vec_id", vector_col: str = "embedding") -> Clusters:
    """``rounds`` of moving centroids, then a last assignment. ``pivots``: the most pivots taken (1 to k)."""
    spark = vectors.sparkSession
    prepare(spark)
    points = materialize(quantized(vectors, dims, scale, id_col, vector_col), "simplex-points")
    centroids = start(points, k, seed)
    if not len(centroids):
        return Clusters(spark.createDataFrame([], "vec_id long, cluster int, distance long, n_compared int"),
                        spark.createDataFrame([], "cluster int, centroid array<long>, n long, inertia long"))
    chosen = choose_pivots(centroids, pivots)
    cached = materialize(projected(points, chosen), "simplex-apexes")
    for _ in range(rounds):
        centroids = moved(cached, centroids, chosen)
    rows = materialize(assigned(cached, centroids, chosen), "simplex-clusters")
    sums = {r.cluster: r for r in rows.groupBy("cluster").agg(F.count("*").alias("n"), F.sum("distance").alias("d"))
            .collect()}  # one row per centroid
    table = [(i, c.tolist(), sums[i].n if i in sums else 0, sums[i].d if i in sums else 0)
             for i, c in enumerate(centroids)]
    return Clusters(rows, spark.createDataFrame(table, "cluster int, centroid array<long>, n long, inertia long"))


def centroid_digest(centroid: Column) -> Column:
    """SHA-256 of the components as decimal integers joined by commas."""
    return F.sha2(F.array_join(centroid.cast("array<string>"), ",").cast("binary"), 256)
