r"""Embedding near-duplicates by an epsilon grid order join.

Vectors of one group (equal label and length) link at cosine ``threshold`` or
more, that is at distance eps = sqrt(2 - 2 * threshold) or less between unit
vectors. Unit vectors are turned to their principal directions (fitted on at
most ``FIT_ROWS`` of them: any rotation keeps distances, so the fit decides
only how much is skipped) and sorted by their grid cells of width eps on the
leading ``CELL_DIMS`` directions. Runs of that order become intervals of at
most ``interval`` vectors with the box of cells they touch and the box of
their coordinates in the ``BOX_DIMS`` leading directions.

Intervals whose cells are more than one apart in some direction, or whose
boxes are further apart than eps, are provably distant: first runs of intervals (one
per task) are joined by their cells, then the intervals inside the pairs that
remain by cells and boxes, before any vector moves. Every pair of
intervals left is one row for one task, which halves both sides again and
again, skips halves whose boxes lie further apart than eps, and compares small
ones in double precision. A pair returns, for each vector, its number of links
and the root of its local component, never the links themselves, so a dense
cluster costs rows in proportion to its vectors.

Equal vectors are one node before the join: a vector that a third of all rows
share costs one node. The intervals and all intermediate tables are written to
the shared folder.

Cases: vectors that are null, empty, zero or hold null or non-finite numbers,
rows with a null label or id link with nothing (n_links 0, component_id and
kept by their own id; null for a null id); repeated rows are vectors of their
own and link with each other; vectors of different length never link; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulwise.llm.components import components
from haulwise.llm.store import materialize, prepare

FIT_ROWS = 4096
CELL_DIMS = 4
BOX_DIMS = 16
INTERVAL = 4096
LEAF = 64
SLACK = 1e-9

_GROUP = ["label", "size"]
_LO = [f"lo{i}" for i in range(CELL_DIMS)]
_HI = [f"hi{i}" for i in range(CELL_DIMS)]


def unit_rows(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """vec_id, label (as text), size, unit (doubles as bytes; null if it links with nothing), digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, sizes = [], []
            for value, known in zip(batch.column(2), batch.column(3).to_pylist()):
                unit = None
                if known and value.is_valid and len(value.values) and not value.values.null_count:
                    x = value.values.to_numpy()
                    top = np.abs(x).max()
                    if np.isfinite(top) and top > 0:
                        x = x / top
                        unit = x / math.sqrt(float(x @ x)) + 0.0  # no negative zero
                units.append(None if unit is None else unit.tobytes())
                sizes.append(None if unit is None else len(unit))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int32()), pa.array(units, pa.binary())],
                names=["vec_id", "label", "size", "unit"])

    known = F.col(label_col).isNotNull() & F.col(id_col).isNotNull()
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
                          F.col(vector_col).cast("array<double>").alias("v"), known.alias("known"))
    return rows.mapInArrow(run, "vec_id long, label string, size int, unit binary") \
        .withColumn("digest", F.sha2("unit", 256))


def _rotations(nodes: DataFrame) -> dict[int, np.ndarray]:
    """For each vector length the leading principal directions (as columns), from at most FIT_ROWS vectors."""
    sample = nodes.select("size", "unit").orderBy(F.xxhash64("node"), "node").limit(FIT_ROWS).toArrow()
    sizes = sample["size"].to_numpy()
    out = {}
    for size in np.unique(sizes):
        rows = np.stack([np.frombuffer(u.as_py()) for u, n in zip(sample["unit"], sizes) if n == size])
        _, directions = np.linalg.eigh(rows.T @ rows)
        out[int(size)] = np.ascontiguousarray(directions[:, ::-1][:, :BOX_DIMS])
    return out


def _turn(x: np.ndarray, rotations: dict[int, np.ndarray]) -> np.ndarray:
    """Leading coordinates; a length that the fit did not meet keeps its own first ones."""
    basis = rotations.get(x.shape[1])
    return x @ basis if basis is not None else x[:, :BOX_DIMS]


def _intervals(nodes: DataFrame, rotations, eps: float, interval: int) -> DataFrame:
    """Runs of the grid order: part, block, label, size, box of cells, box of coordinates (low, high), nodes, copies and
    units as bytes."""
    cells = [f"g{i}" for i in range(CELL_DIMS)]

    def grid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(2).to_numpy()
            cell = np.zeros((len(sizes), CELL_DIMS), dtype=np.int32)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                x = np.stack([np.frombuffer(batch.column(3)[int(i)].as_py()) for i in at])
                y = _turn(x, rotations.value)[:, :CELL_DIMS]
                cell[at, :y.shape[1]] = np.floor(y / eps)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c) for c in cell.T)],
                                             names=["node", "label", "size", "unit", "copies", *cells])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, held = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            while held.num_rows > interval:
                n = _run_length(held, interval)
                yield _interval(held.slice(0, n), part, block, rotations.value)
                held, block = held.slice(n), block + 1
        while held is not None and held.num_rows:
            n = _run_length(held, interval)
            yield _interval(held.slice(0, n), part, block, rotations.value)
            held, block = held.slice(n), block + 1

    kinds = "node long, label string, size int, unit binary, copies long"
    placed = nodes.select("node", "label", "size", "unit", "copies") \
        .mapInArrow(grid, f"{kinds}, {', '.join(f'{c} int' for c in cells)}")
    order = [*_GROUP, *cells, "node"]
    box = ", ".join(f"{c} int" for c in [*_LO, *_HI])
    return placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        cut, f"part int, block long, label string, size int, {box}, low array<double>, high array<double>, "
             "nodes binary, copies binary, units binary")


def _run_length(held: pa.Table, interval: int) -> int:
    """Rows of the first interval: one group, at most ``interval`` rows, cut (past a quarter of that) where the order
    moves furthest in its leading directions, so that boxes span fewer clusters."""
    head = held.slice(0, interval + 1)
    label, size = (head[c].to_pylist() for c in _GROUP)
    n = 1
    while n < len(label) and label[n] == label[0] and size[n] == size[0]:
        n += 1
    if n <= interval:
        return n
    cell = np.stack([head[f"g{i}"].to_numpy() for i in range(CELL_DIMS)]).astype(np.int64)
    moves = (np.diff(cell, axis=1) ** 2).sum(axis=0)  # moves[i]: between rows i and i + 1
    least = max(interval // 4, 1)
    late = moves[least - 1:interval]
    return least + int(len(late) - 1 - np.argmax(late[::-1]))


def _interval(rows: pa.Table, part: int, block: int, rotations: dict[int, np.ndarray]) -> pa.RecordBatch:
    y = _turn(np.stack([np.frombuffer(u) for u in rows["unit"].to_pylist()]), rotations)
    cell = np.stack([rows[f"g{i}"].to_numpy() for i in range(CELL_DIMS)])
    values = [part, (part << 32) | block, rows["label"][0].as_py(), rows["size"][0].as_py(),
              *cell.min(axis=1).tolist(), *cell.max(axis=1).tolist(), y.min(axis=0).tolist(), y.max(axis=0).tolist(),
              rows["node"].to_numpy().tobytes(), rows["copies"].to_numpy().tobytes(),
              b"".join(rows["unit"].to_pylist())]
    kinds = [pa.int32(), pa.int64(), pa.string(), *[pa.int32()] * (1 + 2 * CELL_DIMS), *[pa.list_(pa.float64())] * 2,
             *[pa.binary()] * 3]
    names = ["part", "block", *_GROUP, *_LO, *_HI, "low", "high", "nodes", "copies", "units"]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=names)


def _near(a: str, b: str) -> F.Column:
    """Boxes of the aliased rows are at most a cell apart in every leading direction."""
    out = F.lit(True)
    for lo, hi in zip(_LO, _HI):
        out &= (F.col(f"{a}.{lo}") <= F.col(f"{b}.{hi}") + 1) & (F.col(f"{b}.{lo}") <= F.col(f"{a}.{hi}") + 1)
    return out


def _gap(a: str, b: str) -> F.Column:
    """Squared distance between the boxes of the aliased rows, a lower bound for all their vectors."""
    beyond = lambda x, y: F.zip_with(F.col(f"{x}.low"), F.col(f"{y}.high"), lambda lo, hi: F.greatest(lo - hi, F.lit(0.0)))
    apart = F.zip_with(beyond(a, b), beyond(b, a), lambda u, v: F.greatest(u, v))
    return F.aggregate(apart, F.lit(0.0), lambda total, d: total + d * d)


def _pairs(boxes: DataFrame, eps: float) -> DataFrame:
    """Pairs of intervals (a <= b) of one group that are not provably distant: a, b."""
    runs = boxes.groupBy("part", *_GROUP).agg(*[F.min(c).alias(c) for c in _LO], *[F.max(c).alias(c) for c in _HI])
    # each run stands in its first-direction cells; the pair is met in the first cell that both reach
    left = runs.withColumn("cell", F.explode(F.sequence(F.col("lo0"), F.col("hi0") + 1)))
    right = runs.withColumn("cell", F.explode(F.sequence(F.col("lo0"), F.col("hi0") + 1)))
    same_group = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in _GROUP]
    near = left.alias("x").join(
        right.alias("y"),
        same_group[0] & same_group[1] & (F.col("x.cell") == F.col("y.cell")) & (F.col("x.part") <= F.col("y.part"))
        & (F.col("x.cell") == F.greatest("x.lo0", "y.lo0")) & _near("x", "y")
    ).select(*[F.col(f"x.{c}") for c in _GROUP], F.col("x.part").alias("pa"), F.col("y.part").alias("pb"))
    inner = near.alias("p").join(boxes.alias("x"), [F.col(f"p.{c}") == F.col(f"x.{c}") for c in _GROUP]
                                 + [F.col("p.pa") == F.col("x.part")])
    return inner.join(boxes.alias("y"), [F.col(f"p.{c}") == F.col(f"y.{c}") for c in _GROUP]
                      + [F.col("p.pb") == F.col("y.part"), F.col("x.block") <= F.col("y.block"), _near("x", "y")]) \
        .where(_gap("x", "y") <= (eps + SLACK) ** 2).select(F.col("x.block").alias("a"), F.col("y.block").alias("b"))


def close_pairs(xa: np.ndarray, xb: np.ndarray, ya: np.ndarray, yb: np.ndarray, same: bool, threshold: float,
                eps: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs with dot product >= threshold, by recursive halving of two sequences."""
    found_a, found_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    todo = [(0, len(xa), 0, len(xb))]
    reach = (eps + SLACK) ** 2
    while todo:
        a0, a1, b0, b1 = todo.pop()
        if same and b1 <= a0:
            continue
        pa_, pb_ = ya[a0:a1], yb[b0:b1]
        gap = np.maximum(np.maximum(pb_.min(axis=0) - pa_.max(axis=0), pa_.min(axis=0) - pb_.max(axis=0)), 0)
        if gap @ gap > reach:
            continue
        if a1 - a0 <= LEAF and b1 - b0 <= LEAF:
            i, j = np.nonzero(xa[a0:a1] @ xb[b0:b1].T >= threshold - SLACK)
            i, j = i + a0, j + b0
            if same:
                i, j = i[i < j], j[i < j]
            exact = np.einsum("ij,ij->i", xa[i], xb[j]) >= threshold
            found_a.append(i[exact])
            found_b.append(j[exact])
        elif a1 - a0 >= b1 - b0:
            mid = (a0 + a1) // 2
            todo += [(a0, mid, b0, b1), (mid, a1, b0, b1)]
        else:
            mid = (b0 + b1) // 2
            todo += [(a0, a1, b0, mid), (a0, a1, mid, b1)]
    return np.concatenate(found_a), np.concatenate(found_b)


def _local_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    root = np.arange(n)
    while True:
        new = root.copy()
        np.minimum.at(new, i, root[j])
        np.minimum.at(new, j, root[i])
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _compare(pairs: DataFrame, blocks: DataFrame, rotations, threshold: float, eps: float) -> DataFrame:
    """For every vector with links inside a pair: node, n (linked vectors, copies counted), root."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                a, b, size, na, ca, ua, nb, cb, ub = (batch.column(c)[row].as_py() for c in range(9))
                xa, xb = (np.frombuffer(u).reshape(-1, size) for u in (ua, ub))
                ya, yb = (_turn(x, rotations.value) for x in (xa, xb))
                i, j = close_pairs(xa, xb, ya, yb, a == b, threshold, eps)
                if not len(i):
                    continue
                nodes = np.frombuffer(na, np.int64)
                copies = np.frombuffer(ca, np.int64)
                if a != b:
                    j = j + len(nodes)
                    nodes = np.concatenate([nodes, np.frombuffer(nb, np.int64)])
                    copies = np.concatenate([copies, np.frombuffer(cb, np.int64)])
                n = np.bincount(i, copies[j], len(nodes)) + np.bincount(j, copies[i], len(nodes))
                root = nodes[_local_roots(len(nodes), i, j)]
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes[at]), pa.array(n[at].astype(np.int64)), pa.array(root[at])],
                    names=["node", "n", "root"])

    payload = ["nodes", "copies", "units"]
    left = blocks.select(F.col("block").alias("a"), "size", *[F.col(c).alias(f"{c}_a") for c in payload])
    right = blocks.select(F.col("block").alias("b"), *[F.col(c).alias(f"{c}_b") for c in payload])
    rows = pairs.hint("merge").join(left.hint("merge"), "a").join(right.hint("merge"), "b").select(
        "a", "b", "size", *[f"{c}_a" for c in payload], *[f"{c}_b" for c in payload])
    return rows.mapInArrow(run, "node long, n long, root long")


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id",
                    vector_col: str = "embedding", label_col: str = "label", interval: int = INTERVAL) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id (smallest id reachable), kept. ``interval``: the most vectors
    of an interval."""
    spark = vectors.sparkSession
    prepare(spark)
    eps = math.sqrt(2 - 2 * threshold)
    rows = materialize(unit_rows(vectors, id_col, vector_col, label_col), "vectors-unit")
    linking = rows.where(F.col("unit").isNotNull())
    nodes = linking.groupBy(*_GROUP, "digest").agg(
        F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("copies"), F.first("unit").alias("unit"))
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "vectors-nodes")
    rotations = spark.sparkContext.broadcast(_rotations(nodes))
    blocks = materialize(_intervals(nodes, rotations, eps, interval), "vectors-intervals")
    pairs = materialize(_pairs(blocks.select("part", "block", *_GROUP, *_LO, *_HI, "low", "high"), eps), "vectors-pairs")
    found = materialize(_compare(pairs.repartition("a", "b"), blocks, rotations, threshold, eps), "vectors-links")
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), "vectors")
    links = found.groupBy("node").agg(F.sum("n").alias("n"))
    known = nodes.select("node", *_GROUP, "digest", "low", "copies").join(links, "node", "left") \
        .join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lows = known.groupBy("root").agg(F.min("low").alias("component_id"))
    known = materialize(known.join(lows, "root").select(
        F.col("label").alias("_label"), F.col("size").alias("_size"), F.col("digest").alias("_digest"),
        (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"), "vectors-classes")
    out = rows.select("vec_id", "label", "size", "digest").join(
        known, (F.col("label") == F.col("_label")) & (F.col("size") == F.col("_size"))
        & (F.col("digest") == F.col("_digest")), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
