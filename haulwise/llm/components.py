"""Connected components by repeated contraction to a neighbour.

Every round maps each node to the one of its closed neighbourhood that comes
first in an order by hash, another in each round, relabels the edges and drops
the ones that became loops. On average a share of the nodes goes in each round
whatever the ids and the shape (a long chain too). Round maps are written to the shared folder and composed
backwards at the end. Joins are many-to-one on node ids (AQE may split a hub),
the minimum per node is combined before its shuffle, and nothing but the count
of remaining edges reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulwise.llm.store import materialize


def components(edges: DataFrame, name: str) -> DataFrame:
    """``edges`` (a, b long, any order, repeats and loops allowed) -> (node, root).

    ``root`` is a node of the component, the same for all its nodes. Nodes
    that have no edge to another node are absent.
    """
    pairs = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = materialize(pairs.where("a < b").distinct(), f"{name}-edges0")
    maps = []
    while not pairs.isEmpty():
        k = len(maps)
        both = pairs.union(pairs.select("b", "a"))
        place = lambda c: F.struct(F.xxhash64(F.lit(k), F.col(c)).alias("h"), F.col(c).alias("id"))
        step = materialize(
            both.groupBy(F.col("a").alias("node")).agg(F.min(place("b")).alias("low"))
            .select("node", F.least(place("node"), F.col("low"))["id"].alias("to")), f"{name}-map{k}")
        maps.append(step)
        left = step.select(F.col("node").alias("a"), F.col("to").alias("ta"))
        right = step.select(F.col("node").alias("b"), F.col("to").alias("tb"))
        moved = pairs.join(left, "a").join(right, "b").where("ta <> tb")
        pairs = materialize(
            moved.select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct(),
            f"{name}-edges{k + 1}")
    if not maps:
        return pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
    root = maps[-1].select("node", F.col("to").alias("root"))
    for step in reversed(maps[:-1]):
        later = root.select(F.col("node").alias("to"), F.col("root").alias("far"))
        root = step.join(later, "to", "left").select("node", F.coalesce("far", "to").alias("root"))
    return materialize(root, f"{name}-roots")
