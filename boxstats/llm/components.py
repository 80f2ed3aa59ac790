"""Connected components by alternating large-star and small-star steps.

Every step is a grouped minimum (combined map-side) and a join of the edges with one row per node,
so a node with very many neighbours is a skewed join that adaptive execution splits, never a group
collected in one task. The number of rounds grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxstats.llm.common import saved


# Edges per task: a small graph does not need a task for every shuffle partition.
EDGES_PER_TASK = 250_000


def _star(arcs: DataFrame, large: bool, tasks: int) -> DataFrame:
    """One step over arcs (u, v). large: neighbours above u go to the smallest of u and its
    neighbours. small: u and its neighbours below go to the smallest of them."""
    if large:
        both = arcs.unionByName(arcs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = arcs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = saved(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
                  .coalesce(tasks), "star")
    joined = both.join(least, "u")
    if large:
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = (joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v"))
    return saved(moved.distinct().coalesce(tasks), "edges")


def _fingerprint(arcs: DataFrame) -> tuple:
    """Number of edges and sum of their hashes."""
    return tuple(arcs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component) for every node on an edge; the component is its smallest node.

    Ids may be of any ordered type. Edges with a null end are ignored, loops and repeated edges
    are harmless, no edges give no rows.
    """
    arcs = saved(edges.where(F.col(u) != F.col(v)).select(
        F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct(), "edges")
    nodes = arcs.select(F.col("u").alias("node")).union(arcs.select("v")).distinct()
    mark = _fingerprint(arcs)
    while mark[0]:
        # Stars are a fixed point: stop once a round keeps the edges as they are.
        tasks, before = 1 + mark[0] // EDGES_PER_TASK, mark
        arcs = _star(_star(arcs, True, tasks), False, tasks)
        mark = _fingerprint(arcs)
        if mark == before:
            break
    stars = arcs.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return (nodes.join(stars, "node", "left")
            .select("node", F.coalesce("root", "node").alias("component")))
