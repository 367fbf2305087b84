"""Connected components by alternating large and small stars.

Every round is a partially aggregated minimum per node and one join back, so a hub costs
no task more than its share (the join's hub side is split by adaptive execution).  Edges
are written to the checkpoint folder each round.  Labels are the smallest node of each
component; rounds grow with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import saved


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges if not large else edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.join(least, "u")
    if large:  # neighbours above the node hang on its least neighbour
        return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    # neighbours below the node (edges run downwards), and the node itself, hang on the least
    moved = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(u, v)``; nulls and loops are left
    out, repeated edges count once, no edges give no rows.  ``component`` is the
    component's least node."""
    now = saved(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = _state(now)
    while state[0]:
        now = saved(_star(_star(now, large=True), large=False))
        state, before = _state(now), state
        if state == before:
            break
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum((F.xxhash64("v", "u") % 1000003).cast("long"))).first())
