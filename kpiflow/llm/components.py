"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiflow.llm.common import cut


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b") % 1_000_000_007), F.lit(0))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in ``edges`` (a, b); component is the smallest node reachable.

    Each round points nodes at the smallest neighbour, by minimum per node (summed
    on the map side) and a join that AQE splits at hub nodes; a node's neighbours
    are never gathered. Rounds grow with the logarithm of the longest chain, and
    each is written to the shared folder.
    """
    ends = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    now = cut(ends.distinct())
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = cut(large)
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = cut(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        before, state = state, _state(now)
        if before == state:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
