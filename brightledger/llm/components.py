"""Connected components by alternating large-star and small-star steps (Kiveris et al. 2014).

Every round is two groupings and two joins of the edges that are left; the edge count never grows. The
minima are written to the shared folder before they are joined, so both sides of the join are plain
exchanges and a node with very many links is split by the skew join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightledger.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links the larger (or the smaller and equal) neighbours of each node to its smallest one."""
    if large:
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges
    least = stored(near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    joined = near.join(least, "u")
    if large:
        linked = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        linked = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return linked.where("u > v").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node has one link to a smaller one at most, and none goes on from there."""
    if not edges.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        return False
    return edges.join(edges.select(F.col("u").alias("v")), "v", "left_semi").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node with a link; ``edges`` has two long columns ``u`` and ``v``.

    ``component`` is the smallest node that can be reached.
    """
    now = stored(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    while not _are_stars(now):
        now = stored(_star(_star(now, large=True), large=False))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
