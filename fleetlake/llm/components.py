"""Connected components of an edge table by alternating stars.

Large-star and small-star steps (each one grouped minimum and one join) replace
every edge by edges to smaller neighbours; the edge count never grows, and every
round is cut to the shared folder.  A hot node costs only pre-aggregated rows:
minima are combined before the shuffle, and they are written out before edges are
joined to them, so that both sides of a join are plain exchanges, whose large
partitions adaptive execution splits.  Only the count of changed rows reaches the
driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import cut

MAX_ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges (u > v).  Large: larger neighbours of a node go to its
    least neighbour; small: a node and its smaller neighbours go to the least."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = cut(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        moved = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = cut(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
        moved = (edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))))
    return moved.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges(u, v)``; the component is its
    least node.  Nulls must have been removed."""
    now = cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "cc")
    for _ in range(MAX_ROUNDS):
        # a star forest: no node is both a centre and a leaf, and no leaf has two centres
        state = (now.select("u", F.lit(1).alias("leaf"), F.lit(0).alias("centre"))
                 .unionByName(now.select(F.col("v").alias("u"), F.lit(0).alias("leaf"), F.lit(1).alias("centre")))
                 .groupBy("u").agg(F.sum("leaf").alias("leaf"), F.max("centre").alias("centre")))
        if state.where("leaf > 1 OR (leaf = 1 AND centre = 1)").isEmpty():
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        now = cut(_star(_star(now, True), False), "cc")
    raise RuntimeError("components did not settle")
