"""Connected components of a link table by alternating stars.

Large star links every larger neighbour of a node to the node's least neighbour, small star every
smaller one; both keep the components, and they end with one star per component. A round is two
aggregations by minimum (combined before the shuffle) and two equi-joins; no group is collected.
Every round is written to the shared folder, so the plan stays short and survives a lost executor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textforge.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` of every node with a link; the component is its least node.

    ``edges`` has two columns of one integer type. Links of a node to itself and nulls are ignored;
    an empty table gives an empty one.
    """
    a, b = edges.columns
    edges = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct()
    before = None
    while True:
        edges = materialize(_small_star(_large_star(edges)), "components")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before:
            break
        before = now
    ends = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return ends.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
