"""Connected components of an edge table by alternating stars.

Every round replaces the edges by stars around local minima: the large
star links each larger neighbour of a node to the node's smallest
neighbour, the small star does so for the smaller ones.  The number of
rounds grows with the logarithm of the longest path.  Each round is
written to the shared folder, so no lineage builds up, and only counts
reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import materialise


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Edges (node, root) after one star operation; input edges are (node, root) too."""
    if larger:
        around = edges.unionByName(edges.select(F.col("root").alias("node"), F.col("node").alias("root")))
    else:
        around = edges
    around = around.withColumnsRenamed({"node": "u", "root": "v"})
    smallest = around.groupBy("u").agg(F.min("v").alias("m"))
    smallest = smallest.withColumn("m", F.least("u", "m"))
    joined = around.join(smallest, "u")
    if larger:
        out = joined.filter("v > u").select(F.col("v").alias("node"), F.col("m").alias("root"))
    else:
        own = smallest.select(F.col("u").alias("node"), F.col("m").alias("root"))
        out = joined.select(F.col("v").alias("node"), F.col("m").alias("root")).unionByName(own)
    return out.filter("node > root").distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root``: the smallest node reachable, for every node but the roots themselves.

    ``edges`` may repeat, point either way and hold loops; nulls are no
    nodes.  Nodes without a row here are their own component.
    """
    spark = edges.sparkSession
    now = edges.select(F.greatest(a, b).alias("node"), F.least(a, b).alias("root")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    now = materialise(spark, now, "edges")
    seen = _state(now)
    while seen[0]:
        now = materialise(spark, _star(_star(now, larger=True), larger=False), "edges")
        state = _state(now)
        if state == seen:
            break
        seen = state
    return now


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first()
    return tuple(row)
