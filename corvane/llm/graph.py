"""Connected components of an edge table, by repeated stars.

Each round connects every node's larger neighbours to its smallest neighbour
(large star) and its smaller ones to the smallest of all (small star); the edges
end as stars around each component's smallest node. Edges are written to the
shared folder after every round, so a lost executor costs one round at most,
and neither edges nor labels reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges``: distinct (u, v) with u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")).withColumnRenamed("u", "n")
    joined = both.join(least, both["u"] == least["n"])
    if large:
        new = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        new = joined.select("u", "v", "m").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
    return new.filter("u <> v").distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node that some edge names.

    Loops and repeated or reversed edges are allowed; an edge with a null end is
    left out; without edges the result is empty. ``edges`` is evaluated once. The
    centre of a large component is a frequent key of the joins below, which
    adaptive execution splits; sums and minima are combined before they travel.
    """
    named = edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    every = materialise(named.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    nodes, cur = every.filter("u = v").select(F.col("u").alias("node")), every.filter("u <> v")
    state = None
    while True:
        new = materialise(_star(_star(cur, large=True), large=False))
        now = new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        cur = new
        if now == state or not now[0]:
            break
        state = now
    labels = cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    loops = nodes.join(labels, "node", "left_anti").select("node", F.col("node").alias("component"))
    return labels.unionByName(roots).unionByName(loops).distinct()
