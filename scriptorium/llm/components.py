"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import dropped, in_tasks_of, written

#: Edges a task writes.
EACH = 200_000


def _minima(both: DataFrame) -> DataFrame:
    """The smallest neighbour of each node, itself included."""
    return both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every node that has an edge; a component is its smallest node.

    Each step replaces a node's edges by edges to the smallest node it knows: first those to larger
    neighbours, then those to smaller ones, until the edges form stars.  The number of steps grows
    with the logarithm of a component's size.  A node with very many edges is one key of an
    aggregation with partial sums and of a join that Spark can split; no step gathers a node's edges.
    Each step is written to the shared folder; the last is the one after which every node has one edge, to a
    node that has none.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    n = edges.count()  # no step makes more of them
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_minima(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = large.where("u <> v")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        last, e = e, written(in_tasks_of(small.distinct(), n, EACH), "stars")
        dropped(last)
        ends = e.select(F.col("u").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(e.select(F.col("v").alias("x"), F.lit(0).alias("out"), F.lit(1).alias("into")))
        if ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("into").alias("into")).where("out > 1 OR out = 1 AND into = 1").isEmpty():
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
