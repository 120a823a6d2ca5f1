"""Connected components of large graphs by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scfsweep.llm.common import staged

MAX_ROUNDS = 60


def are_stars(edges: DataFrame) -> bool:
    """Whether no node of edges(a, b), different ones with b below a, hangs on two others or on one that hangs itself."""
    ends = edges.selectExpr("a as node", "1 as hangs", "0 as holds").union(edges.selectExpr("b as node", "0 as hangs", "1 as holds"))
    nodes = ends.groupBy("node").agg((F.sum("hangs") + F.max("holds")).alias("n"))
    return (nodes.agg(F.max("n").alias("n")).first().n or 0) < 2


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges(a, b), root being the least node of its component.

    Each round hangs a node's larger neighbours on its least one, then does the same with the smaller
    ones; both are one aggregation and one join on the node, and a node with very many neighbours is
    summed before it is shuffled. Rounds grow with the logarithm of the component's size; none follows once
    all components are stars, which the edges may be from the start.
    """
    edges = staged(spark, edges.selectExpr("greatest(a, b) as a", "least(a, b) as b").filter("a != b").distinct(), "edges")
    for _ in range(MAX_ROUNDS):
        if are_stars(edges):
            break
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).selectExpr("a", "least(a, m) as m")
        large = both.join(least, "a").filter("b > a and b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # neighbours below a node go with it to its least one
        large = staged(spark, large.union(least.filter("a != m")).distinct(), "large")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").selectExpr("b as a", "m as b").filter("a != b").union(low.selectExpr("a", "m as b"))
        edges = staged(spark, small.distinct(), "small")
    else:
        raise RuntimeError("the components did not settle")
    stars = edges.selectExpr("a as node", "b as root")
    return stars.union(stars.select(F.col("root").alias("node"), "root").distinct())
