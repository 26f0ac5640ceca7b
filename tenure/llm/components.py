"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenure.llm.tables import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the neighbours of each node to its smallest neighbour: the larger ones, or the smaller ones and the node."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = both.filter("b < a")
    least = both.groupBy("a").agg(F.min("b").alias("_m")).withColumn("_m", F.least("a", "_m"))
    joined = both.join(least, "a")
    if large:
        made = joined.filter("b > a").select(F.col("_m").alias("a"), "b")
    else:
        made = joined.select(F.col("_m").alias("a"), "b").unionByName(least.select(F.col("_m").alias("a"), F.col("a").alias("b")))
    return made.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that the undirected links (a, b) reach from each node with a link.

    Large stars link the larger neighbours of a node to its smallest neighbour, small stars the rest; the rounds
    end when the links no longer change, which is when each component is one star around its smallest node.
    Their number grows with the logarithm of the number of nodes. A node with very many links is a key with many
    rows, which is aggregated before the shuffle and joined by splitting.
    """
    now = written(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    if now.isEmpty():
        return now.select(F.col("b").alias("node"), F.col("a").alias("component"))
    seal = None
    while True:
        now = written(_star(_star(now, large=True), large=False))
        fresh = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if fresh == seal:
            break
        seal = fresh
    return now.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
