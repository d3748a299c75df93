"""Connected components of an undirected graph given as pairs of ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from larder.llm.common import keep


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in ``edges`` (columns a, b); component is its least node.

    Alternates the large-star and small-star steps, each a minimum per node and
    a join of the pairs with it, until the pairs no longer change: a number of
    rounds that grows with the logarithm of the graph, however long its chains.
    A node with very many pairs is a skewed join side, which Spark splits.
    Self-pairs make a node its own component; null ids are ignored.
    """
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter(F.col("a").isNotNull() & F.col("b").isNotNull())
    nodes = pairs
    pairs = keep(pairs.filter("u <> v").distinct(), "pairs")
    state = None
    while True:
        summary = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(summary) == state or not summary[0]:
            break
        state = tuple(summary)
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = keep(both.groupBy("u").agg(F.least(F.min("v"), F.min("u")).alias("m")), "least")
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = keep(large.filter("u <> v").distinct(), "large")
        least = keep(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = keep(small.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(), "pairs")
    found = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    every = nodes.select(F.col("u").alias("node")).unionByName(nodes.select(F.col("v").alias("node"))).distinct()
    return every.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
