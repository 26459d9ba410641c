"""Connected components of a graph of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kickflow.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (its component's smallest node) for each node of ``links`` (a, b).

    A large-star step links a node's larger neighbours to its smallest; a small-star step does
    so with its smaller ones. Both keep components and, repeated, leave stars; the number of
    rounds grows with the logarithm of the number of nodes. A node with many neighbours is
    aggregated before it is shuffled, and its rows in the join are split by size.
    """
    edges = links.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
    edges = stored(edges.where("high <> low").distinct(), "links")
    before = None
    while True:
        both = edges.select(F.col("high").alias("u"), F.col("low").alias("v")).unionAll(
            edges.select(F.col("low").alias("u"), F.col("high").alias("v"))
        )
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        larger = both.where("v > u").join(least, "u").select(F.col("v").alias("high"), F.col("m").alias("low"))
        edges = stored(larger.where("high <> low").distinct(), "links")
        # small star: neighbours below a node, and the node itself, to the smallest of them
        least = edges.groupBy("high").agg(F.min("low").alias("m"))
        smaller = edges.join(least, "high").select(F.col("low").alias("high"), F.col("m").alias("low"))
        smaller = smaller.unionAll(least.select("high", F.col("m").alias("low")))
        edges = stored(smaller.where("high <> low").distinct(), "links")
        now = edges.agg(
            F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))
        ).first()
        if now == before:
            break
        before = now
    nodes = edges.select(F.col("high").alias("node"), F.col("low").alias("root"))
    return nodes.unionAll(edges.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct())
