"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pairloom.llm.shared import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of ``edges`` (a, b); the label is its component's smallest node.

    Large stars and small stars in turn: every node links its larger neighbours, then its smaller
    ones, to the smallest node it knows.  Each round is stored, and a round that changes nothing
    ends it.  Nodes without an edge to another node are not returned.
    """
    def toward(pairs: DataFrame) -> DataFrame:
        low, high = F.least("a", "b"), F.greatest("a", "b")
        return pairs.where("a <> b").select(high.alias("a"), low.alias("b")).distinct()

    now, before = stored(toward(edges)), None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
                now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
        before = state
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = stored(toward(large))
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stored(toward(small.union(smallest.select("a", F.col("m").alias("b")))))
