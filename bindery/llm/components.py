"""Connected components of a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node that each node of links (a, b) reaches.

    Each round links every node's neighbours to the smallest of them, first the
    larger ones, then the smaller ones and the node itself; paths shrink by a
    constant factor, so the rounds grow with the logarithm of the longest path. A
    node's smallest neighbour comes from a map-side minimum, which is written so that
    the join back has an exchange on both sides and a hub's rows can be split.
    """
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "components", links.count())
    state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("sum")).first()
    for _ in range(most_rounds):
        n = state["n"]
        both = edges.union(edges.select("v", "u"))
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "components-least", n)
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large, old = written(large, "components-large", n), [edges, least]
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "components-least", n)
        small = large.join(least, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        fresh = written(small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).filter("u <> v").distinct(), "components", n)
        now = fresh.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("sum")).first()
        for done in (*old, large, least):
            discard(done)
        edges = fresh
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select("v", "v").distinct())
        state = now
    raise RuntimeError(f"components: no fixpoint after {most_rounds} rounds")
