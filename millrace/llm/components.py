"""Connected components of a graph of links, distributed: no links or labels reach the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_materialised, materialise


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the least node of its component.

    Alternating large-star and small-star rounds: each connects neighbours to the least node they know
    of, first the larger neighbours, then the smaller ones. A node with very many neighbours is only ever
    aggregated to a minimum and joined back, which adaptive execution splits. The edges of every round are
    written, so the plan doesn't grow and a lost executor costs one round at most.
    """
    edges = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    edges = materialise(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where(F.col("a") != F.col("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(small.select("a", F.col("m").alias("b")))
        after = materialise(small.where(F.col("a") != F.col("b")).distinct(), "edges")
        drop_materialised(edges)
        edges = after
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first())
        if state == before or not state[0]:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
