"""Connected components of a graph of links, distributed: no links or labels reach the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..durable import drop_materialised, materialise


def component_roots(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) of numbers; root is the least node of its component.

    Each round points every node and its neighbours at the least node known about, first over the larger neighbours and
    then over the smaller ones; the links of a round are written, so the plan stays small and a lost
    executor costs one round. A node of very many links is only aggregated to a minimum and joined back.
    """
    links = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    links = materialise(links.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).distinct(), "links")
    last = None
    for _ in range(most_rounds):
        every = links.unionByName(links.select(F.col("high").alias("low"), F.col("low").alias("high"))).select(F.col("low").alias("node"), F.col("high").alias("other"))
        nearest = every.groupBy("node").agg(F.min("other").alias("to")).select("node", F.least("node", "to").alias("to"))
        upper = every.where("other > node").join(nearest, "node").where("other <> to").select(F.col("other").alias("node"), "to").distinct()
        nearest = upper.groupBy("node").agg(F.min("to").alias("least"))
        lower = upper.join(nearest, "node").select(F.explode(F.array("node", "to")).alias("high"), F.col("least").alias("low")).where("high <> low").distinct()
        after = materialise(lower.select("low", "high"), "links")
        drop_materialised(links)
        links = after
        state = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("low", "high") % 1_000_000_007)).first())
        if state == last or not state[0]:
            return links.select(F.col("high").alias("node"), F.col("low").alias("root")).unionByName(links.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct())
        last = state
    raise RuntimeError("components did not settle")
