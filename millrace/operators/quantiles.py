"""Exact percentiles of a column of any size: no task sorts more than a range of the distinct values."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..durable import drop_materialised, materialise


def exact_percentiles(rows: DataFrame, value: Column, shares: list[float]) -> list[float | None]:
    """Percentiles with linear interpolation between neighbours; nulls don't count, and without values all are None.

    Values are counted, dealt out by ranges, and a running count within the few ranges that hold a wanted rank
    finds it. The driver gets a count per range and the wanted values.
    """
    counted = rows.select(value.cast("double").alias("v")).where(F.col("v").isNotNull()).groupBy("v").agg(F.count("*").alias("n"))
    counted = materialise(counted.repartitionByRange("v").withColumn("part", F.spark_partition_id()), "percentiles")
    starts, total = {}, 0
    for part, n, _ in sorted(counted.groupBy("part").agg(F.sum("n"), F.min("v")).collect(), key=lambda r: r[2]):
        starts[part] = (total, total + n)
        total += n
    if not total:
        return [None] * len(shares)
    places = [share * (total - 1) for share in shares]
    ranks = sorted({r for p in places for r in (math.floor(p), math.ceil(p))})
    home = {r: next(part for part, (a, z) in starts.items() if a <= r < z) for r in ranks}
    before = F.sum("n").over(Window.partitionBy("part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    wanted = F.array(*[F.struct(F.lit(r).cast("long").alias("rank"), F.lit(part).alias("part"), F.lit(r - starts[part][0]).cast("long").alias("local")) for r, part in home.items()])
    here = counted.where(F.col("part").isin(*set(home.values()))).withColumn("before", before)
    hits = F.filter(wanted, lambda w: (w["part"] == F.col("part")) & (w["local"] >= F.col("before")) & (w["local"] < F.col("before") + F.col("n")))
    found = dict(here.select(F.explode(hits).alias("w"), "v").select("w.rank", "v").collect())
    drop_materialised(counted)
    return [found[math.floor(p)] + (found[math.ceil(p)] - found[math.floor(p)]) * (p - math.floor(p)) for p in places]


def percentiles_by(rows: DataFrame, by: list[str], value: Column, shares: list[float], names: list[str]) -> DataFrame:
    """(by..., names...): percentiles of every group, with linear interpolation; nulls don't count, and a group of nulls has null percentiles.

    The counted values of all groups are dealt out by ranges of (group, value). A range's part of a group starts after the group's
    values in the ranges before it, so running counts are only ever taken within a part: a group that holds all rows
    is worked on by all tasks, and no task buffers its values.
    """
    groups = [f"_g{k}" for k in range(len(by))]
    values = rows.select(*[F.col(c).alias(g) for c, g in zip(by, groups)], value.cast("double").alias("v"))
    counted = values.groupBy(*groups, "v").agg(F.count("v").alias("n"))
    counted = materialise(counted.repartitionByRange(*groups, "v").withColumn("part", F.spark_partition_id()), "percentiles")
    # One row for each group and range that holds some of it.
    parts = counted.groupBy(*groups, "part").agg(F.sum("n").alias("size"))
    whole = Window.partitionBy(*groups)
    parts = parts.withColumn("start", F.sum("size").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).withColumn("total", F.sum("size").over(whole))
    parts = parts.select(*[F.col(g).alias(f"{g}_") for g in groups], F.col("part").alias("part_"), "start", "total")
    same = [F.col(g).eqNullSafe(F.col(f"{g}_")) for g in groups]
    running = F.sum("n").over(Window.partitionBy(*groups, "part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    placed = counted.withColumn("to", running).join(parts, [*same, F.col("part") == F.col("part_")])
    placed = placed.withColumn("to", F.col("to") + F.col("start")).withColumn("from", F.col("to") - F.col("n"))
    held = lambda rank: F.max(F.when((rank >= F.col("from")) & (rank < F.col("to")), F.col("v")))
    ends = []
    for k, share in enumerate(shares):
        place = F.lit(share) * (F.col("total") - 1)
        ends += [held(F.floor(place)).alias(f"low{k}"), held(F.ceil(place)).alias(f"high{k}"), F.max(place - F.floor(place)).alias(f"rest{k}")]
    found = placed.groupBy(*groups).agg(*ends)
    between = [(F.col(f"low{k}") + (F.col(f"high{k}") - F.col(f"low{k}")) * F.col(f"rest{k}")).alias(n) for k, n in enumerate(names)]
    return found.select(*[F.col(g).alias(c) for g, c in zip(groups, by)], *between)
