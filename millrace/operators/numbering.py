"""Consecutive numbers in an order, for tables of any size: no task sorts more than a range of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..durable import materialise

#: Fixed value: the bits below the partition number in Spark's increasing ids.
PLACE_BITS = 33


def dense_numbers(rows: DataFrame, order: list[Column | str], column: str = "number", by: list[str] | None = None) -> DataFrame:
    """Rows with ``column``: their place, from 0, in the given order, within each value of ``by`` if that is given.

    One range shuffle deals the rows out, each task sorts its range, and the written rows keep their place in it; a
    range starts after the ranges before it, or its part of a group after the group's parts there. Of those there is one row each, so a
    group that holds all rows is numbered by all tasks. Rows that are equal in the whole order get different numbers. ``order``
    should tell rows apart, since equal ones share a range. Nulls come first; they are a value of ``by`` like any other.
    """
    by = by or []
    keys = [F.col(c) if isinstance(c, str) else c for c in [*by, *order]]
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_place", F.monotonically_increasing_id())
    placed = materialise(placed, "numbered").withColumn("_range", F.shiftright("_place", PLACE_BITS))
    groups = [f"_by{k}" for k in range(len(by))]
    parts = placed.groupBy(F.col("_range").alias("_part"), *[F.col(c).alias(g) for c, g in zip(by, groups)]).agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
    # A window over as many rows as there are ranges, for each group.
    before = F.sum("_n").over(Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")
    parts = parts.withColumn("_start", before).drop("_n")
    same = [F.col("_range") == F.col("_part"), *(F.col(c).eqNullSafe(F.col(g)) for c, g in zip(by, groups))]
    return placed.join(parts, same).select(*rows.columns, (F.col("_start") + F.col("_place") - F.col("_first")).alias(column))
