"""Streams of crops. The batch operators have no streaming counterpart to match; this is an extension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators.dedup import greedy_dedup, leaked


def exact_dedup(crops: DataFrame, event_time: str = "ts", delay: str = "10 minutes") -> DataFrame:
    """A stream of crops (h, ts, ...) without repeated hashes; state is dropped behind the watermark."""
    return crops.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["h"])


def class_counts(crops: DataFrame, event_time: str = "ts", delay: str = "10 minutes", window: str = "5 minutes") -> DataFrame:
    """Crops per window and class; a window comes out when the watermark has passed it."""
    return crops.withWatermark(event_time, delay).groupBy(F.window(event_time, window), "class").agg(F.count("*").alias("n"))


def near_dedup(crops: DataFrame, path: str, most: int = 4) -> DataStreamWriter:
    """Writes the crops (ordinal, h) of a stream that stay when each is dropped if it is near one that stays already.

    A batch is held against what earlier batches left, by equal bands, and then against itself in order, so the table
    at ``path`` is what :func:`greedy_dedup` keeps of all crops, as long as ordinals rise from batch to batch. Each batch has a folder
    of its own, which a batch that runs again writes over.
    """
    schema = "ordinal long, h long, batch long"

    def add(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        items = batch.select("ordinal", "h")
        if number:
            kept = spark.read.schema(schema).option("ignoreMissingFiles", "true").parquet(path).where(F.col("batch") < number)
            near = leaked(items.withColumnRenamed("ordinal", "id"), kept.withColumnRenamed("ordinal", "id"), most)
            items = items.join(near.withColumnRenamed("id", "ordinal"), "ordinal", "left_anti")
        stays = items.join(greedy_dedup(items, most), "ordinal", "left_semi")
        stays.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return crops.writeStream.foreachBatch(add).outputMode("append")
