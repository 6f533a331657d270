"""From annotated images to a manifest: gates with a reason for every dropped row, numbering, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import capped_size, crop_rectangle
from ..functions.labels import normalize_class, parse_label_line
from .numbering import dense_numbers
from .sizes import broadcast_if_small

#: Gates: shorter side in pixels; sharpness of crops from detection sets and of given crops.
LEAST_SIDE, LEAST_BLUR, LEAST_BLUR_EXTRA = 48, 25.0, 3.0


def label_rows(images: DataFrame, labels: DataFrame, class_map: DataFrame) -> DataFrame:
    """One row per parsable label line of each image, and one for each image without a label file.

    images (dataset, split, stem, width, height; height -1 if unreadable), labels (dataset, split, stem,
    line_no, line), class_map (dataset, cls, name). Lines that can't be parsed give no row.
    """
    keys = ["dataset", "split", "stem"]
    parsed = labels.withColumn("box", parse_label_line(F.col("line"))).where(F.col("box").isNotNull()).select(*keys, "line_no", "box")
    has_file = labels.select(*keys).distinct().withColumn("has_label", F.lit(True))
    joined = images.join(has_file, keys, "left").join(parsed, keys, "left")
    # An image whose label file has no parsable line gives nothing; one without a file or unreadable is counted.
    unreadable, no_label = F.col("height") < 0, F.col("has_label").isNull()
    joined = joined.where(no_label | unreadable | F.col("box").isNotNull())
    named = joined.withColumn("cls", F.col("box.cls")).join(broadcast_if_small(class_map), ["dataset", "cls"], "left")
    per_image = F.row_number().over(Window.partitionBy(*keys).orderBy("line_no"))
    named = named.withColumn("_n", per_image).where(~(no_label | unreadable) | (F.col("_n") == 1)).drop("_n")
    rect = crop_rectangle(F.col("box.x0"), F.col("box.y0"), F.col("box.x1"), F.col("box.y1"), F.col("width"), F.col("height"))
    return named.withColumn("class", normalize_class(F.col("name"))).withColumn("rect", rect)


def reason(blur: Column | None = None, least_side: int = LEAST_SIDE, least_blur: float = LEAST_BLUR, extra: bool = False) -> Column:
    """The first gate that a row of :func:`label_rows` fails, or null. A threshold of 0 or less disables the blur gate."""
    w, h = F.col("rect.x2") - F.col("rect.x1"), F.col("rect.y2") - F.col("rect.y1")
    found = (
        F.when(F.col("has_label").isNull(), "no_label")
        .when(F.col("height") < 0, "unreadable")
        .when(F.col("class").isNull(), "unknown_class")
        .when(F.col("rect").isNull() | (F.least(w, h) < least_side), "too_small")
    )
    if blur is not None and least_blur > 0:
        found = found.when(blur < least_blur, "too_blurry_extra" if extra else "too_blurry")
    return found


def ordered(rows: DataFrame) -> DataFrame:
    """Add the global ordinal that order-dependent steps follow: data set, split, path, line.

    Rows are dealt out by ranges of that order, so no task sorts everything, nor all rows of one split.
    """
    return dense_numbers(rows, ["dataset", "split", "stem", "line_no"], "ordinal")


def tag_duplicates(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """Set ``reason`` to duplicate for rows without one whose ordinal isn't among the kept ones, else to kept."""
    stays = kept.select("ordinal", F.lit(True).alias("_kept"))
    return rows.join(stays, "ordinal", "left").withColumn("reason", F.coalesce("reason", F.when(F.col("_kept"), "kept").otherwise("duplicate"))).drop("_kept")


def reason_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("reason").agg(F.count("*").alias("n"))


def numbered(records: DataFrame) -> DataFrame:
    """Add ``file``: class, split and a running number within both, in the order of ordinals; a class of any size is numbered by ranges."""
    numbers = dense_numbers(records, ["ordinal"], "_nth", by=["class", "split"])
    return numbers.withColumn("file", F.format_string("%s_%s_%05d.jpg", F.col("class"), F.col("split"), F.col("_nth"))).drop("_nth")


def manifest(records: DataFrame, most_side: int = 640) -> DataFrame:
    """(file, class, split, group, origin, source, h, w) of kept records, sizes after the cap."""
    size = capped_size(F.col("w"), F.col("h"), most_side)
    return numbered(records).select("file", "class", "split", F.col("grp").alias("group"), "origin", "source", size["h"].alias("h"), size["w"].alias("w"))


def summary(records: DataFrame, counted: DataFrame) -> DataFrame:
    """One row: number of images and groups, counts by split, by class and split, and by reason."""
    by_split = records.groupBy("split").agg(F.count("*").alias("n")).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("split", "n")))).alias("split_counts"))
    inner = records.groupBy("class", "split").agg(F.count("*").alias("n")).groupBy("class").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("split", "n")))).alias("m"))
    by_class = inner.agg(F.map_from_entries(F.collect_list(F.struct("class", "m"))).alias("class_counts"))
    reasons = counted.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("reason", "n")))).alias("collection_stats"))
    whole = records.agg(F.count("*").alias("n_images"), F.count_distinct("grp").alias("n_groups"))
    return whole.crossJoin(by_split).crossJoin(by_class).crossJoin(reasons)
