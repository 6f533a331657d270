"""Audits of a curated set: every check gives rows (check, severity, metric, value, threshold, message)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import leaked
from .quantiles import exact_percentiles, percentiles_by
from .sizes import broadcast_if_small
from .splitting import sample_per_class


def finding(check: str, severity: Column, metric: Column, value: Column, threshold: float, message: str) -> list[Column]:
    return [
        F.lit(check).alias("check"), severity.alias("severity"), metric.cast("string").alias("metric"), value.cast("double").alias("value"),
        F.lit(float(threshold)).alias("threshold"), F.lit(message).alias("message"),
    ]


def class_split_counts(records: DataFrame) -> DataFrame:
    """(class, train, val, test, total) with one row per class."""
    wide = records.groupBy("class").pivot("split", ["train", "val", "test"]).agg(F.count(F.lit(1)))
    parts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("train", "val", "test")]
    return wide.select("class", *parts).withColumn("total", F.col("train") + F.col("val") + F.col("test"))


def counts_with_margins(records: DataFrame, one: str, two: str) -> DataFrame:
    """Counts of every pair, every value and all; a null marks a margin."""
    return records.cube(one, two).agg(F.count("*").alias("n")).where(~((F.grouping_id() == 0) & (F.col(one).isNull() | F.col(two).isNull())))


def imbalance(records: DataFrame) -> DataFrame:
    """(largest, smallest, ratio) of the non-empty classes."""
    n = records.groupBy("class").agg(F.count("*").alias("n"))
    return n.agg(F.max("n").alias("largest"), F.min("n").alias("smallest"), (F.max("n") / F.min("n")).alias("ratio"))


def check_structure(records: DataFrame, classes: list[str]) -> DataFrame:
    """An error for every (split, class) without a record."""
    spark = records.sparkSession
    wanted = spark.createDataFrame([(s, c) for s in ("train", "val", "test") for c in classes], "split string, class string")
    counted = records.groupBy("split", "class").agg(F.count("*").alias("n"))
    missing = wanted.join(broadcast_if_small(counted), ["split", "class"], "left_anti")
    return missing.select(*finding("structure", F.lit("error"), F.concat_ws("/", "split", "class"), F.lit(0), 1, "no records"))


def check_balance(records: DataFrame, most_ratio: float = 8.0, least_train: int = 150, least_eval: int = 25) -> DataFrame:
    """Warnings: imbalance over ``most_ratio`` in train, too few records of a class in a split."""
    ratio = imbalance(records.where(F.col("split") == "train")).where(F.col("ratio") > most_ratio)
    uneven = ratio.select(*finding("imbalance", F.lit("warning"), F.lit("train"), F.col("ratio"), most_ratio, "classes are uneven"))
    n = records.groupBy("split", "class").agg(F.count("*").alias("n"))
    needed = F.when(F.col("split") == "train", least_train).otherwise(least_eval)
    few = n.where(F.col("n") < needed).select(*finding("minimum", F.lit("warning"), F.concat_ws("/", "split", "class"), F.col("n"), 0, "few records"))
    return uneven.unionByName(few)


def split_groups(records: DataFrame) -> DataFrame:
    """(grp, splits) of groups that are in more than one split."""
    return records.groupBy("grp").agg(F.sort_array(F.collect_set("split")).alias("splits")).where(F.size("splits") > 1)


def check_groups(records: DataFrame) -> DataFrame:
    found = split_groups(records).agg(F.count("*").alias("n")).where(F.col("n") > 0)
    return found.select(*finding("group_leakage", F.lit("error"), F.lit("groups"), F.col("n"), 0, "groups in more than one split"))


def leak_percentage(records: DataFrame, most: int = 4, per_class: int | None = 60, seed: int = 1234) -> DataFrame:
    """(evaluated, leaked, percent): evaluation records within ``most`` bits of a training record.

    ``per_class`` bounds the records of each class that are compared; None compares all.
    """
    train, evaluation = records.where(F.col("split") == "train"), records.where(F.col("split") != "train")
    if per_class:
        train, evaluation = sample_per_class(train, per_class, seed), sample_per_class(evaluation, per_class, seed)
    hits = leaked(evaluation, train, most).agg(F.count("*").alias("leaked"))
    both = evaluation.agg(F.count("*").alias("evaluated")).crossJoin(hits)
    return both.withColumn("percent", F.coalesce(F.try_divide(100.0 * F.col("leaked"), F.col("evaluated")), F.lit(0.0)))


def check_leakage(records: DataFrame, most: int = 4, per_class: int | None = 60) -> DataFrame:
    p = F.col("percent")
    severity = F.when(p > 10, "error").when(p > 3, "warning")
    return leak_percentage(records, most, per_class).where(severity.isNotNull()).select(*finding("perceptual_leakage", severity, F.lit("percent"), p, 3, "evaluation resembles training"))


def distribution(records: DataFrame, column: str) -> DataFrame:
    """(p10, p50, p90, std): exact percentiles by linear interpolation and the population deviation."""
    found = exact_percentiles(records, F.col(column), [0.1, 0.5, 0.9])
    return records.agg(*[F.lit(q).cast("double").alias(name) for q, name in zip(found, ("p10", "p50", "p90"))], F.stddev_pop(column).alias("std"))


def check_brightness(records: DataFrame, least_std: float = 22.0) -> DataFrame:
    low = distribution(records, "brightness").where(F.col("std") < least_std)
    return low.select(*finding("image_stats", F.lit("warning"), F.lit("brightness_std"), F.col("std"), least_std, "brightness hardly varies"))


def median_aspect(records: DataFrame) -> DataFrame:
    """(class, median) of the sides' ratio of records (class, w, h); a class of any size is ranked by ranges."""
    ratio = F.greatest("w", "h") / F.greatest(F.lit(1), F.least("w", "h"))
    return percentiles_by(records, ["class"], ratio, [0.5], ["median"])


def check_aspect(records: DataFrame, ideals: DataFrame, most: float = 0.45) -> DataFrame:
    """Warnings for classes whose median ratio is off the ideal (class, aspect)."""
    off = median_aspect(records).join(broadcast_if_small(ideals), "class").withColumn("off", F.abs(F.col("median") - F.col("aspect"))).where(F.col("off") > most)
    return off.select(*finding("aspect", F.lit("warning"), F.col("class"), F.col("off"), most, "median ratio is off the class's"))


def verdict(findings: DataFrame, strict: bool = False) -> DataFrame:
    """(errors, warnings, passed)."""
    count = lambda s: F.coalesce(F.sum((F.col("severity") == s).cast("long")), F.lit(0))
    fatal = count("error") + (count("warning") if strict else F.lit(0))
    return findings.agg(count("error").alias("errors"), count("warning").alias("warnings"), (fatal == 0).alias("passed"))


def audit(records: DataFrame, classes: list[str], per_class: int | None = 60, ideals: DataFrame | None = None) -> DataFrame:
    """All findings. Errors of structure end the audit, as later checks presume it.

    Leakage needs a column h64, brightness one of that name, and aspect the sides w and h and ``ideals`` (class,
    aspect); :func:`verdict` says whether the findings let a set pass, strictly or not.
    """
    structure = check_structure(records, classes)
    if structure.limit(1).count():
        return structure
    checks = [check_balance(records), check_groups(records)]
    columns = set(records.columns)
    if "h64" in columns:
        checks.append(check_leakage(records.drop("h").withColumnRenamed("h64", "h"), per_class=per_class))
    if "brightness" in columns:
        checks.append(check_brightness(records))
    if ideals is not None and {"w", "h"} <= columns:
        checks.append(check_aspect(records, ideals))
    for check in checks:
        structure = structure.unionByName(check)
    return structure
