"""Group-aware stratified splits and per-class samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .numbering import dense_numbers


def seeded_order(key: Column, seed: int) -> Column:
    """A pseudo-random order of keys that depends on the seed alone; the same in any SQL engine."""
    return F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed))))


def seeded_number(*key: Column, seed: int) -> Column:
    """A number of 60 bits that depends on the key and the seed alone; the same in any SQL engine."""
    digest = F.md5(F.concat_ws(":", *[k.cast("string") for k in key], F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def dominant_class(records: DataFrame) -> DataFrame:
    """(grp, class): the most frequent class of each group, on ties the one seen first (ordinal)."""
    counted = records.groupBy("grp", "class").agg(F.count("*").alias("n"), F.min("ordinal").alias("first"))
    best = F.max_by("class", F.struct(F.col("n"), -F.col("first")))
    return counted.groupBy("grp").agg(best.alias("class"))


def split_sizes(groups: Column, val: float, test: float) -> tuple[Column, Column]:
    """(groups for test, groups for validation) of a class with that many groups."""
    n_test, n_val = (F.bround(groups * share, 0).cast("long") for share in (test, val))
    enough = groups >= 10
    n_test = F.when(enough, F.greatest(F.lit(1), n_test)).otherwise(n_test)
    n_val = F.when(enough, F.greatest(F.lit(1), n_val)).otherwise(n_val)
    n_test = F.least(n_test, F.greatest(F.lit(0), groups - 2))
    n_val = F.least(n_val, F.greatest(F.lit(0), groups - n_test - 1))
    return n_test, n_val


def ranks(rows: DataFrame, order: Column, key: str, column: str = "rank") -> DataFrame:
    """Rows with their place, from 1, within their class in a seeded order, without a task that holds a class.

    ``order`` is a hash as hex digits, so its first three cut a class into 4096 even runs: a run is ranked by itself,
    and starts after the sizes of the runs before it.
    """
    cut = rows.withColumn("_run", F.substring(order, 1, 3))
    within = F.row_number().over(Window.partitionBy("class", "_run").orderBy(order, key))
    sizes = cut.groupBy("class", "_run").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("class").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.withColumn("_start", F.coalesce(before, F.lit(0))).select(F.col("class").alias("_class"), F.col("_run").alias("_of"), "_start")
    placed = cut.withColumn("_in", within).join(starts, F.col("class").eqNullSafe(F.col("_class")) & (F.col("_run") == F.col("_of")))
    return placed.withColumn(column, F.col("_start") + F.col("_in")).drop("_run", "_in", "_class", "_of", "_start")


def group_split(records: DataFrame, val: float = 0.15, test: float = 0.10, seed: int = 42) -> DataFrame:
    """(grp, class, split): groups of each dominant class in a seeded order, first test, then val, then train."""
    dominant = dominant_class(records)
    sizes = dominant.groupBy(F.col("class").alias("_of")).agg(F.count("*").alias("n"))
    sized = ranks(dominant, seeded_order(F.col("grp"), seed), "grp", "r").join(sizes, F.col("class").eqNullSafe(F.col("_of")))
    n_test, n_val = split_sizes(F.col("n"), val, test)
    split = F.when(F.col("r") <= n_test, "test").when(F.col("r") <= n_test + n_val, "val").otherwise("train")
    return sized.select("grp", "class", split.alias("split"))


def assign(records: DataFrame, splits: DataFrame) -> DataFrame:
    """Records with their group's split; ``train`` where a group has none."""
    return records.join(splits.select("grp", "split"), "grp", "left").withColumn("split", F.coalesce("split", F.lit("train")))


def sample_per_class(records: DataFrame, k: int, seed: int, key: str = "id") -> DataFrame:
    """The first ``k`` records of each class in a seeded order, chosen within even runs of a class first."""
    order = seeded_order(F.col(key), seed)
    some = records.withColumn("_run", F.substring(order, 1, 2))
    for keys in (["class", "_run"], ["class"]):
        some = some.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(order, key))).where(F.col("rank") <= k)
    return some.drop("_run")


def representative_set(records: DataFrame, n: int, n_classes: int, seed: int = 0, key: str = "id") -> DataFrame:
    """About ``n`` records, equally many of each class, shuffled and capped at ``n``."""
    few = sample_per_class(records, max(1, n // n_classes), seed, key)
    return few.orderBy(seeded_order(F.col(key), seed + 1), key).limit(n)


def evaluation_subset(records: DataFrame, most: int = 400, seed: int = 0, key: str = "id") -> DataFrame:
    """At most ``most`` records, drawn without replacement."""
    return records.orderBy(seeded_order(F.col(key), seed), key).limit(most)


def epoch_order(records: DataFrame, epoch: int, key: str = "id") -> DataFrame:
    """Records in the order of an epoch: a global shuffle that needs no buffer."""
    return records.orderBy(seeded_order(F.col(key), epoch), key)


def running_numbers(rows: DataFrame, number: str, by: str, column: str, run: int = 1 << 16) -> DataFrame:
    """Rows with ``column``: their place, from 0, within their value of ``by``, in the order of a column of distinct numbers.

    Numbers are cut into runs of equal reach; a run's part of a value is counted through by itself, and starts after the parts before it.
    """
    cut = rows.withColumn("_run", F.floor(F.col(number) / run))
    within = F.row_number().over(Window.partitionBy(by, "_run").orderBy(number)) - 1
    sizes = cut.groupBy(F.col(by).alias("_by"), F.col("_run").alias("_of")).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_by").orderBy("_of").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")
    starts = sizes.withColumn("_start", before).drop("_n")
    placed = cut.withColumn("_in", within).join(starts, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_run") == F.col("_of")))
    return placed.withColumn(column, F.col("_start") + F.col("_in")).drop("_run", "_in", "_by", "_of", "_start")


def balanced_draws(records: DataFrame, draws: int, seed: int = 42) -> DataFrame:
    """``draws`` draws with replacement, all non-empty classes equally likely: (draw, class, rank, ...).

    A draw picks a class by its hash, then a place there, then the record of that place in the class's seeded order. Places step through
    a class, starting elsewhere with every pass, so a class is drawn from evenly. Both the draws and the records of a class
    are counted through in runs, so no task holds a class. Records without a class aren't drawn.
    """
    records = records.where(F.col("class").isNotNull())
    ranked = ranks(records, seeded_order(F.col("id"), seed), "id").withColumn("rank", F.col("rank") - 1)
    classes = dense_numbers(records.groupBy("class").agg(F.count("*").alias("size")), ["class"], "_k")
    n_classes = max(1, classes.count())
    drawn = records.sparkSession.range(draws).select(F.col("id").alias("draw"), (seeded_number(F.col("id"), seed=seed) % n_classes).alias("_k"))
    picked = running_numbers(drawn, "draw", "_k", "nth").join(classes, "_k")
    lap = F.floor(F.col("nth") / F.col("size"))
    place = (F.col("nth") + seeded_number(lap, seed=seed) % F.col("size")) % F.col("size")
    return picked.select("draw", "class", place.alias("rank")).join(ranked, ["class", "rank"])


def balanced_epoch_size(counts: DataFrame, batch: int) -> DataFrame:
    """Steps of an epoch that draws the mean class size from each non-empty class: (steps)."""
    kept = counts.where(F.col("n") > 0)
    total = F.floor(F.avg("n")) * F.count("*")
    return kept.agg(F.greatest(F.lit(1), F.floor(total / batch)).cast("long").alias("steps"))
