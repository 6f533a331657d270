"""Evaluation of scored rows (label, probs): confusion, rates, calibration error, comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scores import argmax, nll


def with_predictions(scored: DataFrame) -> DataFrame:
    """Add pred, conf and correct."""
    return scored.withColumn("pred", argmax(F.col("probs"))).withColumn("conf", F.array_max("probs")).withColumn("correct", F.col("pred") == F.col("label"))


def ratio(above: Column, below: Column) -> Column:
    """A quotient that is 0 where nothing is below."""
    return F.coalesce(F.try_divide(above, below), F.lit(0.0))


def confusion_matrix(predicted: DataFrame, n: int = 7) -> DataFrame:
    """(label, pred, n) for all n x n cells."""
    classes = predicted.sparkSession.range(n).select(F.col("id").cast("int").alias("k"))
    cells = classes.select(F.col("k").alias("label")).crossJoin(classes.select(F.col("k").alias("pred")))
    counted = predicted.groupBy("label", "pred").agg(F.count("*").alias("n"))
    return cells.join(F.broadcast(counted), ["label", "pred"], "left").select("label", "pred", F.coalesce("n", F.lit(0)).alias("n"))


def class_report(predicted: DataFrame, n: int = 7) -> DataFrame:
    """Support, precision, recall and F1 of each class, from one pass over the rows."""
    cells = confusion_matrix(predicted, n)
    rows = cells.groupBy(F.col("label").alias("class")).agg(F.sum("n").alias("support"), F.sum(F.when(F.col("label") == F.col("pred"), F.col("n")).otherwise(0)).alias("hits"))
    columns = cells.groupBy(F.col("pred").alias("class")).agg(F.sum("n").alias("claimed"))
    both = rows.join(columns, "class").withColumn("precision", ratio(F.col("hits"), F.col("claimed"))).withColumn("recall", ratio(F.col("hits"), F.col("support")))
    f1 = ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return both.select("class", "support", "precision", "recall", f1.alias("f1"))


def accuracy(predicted: DataFrame) -> DataFrame:
    return predicted.agg(F.avg(F.col("correct").cast("double")).alias("accuracy"), F.count("*").alias("n"))


def confidence_bins(predicted: DataFrame, bins: int = 15) -> DataFrame:
    """(bin, n, confidence, accuracy) for bins that are open below and closed above; a confidence of 0 is in none."""
    placed = predicted.withColumn("bin", F.ceil(F.col("conf") * bins)).where(F.col("bin") >= 1)
    return placed.groupBy("bin").agg(F.count("*").alias("n"), F.avg("conf").alias("confidence"), F.avg(F.col("correct").cast("double")).alias("accuracy"))


def calibration_error(predicted: DataFrame, bins: int = 15) -> DataFrame:
    """Expected calibration error; all rows count in the denominator, also those in no bin."""
    by_bin = predicted.groupBy(F.ceil(F.col("conf") * bins).alias("bin")).agg(
        F.count("*").alias("n"), F.avg("conf").alias("confidence"), F.avg(F.col("correct").cast("double")).alias("accuracy")
    )
    gap = F.when(F.col("bin") >= 1, F.col("n") * F.abs(F.col("accuracy") - F.col("confidence"))).otherwise(0.0)
    return by_bin.agg(F.coalesce(F.try_divide(F.sum(gap), F.sum("n")), F.lit(0.0)).alias("ece"))


def reliability(predicted: DataFrame, bins: int = 15, least: int = 5) -> DataFrame:
    """The bins of a reliability diagram that hold at least ``least`` rows."""
    return confidence_bins(predicted, bins).where(F.col("n") >= least)


def mean_nll(scored: DataFrame) -> DataFrame:
    return scored.agg(F.avg(nll(F.col("probs"), F.col("label"))).alias("nll"))


def top_confusions(predicted: DataFrame, names: Column | None = None, most: int = 5) -> DataFrame:
    """The most frequent wrong cells: by count, then label and prediction as strings, all descending."""
    wrong = predicted.where(~F.col("correct")).groupBy(F.col("label").cast("string").alias("label"), F.col("pred").cast("string").alias("pred")).agg(F.count("*").alias("n"))
    return wrong.orderBy(F.desc("n"), F.desc("label"), F.desc("pred")).limit(most)


#: Falls of accuracy over which a stressed variant counts as large or moderate, by what is compared.
GAPS = {"stress": (0.15, 0.07), "framing": (0.20, 0.10)}


def robustness_gap(clean: DataFrame, stressed: DataFrame, kind: str = "stress") -> DataFrame:
    """Accuracy of both, and how far the second falls, by the cut-offs of a kind of stress."""
    large, moderate = GAPS[kind]
    one = accuracy(clean).select(F.col("accuracy").alias("clean"))
    two = accuracy(stressed).select(F.col("accuracy").alias("stressed"))
    gap = F.col("clean") - F.col("stressed")
    level = F.when(gap > large, "large").when(gap > moderate, "moderate").otherwise("small")
    return one.crossJoin(two).select("clean", "stressed", gap.alias("gap"), level.alias("level"))


def gray_level(predicted: DataFrame, n: int = 7, over_chance: float = 1.6, good: float = 0.55) -> DataFrame:
    """(accuracy, level) without colour: poor under 1.6 times chance, fair under 0.55, good from there."""
    a = F.col("accuracy")
    level = F.when(a < over_chance / n, "poor").when(a < good, "fair").otherwise("good")
    return accuracy(predicted).select("accuracy", level.alias("level"))


def variant_drop(base: DataFrame, other: DataFrame, n: int = 7, most_total: float = 0.02, most_class: float = 0.05) -> DataFrame:
    """One row: accuracy of two variants of a model, the fall, the class whose recall falls most, and whether either is too much."""
    one, two = accuracy(base).select(F.col("accuracy").alias("base")), accuracy(other).select(F.col("accuracy").alias("other"))
    worst = recall_drop(base, other, n).agg(F.min(F.struct("change", "class")).alias("w")).select(F.col("w.class").alias("worst_class"), F.col("w.change").alias("worst_change"))
    both = one.crossJoin(two).crossJoin(worst).withColumn("fall", F.col("base") - F.col("other"))
    return both.select("base", "other", "fall", "worst_class", "worst_change", (F.col("fall") > most_total).alias("total_worse"), (F.col("worst_change") < -most_class).alias("class_worse"))


def recall_drop(base: DataFrame, other: DataFrame, n: int = 7) -> DataFrame:
    """Recall by class of two variants of a model and the change; flags a drop of over 0.05."""
    one = class_report(base, n).select("class", F.col("recall").alias("base"))
    two = class_report(other, n).select("class", F.col("recall").alias("other"))
    return one.join(two, "class").withColumn("change", F.col("other") - F.col("base")).withColumn("worse", F.col("change") < -0.05)


# What a client must do to an image before it asks a model.
CONTRACT = {"resize": "letterbox, centred, filled with 0", "normalization": "x / 127.5 - 1", "channel_order": "RGB"}


def export_summary(sizes: DataFrame, predicted: DataFrame, classes: list[str], img_size: int = 224) -> DataFrame:
    """One row on the variants of a model: sizes (variant, size_mb), accuracy and recall by class of predictions (variant, label, pred, correct), the contract and the classes.

    A variant without predictions has no entry among the evaluations.
    """
    recalls = predicted.groupBy("variant", "label").agg(F.avg(F.col("correct").cast("double")).alias("recall")).groupBy("variant").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col("label").cast("string").alias("label"), "recall")))).alias("recall"))
    accuracies = predicted.groupBy("variant").agg(F.avg(F.col("correct").cast("double")).alias("accuracy"))
    evaluated = accuracies.join(recalls, "variant").agg(F.map_from_entries(F.collect_list(F.struct("variant", F.struct("accuracy", "recall")))).alias("evaluation"))
    sized = sizes.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("variant", "size_mb")))).alias("sizes_mb"))
    contract = F.create_map(*[F.lit(x) for pair in CONTRACT.items() for x in pair])
    return sized.crossJoin(evaluated).select("sizes_mb", "evaluation", F.lit(img_size).alias("img_size"), contract.alias("preprocessing_contract"), F.array(*map(F.lit, classes)).alias("classes"))
