"""Selective prediction: temperature, confidence and entropy thresholds, risk against coverage."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scores import entropy, nll, softmax
from .metrics import accuracy, calibration_error, with_predictions
from .quantiles import exact_percentiles

#: Bounds between which a temperature is sought.
LOW, HIGH = 0.05, 10.0


def temperature_nlls(logits: DataFrame, temperatures: list[float]) -> DataFrame:
    """(temperature, nll): the mean over all rows for each temperature, in one pass."""
    grid = F.explode(F.array(*map(F.lit, temperatures))).alias("temperature")
    return logits.select("logits", "label", grid).groupBy("temperature").agg(F.avg(nll(softmax(F.col("logits"), F.col("temperature")), F.col("label"))).alias("nll"))


def fit_temperature(logits: DataFrame, low: float = LOW, high: float = HIGH, points: int = 16, rounds: int = 6) -> float:
    """The temperature of least mean NLL: a grid, then finer grids around its best point.

    Each round is one distributed pass that returns ``points`` rows, where a bisection would take one
    pass for each point.
    """
    best = 1.0
    for _ in range(rounds):
        step = (high - low) / (points - 1)
        rows = temperature_nlls(logits, [low + i * step for i in range(points)]).collect()
        if not rows or rows[0]["nll"] is None:
            return 1.0
        best = min(rows, key=lambda r: (r["nll"], r["temperature"]))["temperature"]
        low, high = max(LOW, best - step), min(HIGH, best + step)
    return best


def threshold_grid() -> list[float]:
    """36 thresholds from 0.20 to 0.90 and 60 from 0.90 to 0.999, both ends included, so 0.90 comes twice."""
    return [0.20 + i * 0.70 / 35 for i in range(35)] + [0.90] + [0.90 + i * 0.099 / 59 for i in range(60)]


def sweep(predicted: DataFrame, thresholds: list[float] | None = None) -> DataFrame:
    """(threshold, coverage, selective_accuracy, n_accepted, n_wrong_accepted), accepting conf >= threshold.

    One pass puts each row under the largest threshold it meets and counts; running sums over the grid,
    which is all that is left by then, give the rest. Nothing accepted counts as accuracy 1.
    """
    grid = sorted(set(thresholds or threshold_grid()))
    # A row's place is the number of thresholds it meets.
    met = F.size(F.filter(F.array(*map(F.lit, grid)), lambda t: F.col("conf") >= t))
    counted = predicted.groupBy(met.alias("met")).agg(F.count("*").alias("n"), F.sum((~F.col("correct")).cast("long")).alias("wrong"))
    rows = predicted.sparkSession.createDataFrame([(i + 1, t) for i, t in enumerate(grid)], "place int, threshold double")
    reached = rows.join(F.broadcast(counted), F.col("met") >= F.col("place"), "left").groupBy("threshold").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_accepted"), F.coalesce(F.sum("wrong"), F.lit(0)).alias("n_wrong_accepted")
    )
    whole = predicted.agg(F.count("*").alias("total"))
    accepted, wrong = F.col("n_accepted"), F.col("n_wrong_accepted")
    return reached.crossJoin(F.broadcast(whole)).select(
        "threshold", F.coalesce(F.try_divide(accepted, F.col("total")), F.lit(0.0)).alias("coverage"),
        F.when(accepted > 0, 1 - wrong / accepted).otherwise(1.0).alias("selective_accuracy"), "n_accepted", "n_wrong_accepted",
    )


def pick_threshold(swept: DataFrame, target: float = 0.995, least_coverage: float = 0.70) -> DataFrame:
    """The row to use: the least threshold with precision and coverage, else with precision, else the best."""
    precise = F.col("selective_accuracy") >= target
    tier = F.when(precise & (F.col("coverage") >= least_coverage), 1).when(precise, 2).otherwise(3)
    order = F.when(F.col("tier") < 3, F.col("threshold"))
    return swept.withColumn("tier", tier).orderBy("tier", order.asc_nulls_last(), F.desc("selective_accuracy"), F.desc("coverage"), "threshold").limit(1)


def entropy_threshold(predicted: DataFrame, confidence: float, target: float = 0.995, n_classes: int = 7, steps: int = 40) -> DataFrame:
    """(entropy_threshold): the tightest of the accepted entropies' upper quantiles before precision fails.

    From the loosest quantile down, as long as the target holds; the widest possible entropy if it fails
    at once or nothing is accepted.
    """
    widest = math.log(n_classes)
    accepted = predicted.where(F.col("conf") >= confidence).select(entropy(F.col("probs")).alias("ent"), "correct")
    shares = [0.5 + 0.5 * i / (steps - 1) for i in range(steps)]
    found = exact_percentiles(accepted, F.col("ent"), shares)
    grid = predicted.sparkSession.createDataFrame([(i, q) for i, q in enumerate(found) if q is not None], "place int, threshold double")
    # Rows under their first quantile, then running sums over the few quantiles.
    placed = accepted.crossJoin(F.broadcast(grid.agg(F.collect_list("threshold").alias("qs")))).select(F.size(F.filter("qs", lambda t: F.col("ent") > t)).alias("first"), "correct")
    counted = placed.groupBy("first").agg(F.count("*").alias("n"), F.sum(F.col("correct").cast("long")).alias("hits"))
    tried = grid.join(F.broadcast(counted), F.col("first") <= F.col("place")).groupBy("place", "threshold").agg((F.sum("hits") / F.sum("n")).alias("accuracy"))
    down = Window.orderBy(F.desc("threshold"), F.desc("place")).rowsBetween(Window.unboundedPreceding, 0)
    passing = tried.withColumn("ok", F.min((F.col("accuracy") >= target).cast("int")).over(down)).where(F.col("ok") == 1)
    return passing.agg(F.coalesce(F.min("threshold"), F.lit(widest)).alias("entropy_threshold"))


def accepted_rows(predicted: DataFrame, confidence: float, entropy_limit: float) -> DataFrame:
    return predicted.where((F.col("conf") >= confidence) & (entropy(F.col("probs")) <= entropy_limit))


def residual_errors(accepted: DataFrame, most: int = 8) -> DataFrame:
    """(label, pred, n) of accepted but wrong rows, most frequent first."""
    wrong = accepted.where(~F.col("correct")).groupBy("label", "pred").agg(F.count("*").alias("n"))
    return wrong.orderBy(F.desc("n"), "label", "pred").limit(most)


def risk_coverage(raw: DataFrame, calibrated: DataFrame) -> DataFrame:
    """Both curves in one table: (curve, threshold, coverage, risk)."""
    line = lambda df, name: sweep(df).select(F.lit(name).alias("curve"), "threshold", "coverage", (1 - F.col("selective_accuracy")).alias("risk"))
    return line(raw, "raw").unionByName(line(calibrated, "calibrated"))


def before_after(logits: DataFrame, temperature: float) -> DataFrame:
    """(stage, accuracy, ece) with and without the temperature; the accuracy can't differ."""
    def one(name: str, t: float) -> DataFrame:
        p = with_predictions(logits.withColumn("probs", softmax(F.col("logits"), t)))
        return accuracy(p).select(F.lit(name).alias("stage"), "accuracy").crossJoin(calibration_error(p))

    return one("before", 1.0).unionByName(one("after", temperature))


def calibrate(logits: DataFrame, target: float = 0.995, least_coverage: float = 0.70, n_classes: int = 7) -> DataFrame:
    """The whole calibration of rows (split, label, logits) as one row of nested values.

    The temperature comes from split val; both thresholds come from split test.
    """
    temperature = fit_temperature(logits.where(F.col("split") == "val"))
    test = with_predictions(logits.where(F.col("split") == "test").withColumn("probs", softmax(F.col("logits"), temperature)))
    picked = pick_threshold(sweep(test), target, least_coverage).first()
    limit = entropy_threshold(test, picked["threshold"], target, n_classes).first()[0]
    taken = accepted_rows(test, picked["threshold"], limit)
    errors = residual_errors(taken).agg(F.collect_list(F.struct("label", "pred", "n")).alias("residual_errors"))
    measured = taken.agg(F.count("*").alias("n_accepted"), F.avg(F.col("correct").cast("double")).alias("selective_accuracy"))
    return measured.crossJoin(test.agg(F.count("*").alias("n"))).crossJoin(errors).select(
        F.lit(temperature).alias("temperature"), F.lit(picked["threshold"]).alias("confidence_threshold"), F.lit(limit).alias("entropy_threshold"),
        F.lit(math.log(n_classes)).alias("max_entropy"), F.lit(target).alias("target_precision"),
        F.struct((F.col("n_accepted") / F.col("n")).alias("coverage"), F.coalesce("selective_accuracy", F.lit(1.0)).alias("selective_accuracy"), "n_accepted").alias("measured"), "residual_errors",
    )
