"""Classifier scores as column expressions over arrays of doubles."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)


def softmax(logits: Column, temperature: Column | float = 1.0) -> Column:
    """Probabilities; the largest logit is subtracted first."""
    t = temperature if isinstance(temperature, Column) else F.lit(float(temperature))
    powers = F.transform(logits, lambda v: F.exp((v - F.array_max(logits)) / t))
    return F.transform(powers, lambda p: p / total(powers))


def argmax(values: Column) -> Column:
    """Position of the largest value, the first one on ties."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def entropy(probabilities: Column, eps: float = 1e-12) -> Column:
    return -total(F.transform(probabilities, lambda p: p * F.ln(p + eps)))


def nll(probabilities: Column, label: Column) -> Column:
    return -F.ln(F.get(probabilities, label) + 1e-12)


def one_hot(label: Column, n: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: (i == label).cast("double"))


def warmup_cosine(step: Column, peak: float, total_steps: int, warmup_steps: int, least: float = 1e-7) -> Column:
    """Learning rate of a step: linear rise, then half a cosine down to ``least``."""
    warm, all_ = float(max(1, warmup_steps)), float(max(1, total_steps))
    progress = F.least(F.greatest((step - warm) / max(all_ - warm, 1.0), F.lit(0.0)), F.lit(1.0))
    cosine = least + 0.5 * (peak - least) * (1 + F.cos(math.pi * progress))
    return F.when(step < warm, peak * (step / warm)).otherwise(cosine)


def quantize(x: Column, scale: float, zero: int) -> Column:
    return F.bround(x / scale + zero, 0).cast("int")


def dequantize(q: Column, scale: float, zero: int) -> Column:
    return (q - zero) * scale
