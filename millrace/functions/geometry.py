"""Geometry of crops, as column expressions. All rounding is half to even."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def adaptive_padding(width_px: Column, height_px: Column, base: float = 0.06, least_px: int = 6) -> tuple[Column, Column]:
    """Relative padding of both sides: more for small boxes, and at least ``least_px`` pixels."""
    short = F.greatest(F.lit(1.0), F.least(width_px, height_px))
    scale = F.least(F.greatest(F.lit(300.0) / short, F.lit(1.0)), F.lit(2.5))
    one = lambda side: F.greatest(F.lit(base) * scale, F.lit(float(least_px)) / F.greatest(side, F.lit(1.0)))
    return one(width_px), one(height_px)


def crop_rectangle(x0: Column, y0: Column, x1: Column, y1: Column, width: Column, height: Column, base: float = 0.06) -> Column:
    """Struct (x1, y1, x2, y2) in pixels of a relative box with its padding, or null if it is empty."""
    pad_w, pad_h = adaptive_padding((x1 - x0) * width, (y1 - y0) * height, base)
    pw, ph = (x1 - x0) * pad_w, (y1 - y0) * pad_h
    whole = lambda v: F.bround(v, 0).cast("int")
    left, top = F.greatest(F.lit(0), whole((x0 - pw) * width)), F.greatest(F.lit(0), whole((y0 - ph) * height))
    right, bottom = F.least(width.cast("int"), whole((x1 + pw) * width)), F.least(height.cast("int"), whole((y1 + ph) * height))
    return F.when((right > left) & (bottom > top), F.struct(left.alias("x1"), top.alias("y1"), right.alias("x2"), bottom.alias("y2")))


def capped_size(width: Column, height: Column, most: int = 640) -> Column:
    """Struct (w, h) after the longer side is cut down to ``most``."""
    longer = F.greatest(width, height)
    fit = lambda side: F.when(longer <= most, side).otherwise(F.bround(side * (F.lit(float(most)) / longer), 0)).cast("int")
    return F.struct(fit(width).alias("w"), fit(height).alias("h"))


def aspect(width: Column, height: Column) -> Column:
    """Longer over shorter side."""
    return F.greatest(width, height) / F.greatest(F.lit(1), F.least(width, height))
