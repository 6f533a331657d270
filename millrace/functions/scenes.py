"""Scenes: a cut-out laid on a canvas. What is laid where follows from uniform numbers, so a plan can be made of columns
in the JVM or of a generator's draws, and the pixel kernel only blends.
"""

from __future__ import annotations

from functools import cache
from statistics import NormalDist
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from .rasters import as_bytes, gaussian_blur, resize_area, resize_bilinear

# Canvas shapes (width, height, weight).
CANVAS_ASPECTS = [(9.0, 19.5, 0.26), (9.0, 16.0, 0.20), (3.0, 4.0, 0.16), (1.0, 1.0, 0.12), (4.0, 3.0, 0.16), (16.0, 9.0, 0.10)]
#: Spread of the canvas size, its least side, and the deviation of a position as a share of the free room.
JITTER, LEAST_SIDE, DRIFT = 0.15, 64, 0.2
#: How much larger than needed a picture may be drawn as a ground.
ZOOM = 1.4
# Colours of made grounds (skin, wood, tiles, asphalt, cloth, walls, paper).
GROUND_COLOURS = [(206, 170, 140), (150, 110, 84), (120, 84, 56), (196, 196, 190), (96, 98, 102), (48, 50, 58), (176, 186, 168), (222, 214, 198)]
#: Uniform numbers that one plan takes.
DRAWS = 8


class Plan(NamedTuple):
    """A canvas in pixels, the cut-out's longer side as a share of the canvas's, and where its room is left, from 0 to 1."""

    width: int
    height: int
    share: float
    across: float
    down: float


def plan(u: np.ndarray, low: float = 0.28, high: float = 1.0, base: int = 640) -> Plan:
    """The plan of ``DRAWS`` uniform numbers; positions are normal around the middle."""
    weights = np.cumsum([w for *_, w in CANVAS_ASPECTS])
    wide, tall, _ = CANVAS_ASPECTS[min(int(np.searchsorted(weights, u[0] * weights[-1], side="right")), len(weights) - 1)]
    longer = base * (1 - JITTER + 2 * JITTER * u[1])
    sides = [max(LEAST_SIDE, int(np.rint(longer * s / max(wide, tall)))) for s in (wide, tall)]
    z = np.sqrt(-2 * np.log(max(u[3], 1e-12))) * np.array([np.cos(2 * np.pi * u[4]), np.sin(2 * np.pi * u[4])])
    across, down = np.clip(0.5 + DRIFT * z, 0, 1)
    return Plan(*sides, float(low + (high - low) * u[2]), float(across), float(down))


def plan_columns(u: Column, low: float = 0.28, high: float = 1.0, base: int = 640) -> Column:
    """:func:`plan` as a struct, of an array of ``DRAWS`` uniform numbers."""
    total, shape = sum(w for *_, w in CANVAS_ASPECTS), None
    reached = 0.0
    for wide, tall, weight in CANVAS_ASPECTS[:-1]:
        reached += weight
        ratio = F.array(F.lit(wide / max(wide, tall)), F.lit(tall / max(wide, tall)))
        shape = F.when(u[0] * total < reached, ratio) if shape is None else shape.when(u[0] * total < reached, ratio)
    wide, tall, _ = CANVAS_ASPECTS[-1]
    shape = shape.otherwise(F.array(F.lit(wide / max(wide, tall)), F.lit(tall / max(wide, tall))))
    longer = base * (1 - JITTER + 2 * JITTER * u[1])
    side = lambda k: F.greatest(F.lit(LEAST_SIDE), F.bround(longer * shape[k], 0).cast("int"))
    radius = F.sqrt(-2 * F.log(F.greatest(u[3], F.lit(1e-12))))
    drift = lambda turn: F.least(F.greatest(0.5 + DRIFT * radius * turn(2 * np.pi * u[4]), F.lit(0.0)), F.lit(1.0))
    return F.struct(side(0).alias("width"), side(1).alias("height"), (low + (high - low) * u[2]).alias("share"), drift(F.cos).alias("across"), drift(F.sin).alias("down"))


def with_margins(image: np.ndarray, share: float = 0.42) -> tuple[np.ndarray, np.ndarray]:
    """An image on an empty ground with room to turn, and how much of each pixel it covers, from 0 to 1."""
    room = np.rint(share * np.array(image.shape[:2])).astype(int)
    ground = np.zeros((*(np.array(image.shape[:2]) + 2 * room), *image.shape[2:]), dtype=np.uint8)
    cover = np.zeros(ground.shape[:2], dtype=np.float32)
    place = tuple(slice(r, r + n) for r, n in zip(room, image.shape))
    ground[place], cover[place] = image, 1
    return ground, cover


def extent(cover: np.ndarray) -> tuple[slice, slice] | None:
    """The rows and columns between which something is covered, if anything is."""
    at = np.nonzero(cover > 0)
    return tuple(slice(int(a.min()), int(a.max()) + 1) for a in at) if len(at[0]) else None


def lay(image: np.ndarray, cover: np.ndarray, where: Plan, ground: np.ndarray, softness: float = 1.2) -> np.ndarray:
    """The covered part of an image on a ground of the planned size, with soft edges; the image itself if nothing is covered."""
    part = extent(cover)
    if part is None or min(s.stop - s.start for s in part) < 2:
        return image
    image, cover = image[part], cover[part]
    grow = where.share * max(where.width, where.height) / max(image.shape[:2])
    grow = min(grow, (where.width - 2) / image.shape[1], (where.height - 2) / image.shape[0])
    size = [max(4, int(n * grow)) for n in image.shape[:2]]
    drawn = (resize_area if grow < 1 else resize_bilinear)(image, *size)
    weight = resize_bilinear(cover, *size)
    weight = np.clip(gaussian_blur(weight, softness) if softness > 0 else weight, 0, 1)[..., None]
    top, left = int((where.height - size[0]) * where.down), int((where.width - size[1]) * where.across)
    # Outside the window the ground stays as it is.
    out = ground.copy() if ground.dtype == np.uint8 else as_bytes(ground)
    window = out[top : top + size[0], left : left + size[1]]
    window[:] = as_bytes(window + weight * (drawn - window))
    return out


def ground_from(picture: np.ndarray, where: Plan, u: np.ndarray) -> np.ndarray:
    """A window of a picture in the canvas's shape: its place by two uniform numbers, and by a third how much smaller it is than what would fit."""
    step = min(picture.shape[0] / where.height, picture.shape[1] / where.width) / (1 + (ZOOM - 1) * u[2])
    rows, columns = max(1, int(where.height * step)), max(1, int(where.width * step))
    top, left = int((picture.shape[0] - rows) * u[0]), int((picture.shape[1] - columns) * u[1])
    window = picture[top : top + rows, left : left + columns]
    return as_bytes((resize_area if rows >= where.height and columns >= where.width else resize_bilinear)(window, where.height, where.width))


@cache
def _normal_quantiles() -> np.ndarray:
    """The standard normal numbers that 16 random bits stand for."""
    return np.array([NormalDist().inv_cdf((k + 0.5) / 65536) for k in range(65536)], dtype=np.float32)


def grain(rng: np.random.Generator, shape: tuple[int, ...], deviation: float) -> np.ndarray:
    """Normal noise, a number for every entry, of 16 random bits each; bytes that it is rounded to don't tell it from one of more bits."""
    return (_normal_quantiles() * np.float32(deviation)).take(rng.integers(0, 65536, shape, dtype=np.uint16))


def _between(n: int, m: int) -> np.ndarray:
    """The weights by which ``resize_bilinear`` makes ``m`` cells of ``n``, as a matrix."""
    return resize_bilinear(np.eye(n), m, n).astype(np.float32)


def made_ground(where: Plan, rng: np.random.Generator) -> np.ndarray:
    """A ground for when there is no picture: one of a few colours in some light, brighter to one side, mottled, at times with joints of tiles or boards, and grainy."""
    h, w = where.height, where.width
    base, turn = rng.uniform(0.55, 1.25), rng.uniform(0, 2 * np.pi)
    down, across = (np.linspace(0, end, n) for end, n in ((np.sin(turn), h), (np.cos(turn), w)))
    # A slope's least and greatest value are those of its two sides.
    least, most = down.min() + across.min(), down.max() + across.max()
    strength = rng.uniform(0.15, 0.55) / max(1e-6, most - least)
    light = np.add.outer((1 + strength * (down - least) - strength * (most - least) / 2).astype(np.float32), (strength * across).astype(np.float32))
    light *= np.float32(base)
    cells = int(rng.integers(3, 12))
    mottle = _between(cells, h) @ rng.uniform(-1, 1, (cells, cells)).astype(np.float32) @ _between(cells, w).T
    mottle *= np.float32(rng.uniform(0.08, 0.30) / max(1e-6, mottle.max(), -mottle.min()))
    mottle += np.float32(1)
    light *= mottle
    if rng.random() < 0.30:
        upright, short = bool(rng.integers(2)), min(h, w)
        pitch = int(rng.integers(max(12, short // 8), max(20, short // 2)))
        joint = (np.arange(w if upright else h) + rng.integers(pitch)) % pitch < rng.integers(1, 4)
        light[(slice(None), joint) if upright else joint] *= np.float32(rng.uniform(0.55, 0.88))
    colour = np.array(GROUND_COLOURS[int(rng.integers(len(GROUND_COLOURS)))], dtype=np.float32)
    out = np.repeat(light, 3, axis=1)
    out *= np.tile(colour, w)
    out += grain(rng, out.shape, rng.uniform(1.5, 7.0))
    return as_bytes(out).reshape(h, w, 3)


class Framer:
    """Lays images on scenes; ``pool`` holds pictures that serve as grounds."""

    def __init__(self, pool: list[np.ndarray] | None = None, low: float = 0.28, high: float = 1.0, base: int = 640, margin: float = 0.42):
        self.pool, self.low, self.high, self.base, self.margin = pool or [], low, high, base, margin

    def compose(self, image: np.ndarray, cover: np.ndarray, rng: np.random.Generator, low: float | None = None, high: float | None = None) -> np.ndarray:
        u = rng.random(DRAWS)
        where = plan(u, self.low if low is None else low, self.high if high is None else high, self.base)
        ground = ground_from(self.pool[int(rng.integers(len(self.pool)))], where, u[5:]) if self.pool else made_ground(where, rng)
        return lay(image, cover, where, ground)
