"""Augmentation and batch mixing over DataFrames: pixel kernels in Arrow batches, label mixes in expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rasters, scenes
from ..sources.images import to_raster
from .splitting import seeded_number, seeded_order

FEATURES_SCHEMA = "path string, h long, blur double, brightness double"


#: Pixels that are worked on as one stack.
STACK_PIXELS = 1 << 22


def image_features(images: DataFrame) -> DataFrame:
    """(path, h, blur, brightness) of rows of images; unreadable ones give nulls.

    Images of one size in an Arrow batch are one stack, and each kernel is a few matrix products over it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.stack([pc.fill_null(batch.column(c), 0).to_numpy() for c in ("height", "width", "n_channels")], axis=1)
            found, features = np.full(len(sizes), False), np.zeros((len(sizes), 2))
            hashes = np.zeros(len(sizes), dtype=np.int64)
            data = batch.column("data")
            for h, w, c in np.unique(sizes[(sizes > 0).all(axis=1)], axis=0).tolist():
                rows = np.flatnonzero((sizes == (h, w, c)).all(axis=1))
                for some in np.array_split(rows, -(-len(rows) * h * w // STACK_PIXELS)):
                    stack = np.frombuffer(b"".join(data.take(pa.array(some)).to_pylist()), dtype=np.uint8).reshape(len(some), h, w, c)
                    gray = rasters.grays(stack[..., 2::-1] if c >= 3 else stack[..., 0])
                    found[some], hashes[some] = True, rasters.perceptual_hashes(gray)
                    features[some] = np.stack([rasters.blur_scores(gray), gray.mean(axis=(1, 2))], axis=1)
            columns = [pa.array(x, mask=~found) for x in (hashes, features[:, 0], features[:, 1])]
            yield pa.RecordBatch.from_arrays([batch.column("path"), *columns], names=["path", "h", "blur", "brightness"])

    return images.select("path", "height", "width", "n_channels", "data").mapInArrow(run, FEATURES_SCHEMA)


def scene_plans(rows: DataFrame, key: Column, slots: int = 0, seed: int = 0, low: float = 0.28, high: float = 1.0, base: int = 640) -> DataFrame:
    """Rows with ``u``, the uniform numbers of their scene, ``plan``, what is laid where, and ``slot``, the background that is drawn, null if there is none.

    All of it follows from the key and the seed, by expressions alone.
    """
    u = F.array(*[uniform(key, F.lit(k), seed=seed) for k in range(scenes.DRAWS)])
    slot = F.pmod(seeded_number(key, F.lit("ground"), seed=seed), F.lit(max(1, slots))).cast("int") if slots else F.lit(None).cast("int")
    planned = rows.withColumn("u", u)
    return planned.withColumn("plan", scenes.plan_columns(F.col("u"), low, high, base)).withColumn("slot", slot)


def compose_scenes(images: DataFrame, backgrounds: DataFrame, seed: int = 0, low: float = 0.28, high: float = 1.0, base: int = 640, per_group: int = 32) -> DataFrame:
    """(path, width, height, pixels, error): each image (path, height, width, n_channels, data) on the scene that its path draws.

    Scenes are planned first. Images that draw the same background (slot, height, width, pixels) then meet it in groups of about ``per_group``,
    so a background travels once for a group and not once for an image, and no group grows with the data. Without
    backgrounds, or where one is missing, the ground is made. An image that can't be read or laid gives null pixels and the error.
    """
    slots = backgrounds.count()
    planned = scene_plans(images, F.col("path"), slots, seed, low, high, base)
    parts = max(1, -(-images.count() // (per_group * max(1, slots))))
    part = F.pmod(F.xxhash64(F.lit("part"), F.col("path")), F.lit(parts)).cast("int")
    planned = planned.select("path", F.col("height").alias("h"), F.col("width").alias("w"), "n_channels", "data", "u", "plan", F.coalesce("slot", F.lit(-1)).alias("slot"), part.alias("part"))
    grounds = backgrounds.select("slot", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.col("height").alias("gh"), F.col("width").alias("gw"), "pixels")

    def lay(key: tuple, rows: pd.DataFrame, ground: pd.DataFrame) -> pd.DataFrame:
        picture = None if ground.empty else np.frombuffer(ground["pixels"][0], dtype=np.uint8).reshape(int(ground["gh"][0]), int(ground["gw"][0]), 3)
        out = []
        for path, h, w, c, data, u, where in zip(*(rows[n] for n in ("path", "h", "w", "n_channels", "data", "u", "plan"))):
            try:
                if data is None or not h > 0:
                    raise ValueError("unreadable")
                image, place = to_raster(data, int(h), int(w), int(c)), scenes.Plan(**where)
                image = image if image.ndim == 3 else np.repeat(image[..., None], 3, axis=2)
                own = scenes.made_ground(place, rasters.generator(path, seed)) if picture is None else scenes.ground_from(picture, place, np.array(u[5:]))
                done = scenes.lay(*scenes.with_margins(image), place, own)
                out.append((path, done.shape[1], done.shape[0], np.ascontiguousarray(done).tobytes(), None))
            except Exception as e:  # noqa: BLE001
                out.append((path, None, None, None, f"{type(e).__name__}: {e}"))
        done = pd.DataFrame(out, columns=["path", "width", "height", "pixels", "error"])
        return done.assign(width=done["width"].astype("Int32"), height=done["height"].astype("Int32"))

    both = planned.groupBy("slot", "part").cogroup(grounds.groupBy("slot", "part"))
    return both.applyInPandas(lay, "path string, width int, height int, pixels binary, error string").where("path IS NOT NULL OR error IS NOT NULL")


def transform_images(images: DataFrame, kernel: Callable[[np.ndarray, np.random.Generator], np.ndarray], seed: int = 0, size: int = 224) -> DataFrame:
    """(path, pixels, error): each image through ``kernel`` and a letterbox, as floats from -1 to 1.

    A row's random choices come from its path and the seed. If the kernel fails, the image goes on as it
    was and ``error`` says why, so failures can be counted after retries.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, h, w, c, data in zip(batch["path"], batch["height"], batch["width"], batch["n_channels"], batch["data"]):
                if h is None or h < 1 or w < 1:
                    rows.append((path, None, "unreadable"))
                    continue
                image, error = to_raster(data, int(h), int(w), int(c)), None
                try:
                    image = kernel(image.copy(), rasters.generator(path, seed))
                except Exception as e:  # noqa: BLE001
                    error = f"{type(e).__name__}: {e}"
                rows.append((path, rasters.normalize(rasters.letterbox(image, size)).ravel(), error))
            yield pd.DataFrame(rows, columns=["path", "pixels", "error"])

    return images.select("path", "height", "width", "n_channels", "data").mapInPandas(run, "path string, pixels array<float>, error string")


def failure_ratio(transformed: DataFrame, most: float = 0.02) -> DataFrame:
    """(n, failed, ratio, warn)."""
    failed = F.sum(F.col("error").isNotNull().cast("long"))
    return transformed.agg(F.count("*").alias("n"), F.coalesce(failed, F.lit(0)).alias("failed"), F.coalesce(F.try_divide(failed, F.count("*")), F.lit(0.0)).alias("ratio")).withColumn("warn", F.col("ratio") >= most)


def mix(a: Column, b: Column, share: Column) -> Column:
    """``share`` of array a and the rest of array b."""
    return F.zip_with(a, b, lambda x, y: x * share + y * (1 - share))


def uniform(*key: Column, seed: int) -> Column:
    """A number from 0 to 1 that depends on the key alone."""
    return (seeded_number(*key, seed=seed) % (1 << 30) + 0.5) / float(1 << 30)


def beta_quantiles(alpha: float, n: int = 1001) -> list[float]:
    """The quantiles 0, 1/(n-1), ..., 1 of the beta distribution with both parameters ``alpha``.

    In the log odds of its values the density is smooth whatever the parameter, so its sums are exact enough.
    """
    reach = 40 + 60 / min(1.0, alpha)
    t = np.linspace(-reach, reach, 200_001)
    density = np.exp(-alpha * (np.logaddexp(0, t) + np.logaddexp(0, -t)))
    mass = np.concatenate([[0], np.cumsum((density[1:] + density[:-1]) / 2)])
    at = np.interp(np.linspace(0, 1, n), mass / mass[-1], t)
    values = 1 / (1 + np.exp(-at))
    values[0], values[-1] = 0.0, 1.0
    return values.tolist()


def beta_draw(u: Column, alpha: float) -> Column:
    """The beta quantile of a uniform number, between tabulated ones by a straight line."""
    table = beta_quantiles(alpha)
    place = u * (len(table) - 1)
    values = F.transform(F.array(F.array(*map(F.lit, table))), lambda q: q[F.floor(place).cast("int")] + (q[F.floor(place).cast("int") + 1] - q[F.floor(place).cast("int")]) * (place - F.floor(place)))
    return values[0]


def partners(rows: DataFrame, seed: int = 0) -> DataFrame:
    """Each row beside the next one of its batch in a seeded order, the last beside the first."""
    order = Window.partitionBy("batch").orderBy(seeded_order(F.col("id"), seed), "id")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    other = F.coalesce(F.lead(F.struct("pixels", "target")).over(order), F.first(F.struct("pixels", "target")).over(whole))
    return rows.withColumn("other", other)


def mixup(rows: DataFrame, alpha: float = 0.2, seed: int = 0) -> DataFrame:
    """Rows (batch, id, pixels, target) mixed with a partner by a beta-distributed share, whose part is never the larger one."""
    drawn = beta_draw(uniform(F.col("id"), seed=seed), alpha)
    both = partners(rows, seed).withColumn("drawn", drawn).withColumn("share", F.greatest("drawn", 1 - F.col("drawn")))
    return both.select("batch", "id", mix(F.col("pixels"), F.col("other.pixels"), F.col("share")).alias("pixels"), mix(F.col("target"), F.col("other.target"), F.col("share")).alias("target"), "share")


def cut_box(height: int, width: int, share: Column, seed: int = 0) -> Column:
    """Struct (y1, y2, x1, x2) of a batch's box of about ``1 - share`` of the area, clipped to the image."""
    ratio = F.sqrt(1 - share)
    ends = []
    for k, side in enumerate((height, width)):
        centre = F.floor(uniform(F.col("batch"), F.lit(k), seed=seed) * side)
        half = F.floor(F.floor(side * ratio) / 2)
        ends += [F.greatest(F.lit(0), F.least(F.lit(side), centre - half)).cast("int"), F.greatest(F.lit(0), F.least(F.lit(side), centre + half)).cast("int")]
    return F.struct(*[e.alias(n) for e, n in zip(ends, ("y1", "y2", "x1", "x2"))])


def cutmix(rows: DataFrame, height: int, width: int, alpha: float = 1.0, seed: int = 0) -> DataFrame:
    """A box of the partner in each row, one box for a batch, whose area is a beta-distributed share; targets are mixed by the area it covers after clipping."""
    both = partners(rows, seed).withColumn("drawn", beta_draw(uniform(F.col("batch"), F.lit(9), seed=seed), alpha))
    both = both.withColumn("box", cut_box(height, width, F.greatest("drawn", 1 - F.col("drawn")), seed))
    share = 1 - (F.col("box.y2") - F.col("box.y1")) * (F.col("box.x2") - F.col("box.x1")) / float(height * width)
    y, x = lambda i: F.floor(i / width), lambda i: i % width
    inside = lambda i: (y(i) >= F.col("box.y1")) & (y(i) < F.col("box.y2")) & (x(i) >= F.col("box.x1")) & (x(i) < F.col("box.x2"))
    pixels = F.transform(F.col("pixels"), lambda v, i: F.when(inside(i), F.get(F.col("other.pixels"), i)).otherwise(v))
    return both.select("batch", "id", pixels.alias("pixels"), mix(F.col("target"), F.col("other.target"), share).alias("target"), share.alias("share"))


def mix_batches(rows: DataFrame, height: int, width: int, chance: float = 0.35, alpha: float = 0.2, cut_alpha: float = 1.0, seed: int = 0) -> DataFrame:
    """Batches as they are, or by chance mixed one way or the other, half and half."""
    u = uniform(F.col("batch"), F.lit(17), seed=seed)
    kind = F.when(u >= chance, "none").when(u < chance / 2, "mixup").otherwise("cutmix")
    tagged = rows.withColumn("kind", kind)
    part = lambda k: tagged.where(F.col("kind") == k).drop("kind")
    plain = part("none").select("batch", "id", "pixels", "target", F.lit(1.0).alias("share"))
    return plain.unionByName(mixup(part("mixup"), alpha, seed)).unionByName(cutmix(part("cutmix"), height, width, cut_alpha, seed))
