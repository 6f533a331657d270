"""Registered queries of the image sources and pixel stages, over images that Spark draws from the embeddings, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rasters, scenes, stages
from ..functions.labels import CLASSES
from ..operators import augment
from ..operators.splitting import seeded_number
from ..sources import folders, images
from .bindings import table
from .queries import fresh_path, query, sql_number

#: Grays of an embedding: multiples of 8, so that no weighted mean of them lies half way between two bytes.
SQL_BYTES = "list_transform(embedding, lambda v: (least(greatest(floor((v::DOUBLE + 1) * 16), 0), 31) * 8)::INT)"


def grays() -> Column:
    return F.transform("embedding", lambda v: (F.least(F.greatest(F.floor((v.cast("double") + 1) * 16), F.lit(0)), F.lit(31)) * 8).cast("int"))


def packed(values: Column) -> Column:
    """Numbers from 0 to 255 as bytes."""
    return F.unhex(F.array_join(F.transform(values, lambda p: F.lpad(F.hex(p), 2, "0")), ""))


def drawn(spark: SparkSession, d: str, height: int, width: int, channels: int) -> DataFrame:
    """(path, height, width, n_channels, data): an image of each embedding's first entries."""
    size = height * width * channels
    rows = table(spark, d, "embeddings").select(F.col("vec_id").cast("string").alias("path"), packed(F.slice(grays(), 1, size)).alias("data"))
    return rows.select("path", F.lit(height).alias("height"), F.lit(width).alias("width"), F.lit(channels).alias("n_channels"), "data")


def unchanged(image, rng):
    return image


def five_digits(rows: DataFrame) -> DataFrame:
    return rows.select("path", F.transform("pixels", lambda v: F.round(v.cast("double"), 5)).alias("pixels"))


@query(f"""WITH g AS (SELECT vec_id::VARCHAR AS path, {SQL_BYTES} AS g FROM embeddings)
SELECT path, list_transform(range(64), lambda i: CASE WHEN i % 8 BETWEEN 2 AND 5 THEN round(g[4 * (i // 8) + i % 8 - 1] / 127.5::DOUBLE - 1, 5) ELSE -1.0 END) AS pixels FROM g""")
def letterbox_normalised(spark: SparkSession, d: str) -> DataFrame:
    """Narrow images in the middle of a square, as numbers from -1 to 1."""
    return five_digits(augment.transform_images(drawn(spark, d, 8, 4, 1), unchanged, size=8))


@query(f"""WITH g AS (SELECT vec_id::VARCHAR AS path, {SQL_BYTES} AS g FROM embeddings)
SELECT path, list_transform(range(75), lambda i: CASE WHEN i >= 60 THEN -1.0 ELSE round(round_even(0.299::DOUBLE * g[3 * (i // 3) + 3] + 0.587::DOUBLE * g[3 * (i // 3) + 2] + 0.114::DOUBLE * g[3 * (i // 3) + 1], 0) / 127.5::DOUBLE - 1, 5) END) AS pixels FROM g""")
def gray_stress(spark: SparkSession, d: str) -> DataFrame:
    """Colour images without their colour, which are stored blue first."""
    return five_digits(augment.transform_images(drawn(spark, d, 4, 5, 3), lambda image, rng: rasters.gray_stress(image), size=5))


def picky(image, rng):
    """Fails for images whose first pixel is an odd multiple of 8."""
    if image.flat[0] % 16:
        raise ValueError("odd")
    return image[::-1]


@query(f"""WITH g AS (SELECT {SQL_BYTES} AS g FROM embeddings)
SELECT count(*) AS n, count(*) FILTER (g[1] % 16 > 0) AS failed, round(count(*) FILTER (g[1] % 16 > 0) / count(*), 6) AS ratio, count(*) FILTER (g[1] % 16 > 0) / count(*) >= 0.02 AS warn FROM g""")
def stage_failures(spark: SparkSession, d: str) -> DataFrame:
    """Images that a stage fails for go on as they were, and are counted."""
    return augment.failure_ratio(augment.transform_images(drawn(spark, d, 8, 8, 1), picky, size=8)).withColumn("ratio", F.round("ratio", 6))


STAGES = {
    "one_stage": lambda image, rng: stages.one_stage_augment(image, rng, "heavy", 24),
    "two_stages": lambda image, rng: stages.scene_augment(image, rng, "medium", framer=scenes.Framer(base=160)),
    "scene_evaluation": lambda image, rng: stages.scene_evaluation(image),
    "hard_degrade": stages.hard_stress,
    "light_fallback": lambda image, rng: stages.quick_augment(image, rng, 24),
}


@query("SELECT vec_id::VARCHAR AS path, stage, 1728 AS n, true AS inside, true AS worked FROM embeddings CROSS JOIN (VALUES ('one_stage'), ('two_stages'), ('scene_evaluation'), ('hard_degrade'), ('light_fallback')) s(stage)")
def augmented_images(spark: SparkSession, d: str) -> DataFrame:
    """Every image through every augmentation: whole squares of numbers from -1 to 1, and no failure."""
    # The rows are small and their work is large, so they are dealt out to all cores, however few files they lie in.
    n = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = drawn(spark, d, 4, 5, 3).repartition(n, "path")
    inside = F.forall("pixels", lambda v: (v >= -1) & (v <= 1))
    parts = [augment.transform_images(rows, kernel, size=24).select("path", F.lit(name).alias("stage"), F.size("pixels").alias("n"), inside.alias("inside"), F.col("error").isNull().alias("worked")) for name, kernel in STAGES.items()]
    done = parts[0]
    for part in parts[1:]:
        done = done.unionByName(part)
    return done


def files(spark: SparkSession, d: str, name: Column, split: Column, label: Column, layout: str) -> str:
    """The path of a folder with an 8 x 8 JPEG for each embedding."""
    path = fresh_path(spark, layout)
    rows = table(spark, d, "embeddings").select(name.alias("file"), split.cast("string").alias("split"), label.cast("string").alias("class"), F.lit(8).alias("height"), F.lit(8).alias("width"), packed(grays()).alias("pixels"))
    folders.write_jpeg_files(rows, path)
    return path


ENDINGS = ["jpg", "JPEG", "Png", "bmp", "gif", "txt", "webp"]


@query(f"""WITH f AS (SELECT vec_id % 2 = 0 AS top, list_element({ENDINGS!r}, vec_id % {len(ENDINGS)} + 1) AS e FROM embeddings), k AS (SELECT top, lower(e) AS ending FROM f WHERE lower(e) IN ('jpg', 'jpeg', 'png', 'bmp', 'webp'))
SELECT 'flat' AS listing, ending, count(*) AS n FROM k WHERE top GROUP BY ending UNION ALL SELECT 'recursive', ending, count(*) FROM k GROUP BY ending""")
def image_listing(spark: SparkSession, d: str) -> DataFrame:
    """Images of a folder, and of it with the folders below, by ending."""
    ending = F.array(*map(F.lit, ENDINGS))[(F.col("vec_id") % len(ENDINGS)).cast("int")]
    path = files(spark, d, F.concat(F.lit("f"), F.col("vec_id"), F.lit("."), ending), F.when(F.col("vec_id") % 2 > 0, "below"), F.lit(None), "listing")
    flat, deep = images.list_images(spark, path), images.list_images(spark, path, recursive=True)
    return flat.withColumn("listing", F.lit("flat")).unionByName(deep.withColumn("listing", F.lit("recursive"))).groupBy("listing", "ending").agg(F.count("*").alias("n"))


@query("SELECT 'c' || label AS class, 'extra::manual::f' || vec_id AS grp, 'f' || vec_id AS stem, 8 AS height, 8 AS width FROM embeddings")
def class_folders(spark: SparkSession, d: str) -> DataFrame:
    """Images in folders by class, each a group of its own."""
    path = files(spark, d, F.concat(F.lit("f"), F.col("vec_id"), F.lit(".jpg")), F.lit(None), F.concat(F.lit("c"), F.col("label")), "extra")
    return images.read_class_folders(spark, path).select("class", "grp", "stem", "height", "width")


NAMES = [c for c, *_ in CLASSES] + ["other"]


@query(f"""WITH f AS (SELECT 'f' || vec_id || '.jpg' AS file, list_element({NAMES!r}, label % {len(NAMES)} + 1) AS class, label % {len(NAMES)} AS label FROM embeddings WHERE vec_id % 3 = 0)
SELECT class, label::INT AS label, count(*) AS n, min(file) AS first, max(file) AS last FROM f WHERE class <> 'other' GROUP BY ALL""")
def split_listing(spark: SparkSession, d: str) -> DataFrame:
    """The files of one split with their labels in class order, and how many there are of each; folders of unknown classes don't count."""
    named = F.array(*map(F.lit, NAMES))[(F.col("label") % len(NAMES)).cast("int")]
    path = files(spark, d, F.concat(F.lit("f"), F.col("vec_id"), F.lit(".jpg")), F.when(F.col("vec_id") % 3 == 0, "train").otherwise("val"), named, "splits")
    found = images.read_splits(spark, path, "train").withColumn("file", F.regexp_extract("path", r"([^/]+)$", 1))
    return found.groupBy("class", "label").agg(F.count("*").alias("n"), F.min("file").alias("first"), F.max("file").alias("last"))


@query(f"""WITH f AS (SELECT 'f' || vec_id || '.jpg' AS file, list_element({NAMES!r}, label % {len(NAMES)} + 1) AS class FROM embeddings WHERE vec_id % 2 = 0)
SELECT class, row_number() OVER (PARTITION BY class ORDER BY file) - 1 AS place, file FROM f WHERE class <> 'other'""")
def paths_by_class(spark: SparkSession, d: str) -> DataFrame:
    """The paths of each class of a split, in order."""
    named = F.array(*map(F.lit, NAMES))[(F.col("label") % len(NAMES)).cast("int")]
    path = files(spark, d, F.concat(F.lit("f"), F.col("vec_id"), F.lit(".jpg")), F.when(F.col("vec_id") % 2 == 0, "train").otherwise("val"), named, "splits")
    found = images.paths_by_class(images.read_splits(spark, path, "train"))
    return found.select("class", "place", F.regexp_extract("path", r"([^/]+)$", 1).alias("file"))


@query(f"""WITH s AS (SELECT row_number() OVER () - 1 AS slot FROM embeddings ORDER BY slot LIMIT 40),
g AS (SELECT {sql_number('vec_id', seed=5)} % 40 AS slot FROM embeddings)
SELECT slot::INT AS slot, 6 AS height, 6 AS width, (SELECT count(*) FROM g WHERE g.slot = s.slot) AS draws FROM s""")
def background_pool(spark: SparkSession, d: str) -> DataFrame:
    """The first pictures of a folder, shrunk, and how often each is drawn as a background."""
    path = files(spark, d, F.concat(F.lit("f"), F.col("vec_id"), F.lit(".jpg")), F.lit(None), F.concat(F.lit("c"), F.col("label")), "pool")
    pool = images.read_backgrounds(spark, path, most=40, side=6)
    met = images.with_background(table(spark, d, "embeddings").select("vec_id"), pool.withColumn("pixels", F.lit(None).cast("binary")), seeded_number(F.col("vec_id"), seed=5))
    drawn_slots = met.select(F.pmod(seeded_number(F.col("vec_id"), seed=5), F.lit(40)).cast("int").alias("slot")).groupBy("slot").agg(F.count("*").alias("draws"))
    return pool.select("slot", "height", "width").join(drawn_slots, "slot", "left").select("slot", "height", "width", F.coalesce("draws", F.lit(0)).alias("draws"))
