"""Image, label and class-map sources, and the sinks of a curated set. Only Spark touches the paths."""

from __future__ import annotations

import io
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.labels import CLASSES, DEFAULT_CLASS_IDS
from ..operators.numbering import dense_numbers

# File name endings of images, in lower case.
IMAGE_ENDINGS = ("jpg", "jpeg", "png", "bmp", "webp")


def with_stem(files: DataFrame, column: str = "path") -> DataFrame:
    """Add ``stem`` and ``ending`` (lower case) of a path column."""
    name = F.regexp_extract(column, r"([^/]+)$", 1)
    return files.withColumn("stem", F.regexp_replace(name, r"\.[^.]*$", "")).withColumn("ending", F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1)))


def list_images(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """(path, stem, ending, length) of the images in a folder, without reading them; sort by path where order matters."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(folder if recursive else f"{folder}/*.*")
    return with_stem(files.select("path", "length")).where(F.col("ending").isin(*IMAGE_ENDINGS))


def read_images(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """(path, stem, width, height, n_channels, data) with pixels in blue-green-red order; height -1 if unreadable."""
    images = spark.read.format("image").option("recursiveFileLookup", str(recursive).lower()).load(folder)
    named = with_stem(images.select(F.col("image.origin").alias("path"), "image.width", "image.height", F.col("image.nChannels").alias("n_channels"), "image.data"))
    return named.where(F.col("ending").isin(*IMAGE_ENDINGS)).drop("ending")


def to_raster(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """A raster in red-green-blue order from what :func:`read_images` gives."""
    raster = np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels)
    return raster[..., 2::-1] if channels >= 3 else raster[..., 0]


def read_backgrounds(spark: SparkSession, folder: str, most: int = 400, side: int = 720) -> DataFrame:
    """(slot, height, width, pixels): the first ``most`` readable pictures of a folder by path, none with a side over ``side``.

    A picture for every slot; a row draws its slot by its key, see :func:`with_background`.
    """
    from ..functions.rasters import as_bytes, resize_area

    found = read_images(spark, folder, recursive=True).where(F.col("height") > 0)
    first = found.select("path").orderBy("path").limit(most).withColumn("slot", F.row_number().over(Window.orderBy("path")) - 1)

    def shrink(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for slot, h, w, c, data in zip(batch["slot"], batch["height"], batch["width"], batch["n_channels"], batch["data"]):
                image, f = to_raster(data, int(h), int(w), int(c)), side / max(h, w)
                image = as_bytes(resize_area(image, max(1, int(h * f)), max(1, int(w * f)))) if f < 1 else image
                image = np.repeat(image[..., None], 3, axis=2) if image.ndim == 2 else image
                rows.append((slot, image.shape[0], image.shape[1], np.ascontiguousarray(image).tobytes()))
            yield pd.DataFrame(rows, columns=["slot", "height", "width", "pixels"])

    return found.join(F.broadcast(first), "path").select("slot", "height", "width", "n_channels", "data").mapInPandas(shrink, "slot int, height int, width int, pixels binary")


def with_background(rows: DataFrame, backgrounds: DataFrame, number: Column) -> DataFrame:
    """Rows with the ``background`` (height, width, pixels) that a number of theirs draws; null where there is none."""
    slots = backgrounds.count()
    picked = F.when(F.lit(slots > 0), F.pmod(number, F.lit(max(1, slots))).cast("int"))
    packed = backgrounds.select(F.col("slot").alias("_slot"), F.struct("height", "width", "pixels").alias("background"))
    return rows.withColumn("_drawn", picked).join(packed, F.col("_drawn") == F.col("_slot"), "left").drop("_drawn", "_slot")


def read_label_lines(spark: SparkSession, folder: str) -> DataFrame:
    """(stem, line_no, line) of all text files in a folder."""
    whole = spark.read.text(f"{folder}/*.txt", wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    lines = with_stem(whole).select("stem", F.posexplode(F.split("value", r"\r?\n")).alias("line_no", "line"))
    return lines.where(F.trim("line") != "")


def read_detection_set(spark: SparkSession, root: str, dataset: str, splits: list[str]) -> tuple[DataFrame, DataFrame]:
    """(images, label lines) of the given splits of a set with images/ and labels/ folders."""
    images, labels = [], []
    for split in splits:
        tag = lambda df: df.withColumn("dataset", F.lit(dataset)).withColumn("split", F.lit(split))  # noqa: E731, B023
        images.append(tag(read_images(spark, f"{root}/{split}/images")))
        labels.append(tag(read_label_lines(spark, f"{root}/{split}/labels")))
    joined = lambda parts: parts[0] if len(parts) == 1 else parts[0].unionByName(joined(parts[1:]))
    return joined(images), joined(labels)


def read_class_folders(spark: SparkSession, root: str) -> DataFrame:
    """Images of ``<root>/<class>/**``; each file is its own group."""
    images = read_images(spark, root, recursive=True)
    return images.withColumn("class", F.regexp_extract("path", rf"{re.escape(root.rstrip('/').rsplit('/', 1)[-1])}/([^/]+)/", 1)).withColumn("grp", F.concat_ws("::", F.lit("extra"), F.lit("manual"), "stem"))


def read_splits(spark: SparkSession, root: str, split: str) -> DataFrame:
    """(path, class, label) of ``<root>/<split>/<class>/*`` for the known classes, labels in class order."""
    files = list_images(spark, f"{root}/{split}", recursive=True)
    named = files.withColumn("class", F.regexp_extract("path", rf"/{re.escape(split)}/([^/]+)/[^/]+$", 1))
    return named.join(F.broadcast(class_dimension(spark).select("class", F.col("idx").alias("label"))), "class").select("path", "class", "label")


def paths_by_class(split: DataFrame) -> DataFrame:
    """(class, place, path): the paths of each class in order, as numbered rows, so that no row holds a class."""
    return dense_numbers(split.select("class", "path"), ["path"], "place", by=["class"]).select("class", "place", "path")


def class_dimension(spark: SparkSession) -> DataFrame:
    """(idx, class, spoken, aspect) in label order."""
    return spark.createDataFrame([(i, *row) for i, row in enumerate(CLASSES)], "idx int, class string, spoken string, aspect double")


def parse_class_names(text: str) -> dict[int, str]:
    """The ``names`` of a data set's YAML description: a list or a mapping, inline or over lines; the default if none.

    Reads the forms such files use and not YAML at large.
    """
    clean = lambda s: s.strip().strip("'\"")
    found = re.search(r"(?m)^names[ \t]*:[ \t]*(.*)$", text or "")
    if not found:
        return dict(DEFAULT_CLASS_IDS)
    inline, names = found[1].split("#")[0].strip(), {}
    if inline.startswith("["):
        whole = text[found.start(1) :]
        names = dict(enumerate(clean(x) for x in whole[1 : whole.index("]")].split(",") if clean(x)))
    elif inline.startswith("{"):
        whole = text[found.start(1) :]
        pairs = (x.split(":", 1) for x in whole[1 : whole.index("}")].split(",") if ":" in x)
        names = {int(clean(k)): clean(v) for k, v in pairs if clean(k).isdigit()}
    else:
        for line in text[found.end() :].splitlines():
            if not line.strip():
                continue
            item, pair = re.match(r"\s*-\s+(.*)$", line), re.match(r"\s+['\"]?(\d+)['\"]?\s*:\s*(.*)$", line)
            if item:
                names[len(names)] = clean(item[1])
            elif pair:
                names[int(pair[1])] = clean(pair[2])
            else:
                break
    return names or dict(DEFAULT_CLASS_IDS)


def class_maps(spark: SparkSession, files: dict[str, str]) -> DataFrame:
    """(dataset, cls, name) of data sets, given the path of each one's description."""
    rows = []
    for dataset, path in files.items():
        lines = spark.read.text(path, wholetext=True).collect() if path else []
        rows += [(dataset, k, v) for k, v in parse_class_names(lines[0][0] if lines else "").items()]
    return spark.createDataFrame(rows, "dataset string, cls int, name string")


def discover_sets(spark: SparkSession, pattern: str) -> list[str]:
    """Folders that match a pattern, sorted; looked up by Spark's file system, so any store works."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(path) or []
    return sorted(s.getPath().toString() for s in found if s.isDirectory())


def read_logits(spark: SparkSession, path: str) -> DataFrame:
    """(split, id, label, logits) as written by :func:`write_table`."""
    return spark.read.schema("split string, id long, label int, logits array<double>").parquet(path)


def logits_from_npz(spark: SparkSession, path: str) -> DataFrame:
    """The same from archives with logits, labels, val_logits and val_labels; a task reads each archive, the driver none."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                archive = np.load(io.BytesIO(bytes(content)))
                for split, prefix in (("test", ""), ("val", "val_")):
                    values, labels = archive[f"{prefix}logits"].astype(np.float64), archive[f"{prefix}labels"]
                    yield pd.DataFrame({"split": split, "id": np.arange(len(labels)), "label": labels.astype(np.int32), "logits": list(values)})

    found = spark.read.format("binaryFile").load(path).select("content")
    return found.mapInPandas(unpack, "split string, id long, label int, logits array<double>")


def read_manifest(spark: SparkSession, path: str, array: bool = False) -> DataFrame:
    """A manifest from one object per line, or from files that hold an array each."""
    fields = "file string, class string, split string, `group` string, origin string, source string, h int, w int"
    return spark.read.schema(fields).json(path, multiLine=array)


def write_table(df: DataFrame, path: str, by: tuple[str, ...] = ()) -> None:
    """Parquet, in folders by some columns, which later reads can skip."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    """One object per line; :func:`read_manifest` reads it."""
    df.write.mode("overwrite").json(path)


def write_crops(records: DataFrame, path: str) -> None:
    """Manifest rows with their pixels (data), in folders by split and class."""
    write_table(records, path, ("split", "class"))
