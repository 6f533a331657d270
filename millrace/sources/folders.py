"""Folders of images as Spark data sources: a reader of the usual layouts and a writer of JPEG files.

Both go through Arrow's file systems, so a path is a local one or has a scheme that those know (file, hdfs, s3, gs, abfs).
The driver of a read lists folders and no files: each task lists a folder and takes the files whose
names fall to it. The tasks of a write put every file together aside and move it to its place, so a task that runs
again leaves one file per row, and the driver gets counts.
"""

from __future__ import annotations

import json
import posixpath
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import IntegerType, StructType

from ..functions.jpeg import encode_jpeg, image_size
from .images import IMAGE_ENDINGS

#: Bytes of file contents in one batch of a read.
BATCH_BYTES = 4 << 20
READ_SCHEMA = "dataset string, split string, class string, path string, stem string, ending string, length long, label string, content binary"
#: The folders of a layout below its root, by the column that each level names.
LAYOUTS = {"splits": ("split", "class"), "classes": ("class",), "detection": ("split",), "flat": ()}


def open_path(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, and the path there."""
    system, inner = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    return system, inner.rstrip("/")


def _folders(system: fs.FileSystem, path: str) -> list[str]:
    """Names of the folders in a folder, sorted; none if it doesn't exist."""
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted(f.base_name for f in found if f.type == fs.FileType.Directory and f.base_name[:1] not in "_.")


@dataclass
class FolderPart(InputPartition):
    """The files of a folder whose names fall to one of ``of`` tasks."""

    folder: str
    values: dict
    part: int
    of: int

    def __init__(self, folder: str, values: dict, part: int, of: int):
        super().__init__((folder, part))
        self.folder, self.values, self.part, self.of = folder, values, part, of


class FolderReader(DataSourceReader):
    """Reads one layout; folders of splits and classes that aren't asked for are never listed.

    They are named by options and not taken from a query's filters: a session keeps what a filter has chosen for all later
    queries on the same table, which would then miss rows.
    """

    def __init__(self, options: dict):
        self.options = {k.lower(): v for k, v in options.items()}
        self.layout = self.options.get("layout", "splits")
        if self.layout not in LAYOUTS:
            raise ValueError(f"no such layout: {self.layout}")
        self.wanted = {c: set(json.loads(self.options[c])) for c in ("split", "class") if c in self.options}
        self.contents = self.options.get("contents", "true").lower() == "true"
        self.shards = max(1, int(self.options.get("shards", "4")))

    def _chosen(self, column: str, names: list[str]) -> list[str]:
        return [n for n in names if column not in self.wanted or n in self.wanted[column]]

    def partitions(self) -> list[FolderPart]:
        root = self.options["path"]
        system, inner = open_path(root)
        dataset = self.options.get("dataset") or posixpath.basename(inner)
        level = [(inner, {"dataset": dataset})]
        for column in LAYOUTS[self.layout]:
            level = [(f"{folder}/{name}", values | {column: name}) for folder, values in level for name in self._chosen(column, _folders(system, folder))]
        if self.layout == "detection":
            # A split counts if it has both images and labels.
            level = [(folder, values) for folder, values in level if {"images", "labels"} <= set(_folders(system, folder))]
        parts = [FolderPart(folder, values, k, self.shards) for folder, values in level for k in range(self.shards)]
        return parts or [FolderPart("", {}, 0, 1)]

    def read(self, partition: FolderPart) -> Iterator[pa.RecordBatch]:
        if not partition.folder:
            return
        system, _ = open_path(self.options["path"])
        images = f"{partition.folder}/images" if self.layout == "detection" else partition.folder
        # Class folders are read with all folders below them.
        found = system.get_file_info(fs.FileSelector(images, allow_not_found=True, recursive=self.layout == "classes"))
        rows, held = [], 0
        names = [c.split()[0] for c in READ_SCHEMA.split(", ")]
        kinds = [pa.string()] * 6 + [pa.int64(), pa.string(), pa.binary()]

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=names)

        for f in sorted((f for f in found if f.type == fs.FileType.File), key=lambda f: f.path):
            stem, _, ending = f.base_name.rpartition(".")
            ending = ending.lower()
            if ending not in IMAGE_ENDINGS or zlib.crc32(f.base_name.encode()) % partition.of != partition.part:
                continue
            label = content = None
            if self.layout == "detection":
                label_path = f"{partition.folder}/labels/{stem}.txt"
                if system.get_file_info(label_path).type == fs.FileType.File:
                    label = self._bytes(system, label_path).decode("utf-8", "replace")
            if self.contents:
                content = self._bytes(system, f.path)
            rows.append((partition.values.get("dataset"), partition.values.get("split"), partition.values.get("class"), f.path, stem, ending, f.size, label, content))
            held += len(content or b"") + len(label or "") + 200
            if held >= BATCH_BYTES:
                yield close()
                rows, held = [], 0
        if rows:
            yield close()

    @staticmethod
    def _bytes(system: fs.FileSystem, path: str) -> bytes:
        with system.open_input_stream(path) as stream:
            return stream.read()


@dataclass
class WrittenFiles(WriterCommitMessage):
    files: int
    skipped: int


class JpegWriter(DataSourceArrowWriter):
    """Writes rows (file, split, class, height, width, pixels, label) as files; see :func:`write_jpeg_files`."""

    def __init__(self, options: dict, overwrite: bool):
        self.options = {k.lower(): v for k, v in options.items()}
        self.quality = int(self.options.get("quality", "95"))
        self.detection = self.options.get("layout", "splits") == "detection"
        self.overwrite = overwrite
        self.aside = f"_temporary-{uuid.uuid4().hex}"
        system, inner = open_path(self.options["path"])
        if overwrite:
            system.create_dir(inner, recursive=True)
            system.delete_dir_contents(inner)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WrittenFiles:
        system, root = open_path(self.options["path"])
        aside = f"{root}/{self.aside}/{uuid.uuid4().hex}"
        system.create_dir(aside, recursive=True)
        made: set[str] = set()
        files = skipped = 0

        def put(folder: str, name: str, data: bytes) -> None:
            if folder not in made:
                system.create_dir(folder, recursive=True)
                made.add(folder)
            with system.open_output_stream(f"{aside}/{name}") as out:
                out.write(data)
            system.move(f"{aside}/{name}", f"{folder}/{name}")

        for batch in iterator:
            for row in batch.to_pylist():
                for part in (row["file"], row.get("split"), row.get("class")):
                    if part is not None and ("/" in part or part in ("", ".", "..")):
                        raise ValueError(f"not the name of a file or folder: {part!r}")
                if row["file"] is None or row["pixels"] is None:
                    skipped += 1
                    continue
                raster = np.frombuffer(row["pixels"], dtype=np.uint8).reshape(row["height"], row["width"], -1)
                folder = "/".join([root, *(x for x in (row.get("split"), None if self.detection else row.get("class")) if x)])
                put(f"{folder}/images" if self.detection else folder, row["file"], encode_jpeg(raster[..., 0] if raster.shape[2] == 1 else raster, self.quality))
                if self.detection:
                    system.create_dir(f"{folder}/labels", recursive=True)
                    if row.get("label") is not None:
                        put(f"{folder}/labels", row["file"].rpartition(".")[0] + ".txt", row["label"].encode())
                files += 1
        return WrittenFiles(files, skipped)

    def _clear(self) -> tuple[fs.FileSystem, str]:
        system, root = open_path(self.options["path"])
        if system.get_file_info(f"{root}/{self.aside}").type == fs.FileType.Directory:
            system.delete_dir(f"{root}/{self.aside}")
        return system, root

    def commit(self, messages: list[WrittenFiles | None]) -> None:
        system, root = self._clear()
        with system.open_output_stream(f"{root}/_SUCCESS") as out:
            out.write(f"{sum(m.files for m in messages if m)} files, {sum(m.skipped for m in messages if m)} rows without pixels\n".encode())

    def abort(self, messages: list[WrittenFiles | None]) -> None:
        self._clear()


class ImageFolders(DataSource):
    """The data source ``image_folders``: options path, layout, dataset, split, class, contents and shards to read, path, layout and quality to write."""

    @classmethod
    def name(cls) -> str:
        return "image_folders"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema: StructType) -> FolderReader:
        return FolderReader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> JpegWriter:
        return JpegWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    """Make the source known to a session."""
    spark.dataSource.register(ImageFolders)


def read_image_folders(
    spark: SparkSession, path: str, layout: str = "splits", dataset: str | None = None, splits: list[str] | None = None, classes: list[str] | None = None, contents: bool = True, shards: int = 4
) -> DataFrame:
    """(dataset, split, class, path, stem, ending, length, label, content) of the images below ``path``.

    Layouts: ``splits`` has folders by split and class, ``classes`` folders by class with any folders below, ``detection`` splits
    with images and labels (label is the text of the image's label file, or null), ``flat`` none. Columns that a layout
    doesn't tell are null. A missing folder has no rows. ``splits`` and ``classes`` choose the folders that
    are listed. Each folder is dealt to ``shards`` tasks.
    """
    register(spark)
    reader = spark.read.format("image_folders").option("path", path).option("layout", layout).option("contents", str(contents).lower()).option("shards", shards)
    for name, value in (("dataset", dataset), ("split", splits and json.dumps(splits)), ("class", classes and json.dumps(classes))):
        reader = reader.option(name, value) if value else reader
    return reader.load()


def with_sizes(images: DataFrame) -> DataFrame:
    """Add height and width from the heads of the files' contents, -1 where they tell none."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [image_size(c) or (-1, -1) if c else (-1, -1) for c in batch.column("content").to_pylist()]
            for k, name in enumerate(("height", "width")):
                batch = batch.append_column(name, pa.array([s[k] for s in sizes], pa.int32()))
            yield batch

    return images.mapInArrow(measure, StructType(list(images.schema.fields)).add("height", IntegerType()).add("width", IntegerType()))


def label_lines(images: DataFrame) -> DataFrame:
    """(dataset, split, stem, line_no, line) of rows of a detection layout; images without a label file have none."""
    lines = images.where(F.col("label").isNotNull()).select("dataset", "split", "stem", F.posexplode(F.split("label", r"\r?\n")).alias("line_no", "line"))
    return lines.where(F.trim("line") != "")


def write_jpeg_files(records: DataFrame, path: str, quality: int = 95, layout: str = "splits") -> None:
    """One JPEG file per row (file, split, class, height, width, pixels), in folders by split and class where those aren't null.

    ``pixels`` are rows of bytes, gray or red, green and blue. With ``layout`` detection the files go to
    <split>/images and the texts of a column ``label`` to <split>/labels. Rows without a name or pixels are counted in the file
    ``_SUCCESS`` and make no file. Rows of equal names in one folder replace each other: names are the caller's to keep apart.
    """
    register(records.sparkSession)
    columns = [c for c in ("file", "split", "class", "height", "width", "pixels", "label") if c in records.columns]
    kept = records.select(*[F.col(c).cast("int" if c in ("height", "width") else "binary" if c == "pixels" else "string").alias(c) for c in columns])
    kept.write.format("image_folders").option("path", path).option("quality", quality).option("layout", layout).mode("overwrite").save()
