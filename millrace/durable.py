"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import contextlib
import gc
import re
import tempfile
import threading
import time
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, else the context's checkpoint folder.

    A machine-local folder takes their place only in local mode, where it is shared; a cluster without such a
    folder is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="millrace-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts the lineage: a later stage that loses an executor rereads the files and nothing above
    them runs again, so values that depend on the partitioning stay as written.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    for paths in _recorders.get(threading.get_ident(), []):
        paths.append(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: By thread, lists that note the paths of tables while they are written; see :func:`recorded`.
_recorders: dict[int, list[list[str]]] = {}


@contextlib.contextmanager
def recorded(paths: list[str]) -> Iterator[None]:
    """Note the paths of all tables that this thread writes meanwhile, so that :func:`delete_paths` can drop them later."""
    mine = _recorders.setdefault(threading.get_ident(), [])
    mine.append(paths)
    try:
        yield
    finally:
        # The last one is this one, whatever equals it.
        mine.pop()
        if not mine:
            _recorders.pop(threading.get_ident(), None)


def delete_paths(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders by Spark's file system, and forget their paths; ones that are gone already do no harm."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    for name in paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)
    paths.clear()


def drop_materialised(*frames: DataFrame) -> None:
    """Delete tables written by :func:`materialise` whose rows nobody needs any more."""
    for df in frames:
        delete_paths(df.sparkSession, sorted({f.rsplit("/", 1)[0] for f in df.inputFiles()}))


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps now and not when the driver next collects garbage.

    Events of finished queries hold on to their plans, so those are waited for, where the session lets us.
    """
    with contextlib.suppress(Exception):
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.1)
