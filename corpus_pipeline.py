"""The corpus pipeline: language ID, quality rules, near-duplicate removal, decontamination, packing.

Every stage takes all rows that its predecessor kept, and returns whole rows of documents with all their columns, but
for the last, which returns pieces. Defined cases, for all stages: a null or empty text has no letter, so
the language stage rejects it, and any stage called by itself takes it as a text without words; rows
without an id stay, and are the last choice among copies; rows that share an id are told apart by
their texts; repeated rows are copies, of which one stays; texts of any length are handled whole; extra
columns are carried along whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.durable import delete_paths, recorded, release
from millrace.llm import decontaminate, jaccard_join, language_id, packing, quality_rules
from millrace.llm.common import materialise, table


#: By thread: the tables that each stage's last calls wrote for their own use.
_left = threading.local()


def stage(place: int) -> Callable:
    """A stage drops what the stage before it left behind in the same thread, whose result has been written and read again by then.

    Tables that ``docs`` still reads, since its stage's result wasn't written, stay.
    """

    def wrap(run: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
        @functools.wraps(run)
        def step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            left = _left.__dict__.setdefault("paths", {})
            before = left.pop((place - 1, sf_dir), [])
            if before:
                read = {f.rsplit("/", 1)[0].rsplit("/", 1)[-1] for f in docs.inputFiles()}
                kept = [p for p in before if p.rsplit("/", 1)[-1] in read]
                delete_paths(spark, [] if kept else before)
            release(spark)
            mine = left.setdefault((place, sf_dir), [])
            with recorded(mine):
                return run(spark, docs, sf_dir)

        return step

    return wrap


@stage(0)
def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the word-first model recognises and their label, if any, doesn't contradict.

    The model learns from the labels of the stage's own documents.
    """
    return language_id.filter_by_language(docs, language_id.train(docs))


@stage(1)
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.filter_by_quality(docs)


@stage(2)
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component."""
    return jaccard_join.keep_one_of_each(docs)


@stage(3)
def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


@stage(4)
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, each with its sequence."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_stage),
    ("quality_rules", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: Not SQL: a trained model, a near-duplicate closure, approximate matching and bin packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, run_stage in STAGES:
        docs = materialise(run_stage(spark, docs, sf_dir), f"pipeline-{name}")
    delete_paths(spark, _left.__dict__.get("paths", {}).pop((len(STAGES) - 1, sf_dir), []))
    return docs
