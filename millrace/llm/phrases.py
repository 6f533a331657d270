"""Phrases whose words keep together, found by pivot partitioning as in MG-FSM.

Words are counted by language and numbered from the most frequent one. A text is rewritten in these numbers, with
words that are too rare for any phrase left blank. The pivot of an n-gram is its rarest word, that is its largest number.
From each occurrence of a word goes a fragment to that word's partition: the words about it, as far as an
n-gram of the most words can reach, up to the first blank or rarer word. Equal fragments of a run of texts travel once,
with their count. A partition counts the n-grams of its fragments that hold its pivot, each at
the pivot's first occurrence, and no others, so every occurrence of an n-gram is counted once and in one place.

A pivot's fragments are cut by ranges of their hash into pieces of bounded size where its word is so frequent that it needs that; the
counts of such pieces are added up afterwards. They are few, since only words more frequent than the pivot are in them.

Defined cases: a null text is empty, a null language is ``und``; rows count as often as they occur, whatever their ids; an empty
table gives an empty result; a text of any length is handled whole; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.numbering import dense_numbers
from .common import drop_materialised, materialise, mix64, release, text_runs, trim, tune
from .word_runs import split_words

#: Occurrences that a candidate has at least; phrases of each language that are returned; occurrences of a longer
#: phrase, in hundredths, with which it takes the place of the ones inside it.
LEAST, TOP, COVERED = 10, 2000, 50
#: Bytes of text that are rewritten together; fragments of a pivot, or of some pivots, that are mined together.
RUN_BYTES, MINED = 6 << 20, 1 << 18
#: Fixed value: the characters that end a piece of text besides ``.``.
ENDS = r"[,;:!?\n\x0b\x0c\r]"

RUN_SCHEMA = "run long, sequence binary, langs array<string>, words array<string>, counts array<long>"
FRAGMENT_SCHEMA = "pivot long, part int, parts int, fragments binary"
GRAM_SCHEMA = "w1 long, w2 long, w3 long, a long"
_U64 = np.uint64


def _local_run(batch: pa.RecordBatch, run: int) -> pa.RecordBatch:
    """A run of texts (text, lang) as local word numbers, 0 at the end of each piece, and its words with their counts."""
    lower = pc.ascii_lower(pc.fill_null(batch.column("text"), ""))
    # No word holds a full stop, so that stands for the end of a piece.
    values, per_text = split_words(pc.replace_substring(pc.replace_substring_regex(lower, ENDS, "."), ".", " . "))
    langs, coded = pc.fill_null(batch.column("lang"), "und").dictionary_encode(), values.dictionary_encode()
    word = coded.indices.to_numpy().astype(np.int64)
    n = max(1, len(coded.dictionary))
    pair = np.repeat(langs.indices.to_numpy().astype(np.int64), per_text) * n + word
    stop = pc.index(coded.dictionary, ".").as_py()
    real = word != stop
    known, at, counts = np.unique(pair[real], return_inverse=True, return_counts=True)
    sequence = np.zeros(len(word), dtype=np.int32)
    sequence[real] = at + 1
    sequence = np.insert(sequence, np.cumsum(per_text), 0).astype("<i4")
    one = lambda x, kind: pa.array([x], kind)
    lists = [pa.ListArray.from_arrays(pa.array([0, len(known)], pa.int32()), v) for v in (langs.dictionary.take(pa.array(known // n)), coded.dictionary.take(pa.array(known % n)), pa.array(counts, pa.int64()))]
    return pa.RecordBatch.from_arrays([one(run, pa.int64()), one(sequence.tobytes(), pa.binary()), *lists], names=["run", "sequence", "langs", "words", "counts"])


def local_runs(docs: DataFrame) -> DataFrame:
    """The texts (text, lang) of a table in runs, each with its own numbers of words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for k, batch in enumerate(text_runs(batches, RUN_BYTES)):
            yield _local_run(batch, (part << 32) + k)
        trim()

    tune(docs.sparkSession)
    return docs.select("text", "lang").mapInArrow(work, RUN_SCHEMA)


def _fragments(sequence: np.ndarray, parts: np.ndarray) -> pa.RecordBatch:
    """The fragments of a run of ranks, 0 for blanks. ``parts`` holds the number of pieces that each place's pivot is cut into."""
    padded = np.concatenate([np.zeros(2, np.int64), sequence, np.zeros(2, np.int64)])
    pivot = sequence
    columns = []
    for near, far in ((padded[1:-3], padded[:-4]), (padded[3:-1], padded[4:])):
        near = np.where(near <= pivot, near, 0)
        columns += [near, np.where((near > 0) & (far <= pivot), far, 0)]
    useful = np.flatnonzero((pivot > 0) & ((columns[0] > 0) | (columns[2] > 0)))
    grid = np.stack([pivot[useful], *(c[useful] for c in columns)], axis=1)
    pieces = parts[useful].astype(_U64)
    mixed = np.zeros(len(grid), dtype=_U64)
    for c in range(1, 5):
        mixed = mix64(mixed * _U64(0x9E3779B97F4A7C15) + grid[:, c].astype(_U64))
    mixed >>= _U64(32)
    # In order of the hash, a pivot's pieces are ranges.
    order = np.argsort((grid[:, 0].astype(_U64) << _U64(32)) | mixed, kind="stable") if not len(grid) or grid[:, 0].max() < 1 << 32 else np.lexsort((mixed, grid[:, 0]))
    grid, mixed, pieces = grid[order], mixed[order], pieces[order]
    new = np.ones(len(grid), dtype=bool)
    new[1:] = (grid[1:] != grid[:-1]).any(axis=1)
    firsts = np.flatnonzero(new)
    counts = np.diff(np.append(firsts, len(grid)))
    grid, pieces, part = grid[firsts], pieces[firsts], ((mixed[firsts] * pieces[firsts]) >> _U64(32)).astype(np.int32)
    rows = np.ones(len(grid), dtype=bool)
    rows[1:] = (grid[1:, 0] != grid[:-1, 0]) | (part[1:] != part[:-1])
    rows = np.flatnonzero(rows)
    kind = "<u4" if not len(grid) or grid[:, 0].max() < 1 << 32 else "<u8"
    width = 20 if kind == "<u4" else 40
    payload = np.concatenate([grid[:, 1:], counts[:, None]], axis=1).astype(kind)
    offsets = np.append(rows, len(grid)).astype(np.int64) * width
    binary = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(payload.tobytes())]).cast(pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(grid[rows, 0]), pa.array(part[rows]), pa.array(pieces[rows].astype(np.int32)), binary], names=["pivot", "part", "parts", "fragments"])


def _send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (sequence, known: structs of local number, rank and parts) as fragments."""
    for batch in batches:
        for k in range(batch.num_rows):
            sequence = np.frombuffer(batch.column("sequence")[k].as_buffer(), dtype="<i4")
            known = batch.column("known").slice(k, 1).flatten()
            local, rank, parts = (known.field(i).to_numpy() for i in range(3))
            ranks, pieces = np.zeros(int(sequence.max(initial=0)) + 1, dtype=np.int64), np.ones(int(sequence.max(initial=0)) + 1, dtype=np.int32)
            ranks[local], pieces[local] = rank, parts
            found = _fragments(ranks[sequence], pieces[sequence])
            for a in range(0, found.num_rows, 20_000):
                yield found.slice(a, 20_000)
    trim()


def count_owned(pivot: np.ndarray, fragments: np.ndarray) -> np.ndarray:
    """(w1, w2, w3, count) of the n-grams of 2 and 3 words that hold the pivot; w3 is 0 in pairs.

    Fragments have the next and the second word to the left, those to the right, and a count. An n-gram that holds the pivot
    twice is counted at the first of both.
    """
    left, left2, right, right2, count = fragments.T.astype(np.int64)
    other = left != pivot
    nothing = np.zeros_like(pivot)
    grams = []
    for good, words in (
        ((left > 0) & other, (left, pivot, nothing)), (right > 0, (pivot, right, nothing)), ((left2 > 0) & other & (left2 != pivot), (left2, left, pivot)),
        ((left > 0) & (right > 0) & other, (left, pivot, right)), (right2 > 0, (pivot, right, right2)),
    ):
        at = np.flatnonzero(good)
        grams.append(np.stack([*(w[at] for w in words), count[at]], axis=1))
    grid = np.concatenate(grams)
    if not len(grid):
        return grid
    if grid[:, :3].max() < 1 << 32:
        order = np.lexsort((grid[:, 2], (grid[:, 0].astype(_U64) << _U64(32)) | grid[:, 1].astype(_U64)))
    else:
        order = np.lexsort((grid[:, 2], grid[:, 1], grid[:, 0]))
    grid = grid[order]
    new = np.ones(len(grid), dtype=bool)
    new[1:] = (grid[1:, :3] != grid[:-1, :3]).any(axis=1)
    firsts = np.flatnonzero(new)
    return np.concatenate([grid[firsts, :3], np.add.reduceat(grid[:, 3], firsts)[:, None]], axis=1)


def _mine(least: int):
    """Rows (pivot, part, parts, fragments) in order of pivot and part as counts of n-grams; small counts of whole pivots go."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        waiting, last = 0, None

        def close() -> pa.RecordBatch:
            nonlocal waiting
            pivot, parts, grid = (np.concatenate(c) for c in zip(*held))
            held.clear()
            waiting = 0
            out = []
            for whole in (True, False):
                some = (parts == 1) == whole
                grams = count_owned(pivot[some], grid[some])
                out.append(grams[grams[:, 3] >= least] if whole else grams)
            grams = np.concatenate(out)
            return pa.RecordBatch.from_arrays([pa.array(grams[:, c].astype(np.int64)) for c in range(4)], names=["w1", "w2", "w3", "a"])

        for batch in batches:
            pivots, part, parts = (batch.column(c).to_numpy() for c in ("pivot", "part", "parts"))
            sizes = pc.binary_length(batch.column("fragments")).to_numpy().astype(np.int64)
            edges = np.concatenate([[True], (pivots[1:] != pivots[:-1]) | (part[1:] != part[:-1])]) if len(pivots) else np.zeros(0, bool)
            a = 0
            while a < len(pivots):
                # Up to the next edge after which enough is held.
                if (pivots[a], part[a]) != last and waiting >= MINED:
                    yield close()
                more = np.flatnonzero(edges[a + 1 :] & (np.cumsum(sizes[a:])[:-1] // 20 + waiting >= MINED))
                b = a + 1 + int(more[0]) if len(more) else len(pivots)
                width = np.where(pivots[a:b] < 1 << 32, 20, 40)
                for w, kind in ((20, "<u4"), (40, "<u8")):
                    some = np.flatnonzero(width == w) + a
                    if len(some):
                        rows = batch.column("fragments") if len(some) == len(pivots) else batch.column("fragments").take(pa.array(some))
                        grid = np.frombuffer(b"".join(rows.to_pylist()), dtype=kind).reshape(-1, 5)
                        n = sizes[some] // w
                        held.append((np.repeat(pivots[some], n), np.repeat(parts[some], n), grid))
                        waiting += int(n.sum())
                last = (pivots[b - 1], part[b - 1])
                a = b
        if held:
            yield close()
        trim()

    return work


def count_phrases(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Words (rank, lang, word, f), n-grams (w1, w2, w3, a) of ranks with ``least`` occurrences or more, and sizes (lang, n)."""
    spark = docs.sparkSession
    runs = materialise(local_runs(docs), "phrase-runs")
    each = runs.select("run", F.posexplode(F.arrays_zip("langs", "words", "counts")).alias("at", "e")).select("run", (F.col("at") + 1).alias("local"), F.col("e.langs").alias("lang"), F.col("e.words").alias("word"), F.col("e.counts").alias("count"))
    counted = materialise(each.groupBy("lang", "word").agg(F.sum("count").alias("f")), "phrase-words")
    sizes = materialise(counted.groupBy("lang").agg(F.sum("f").alias("n")), "phrase-sizes")
    numbers = dense_numbers(counted.where(F.col("f") >= least), [F.desc("f"), F.col("lang"), F.col("word")], "rank")
    words = materialise(numbers.select((F.col("rank") + 1).alias("rank"), "lang", "word", "f"), "phrase-ranks")
    drop_materialised(counted, numbers)
    parts = (F.floor(F.col("f") / MINED) + 1).cast("int")
    known = each.join(words, ["lang", "word"]).groupBy("run").agg(F.collect_list(F.struct("local", "rank", parts.alias("parts"))).alias("known"))
    tune(spark)
    fragments = runs.select("run", "sequence").join(known, "run").select("sequence", "known").mapInArrow(_send, FRAGMENT_SCHEMA)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = fragments.repartition(n, "pivot", "part").sortWithinPartitions("pivot", "part")
    grams = dealt.mapInArrow(_mine(least), GRAM_SCHEMA).groupBy("w1", "w2", "w3").agg(F.sum("a").alias("a")).where(F.col("a") >= least)
    grams = materialise(grams, "phrase-grams")
    drop_materialised(runs)
    release(spark)
    return words, grams, sizes


def score_of(a: str, left: str, right: str) -> Column:
    """floor(1000000 a a / (l r)); decimals hold the products of counts up to 10^16."""
    wide = lambda c: f"cast({c} as decimal(16,0))"
    return F.expr(f"({wide(a)} * {wide(a)} * 1000000) div ({wide(left)} * {wide(right)})")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, covered: int = COVERED) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of each language, from rows (text, lang).

    A phrase is cut where its score is lowest, and dropped if a longer one that holds it has ``covered`` hundredths of its occurrences.
    """
    words, grams, sizes = count_phrases(docs, least)
    pairs, triples = grams.where(F.col("w3") == 0).drop("w3"), grams.where(F.col("w3") > 0)

    def of_word(rows: DataFrame, at: str) -> DataFrame:
        """Rows with the string and the count of their word ``at``."""
        return rows.join(words.select(F.col("rank").alias(at), F.col("word").alias(f"s_{at}"), F.col("f").alias(f"f_{at}"), F.col("lang").alias(f"lang_{at}")), at)

    longer = triples.select("w1", "w2", "a").unionByName(triples.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a")).groupBy("w1", "w2").agg(F.max("a").alias("over"))
    kept = pairs.join(longer, ["w1", "w2"], "left").where(F.col("over").isNull() | (100 * F.col("over") < covered * F.col("a")))
    two = of_word(of_word(kept, "w1"), "w2").select(F.col("lang_w1").alias("lang"), F.concat_ws(" ", "s_w1", "s_w2").alias("phrase"), "a", F.col("f_w1").alias("l"), F.col("f_w2").alias("r"))
    three = triples.join(pairs.withColumnRenamed("a", "head"), ["w1", "w2"]).join(pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("tail")), ["w2", "w3"])
    three = of_word(of_word(of_word(three, "w1"), "w2"), "w3")
    first, second = score_of("a", "f_w1", "tail"), score_of("a", "head", "f_w3")
    three = three.withColumn("early", first <= second).select(
        F.col("lang_w1").alias("lang"), F.concat_ws(" ", "s_w1", "s_w2", "s_w3").alias("phrase"), "a",
        F.when(F.col("early"), F.col("f_w1")).otherwise(F.col("head")).alias("l"), F.when(F.col("early"), F.col("tail")).otherwise(F.col("f_w3")).alias("r"),
    )
    scored = two.unionByName(three).withColumn("score", score_of("a", "l", "r"))
    # Each run of a language gives its best, and the best of those are the language's.
    some = scored.withColumn("_run", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    best = [F.desc("score"), F.desc("a"), F.col("phrase")]
    for keys in (["lang", "_run"], ["lang"]):
        some = some.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*best))).where(F.col("rank") <= top)
    return some.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
