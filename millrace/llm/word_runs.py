"""Periodic runs of words in each text, by the divide and conquer of Main and Lorentz.

A run is a stretch of consecutive words with smallest period q (words q apart are the same) that is at
least twice as long as q and that no neighbouring word extends. The words of a batch of texts are interned
as integers. A stretch of words is cut at its midpoint; a run across the midpoint repeats there with
its period to the left or to the right, so it shows as a match between the words about the midpoint and
those about a place one period away. The lengths of these matches, forwards and backwards, are the Z-functions of
the midpoint. Runs on one side of it are found in the halves.

All midpoints of a level, of all texts, are worked at once: places that share no three words with
their midpoint can't belong to a run of the least length, and the matches of the others are counted on
word by word, in step. Where long matches are many, a linear scan takes over, so a text of n words
costs n log n whatever it repeats.

Defined cases: a null or empty text has no words and no runs; null and repeated ids are rows like any other;
extra columns are ignored; an empty table gives an empty result; a text of any length is handled whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_crc, text_runs, trim, tune

#: Words that a run has at least.
LEAST = 12
#: Bytes of text worked on together; words that matches are counted on in step; longer matches of a midpoint from which the scan is linear.
RUN_BYTES, STEPS, MANY = 4 << 20, 32, 64

SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
_U64 = np.uint64


def z_function(s: list[int]) -> list[int]:
    """Length of the longest common prefix of ``s`` and each of its suffixes."""
    n = len(s)
    z = [0] * n
    left = right = 0
    for i in range(1, n):
        k = min(z[i - left], right - i) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    if n:
        z[0] = n
    return z


def _matches(words: np.ndarray, at: np.ndarray, node: np.ndarray, low: np.ndarray, middle: np.ndarray, high: np.ndarray, forwards: bool) -> np.ndarray:
    """Number of words from each place (or before it) that equal those from (before) its node's midpoint, within the node."""
    mid = middle[node]
    limit = high[node] - np.maximum(at, mid) if forwards else np.minimum(at, mid) - low[node]
    found = np.zeros(len(at), dtype=np.int64)
    going = np.arange(len(at))
    for k in range(STEPS):
        going = going[limit[going] > k]
        step = k if forwards else -k - 1
        going = going[words[at[going] + step] == words[mid[going] + step]]
        if not len(going):
            return found
        found[going] = k + 1
    going = going[limit[going] > STEPS]
    for n in np.unique(node[going]).tolist():
        those = going[node[going] == n]
        a, m, z = int(low[n]), int(middle[n]), int(high[n])
        if len(those) > MANY:
            if forwards:
                lengths = np.array(z_function([*words[m:z].tolist(), -1, *words[a:z].tolist()]))
                found[those] = lengths[z - m + 1 + at[those] - a]
            else:
                lengths = np.array(z_function([*words[a:m][::-1].tolist(), -1, *words[a:z][::-1].tolist(), -2]))
                found[those] = lengths[m - a + 1 + z - at[those]]
            continue
        for t in those.tolist():
            p, most = int(at[t]), int(limit[t])
            one, two = (words[p : p + most], words[m : m + most]) if forwards else (words[p - most : p][::-1], words[m - most : m][::-1])
            differ = np.flatnonzero(one != two)
            found[t] = differ[0] if len(differ) else most
    return found


def find_runs(words: np.ndarray, ends: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs, in this order, in texts of word ids that follow each other and end at ``ends``.

    ``start`` counts within the text. Runs are at least ``least`` words long, and no shorter than 12.
    """
    if least < LEAST:
        raise ValueError(f"runs are at least {LEAST} words long")
    words = np.ascontiguousarray(words, dtype=np.int64)
    n = len(words)
    # Three words as one number; equal words give equal numbers, and the few others are told apart when matches are counted.
    padded = np.concatenate([np.full(3, -1), words, np.arange(-5, -2)]).astype(_U64)
    three = padded[:-2] * _U64(0x9E3779B97F4A7C15) + padded[1:-1] * _U64(0xC2B2AE3D27D4EB4F) + padded[2:] * _U64(0x165667B19E3779F9)
    ahead, behind = three[3 : n + 4], three[: n + 1]
    begins = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else np.zeros(0, np.int64)
    text = np.arange(len(begins))
    low, high = begins, ends.astype(np.int64)
    found: list[tuple[np.ndarray, ...]] = []
    while True:
        wide = high - low >= least
        low, high, text = low[wide], high[wide], text[wide]
        if not len(low):
            break
        middle = (low + high) // 2
        sizes = high - low + 1
        node = np.repeat(np.arange(len(low)), sizes)
        at = np.arange(len(node)) + np.repeat(low - (np.cumsum(sizes) - sizes), sizes)
        hit = (ahead[at] == ahead[middle][node]) | (behind[at] == behind[middle][node])
        hit = np.flatnonzero(hit & (at != middle[node]))
        at, node = at[hit], node[hit]
        after = _matches(words, at, node, low, middle, high, True)
        before = _matches(words, at, node, low, middle, high, False)
        mid, period = middle[node], np.abs(at - middle[node])
        start, end = np.minimum(at, mid) - before, np.maximum(at, mid) + after
        good = (after + before >= period) & (end - start >= least)
        # What goes on beyond its node crossed the midpoint of a larger one and was found whole there.
        owner = text[node]
        left, right = begins[owner], ends[owner]
        good &= ~((start == low[node]) & (start > left) & (words[np.maximum(start - 1, 0)] == words[np.maximum(start - 1, 0) + np.minimum(period, n - np.maximum(start, 1))]))
        good &= ~((end == high[node]) & (end < right) & (words[np.minimum(end, n - 1)] == words[np.maximum(np.minimum(end, n - 1) - period, 0)]))
        found.append((owner[good], start[good] - left[good], (end - start)[good], period[good]))
        low, high, text = np.stack([low, middle], axis=1).ravel(), np.stack([middle, high], axis=1).ravel(), np.repeat(text, 2)
    if not found:
        return (np.zeros(0, np.int64),) * 4
    text, start, length, period = (np.concatenate(c) for c in zip(*found))
    # A stretch that repeats with q words repeats with their multiples too: the smallest period counts.
    order = np.lexsort((period, length, start, text))
    text, start, length, period = text[order], start[order], length[order], period[order]
    new = np.ones(len(text), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    text, start, length, period = text[new], start[new], length[new], period[new]
    order = np.lexsort((period, start, text))
    return text[order], start[order], length[order], period[order]


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words ``[^\\x20\\x09-\\x0D]+`` of some texts in a row, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    values = lists.flatten()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    real = pc.binary_length(values).to_numpy(zero_copy_only=False) > 0
    before = np.concatenate([[0], np.cumsum(real)])
    return values.filter(pa.array(real)), np.diff(before[offsets - offsets[0]])


def runs_of_batch(batch: pa.RecordBatch, least: int = LEAST) -> pa.RecordBatch:
    """Rows (doc_id, text) as rows of ``SCHEMA``."""
    values, counts = split_words(batch.column("text"))
    coded = values.dictionary_encode()
    ends = np.cumsum(counts)
    text, start, length, period = find_runs(coded.indices.to_numpy().astype(np.int64), ends, least)
    first = (ends - counts)[text] + start
    # +1 where a run's repetition begins and -1 where it ends: a word under any of them goes.
    cover = np.zeros(len(values) + 1, dtype=np.int64)
    np.add.at(cover, first + period, 1)
    np.add.at(cover, first + length, -1)
    kept = np.cumsum(cover)[:-1] == 0
    kept_before = np.concatenate([[0], np.cumsum(kept)])[np.concatenate([[0], ends])]
    collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(kept_before, pa.int32()), values.filter(pa.array(kept))), " ")
    per_text = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(counts)))])
    runs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], ["start", "length", "period"])
    columns = [batch.column("doc_id").cast(pa.int64()), pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(per_text, pa.int32()), runs), collapsed]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row (doc_id, text): one pass, without a shuffle.

    ``runs`` (start, length, period) are ordered by start and period, in words from 0. ``collapsed`` is the text with
    each run's words after its first period dropped, words joined by one space.
    """
    tune(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_runs(batches, RUN_BYTES):
            yield runs_of_batch(batch, least)
        trim()

    return docs.select("doc_id", "text").mapInArrow(work, SCHEMA)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text) in which a tenth of the texts, chosen by crc32 of the id, repeat themselves from some word on."""
    h = doc_crc()
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    chosen = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("w"), F.floor(h / 10).cast("long").alias("g"))
    n = F.size("w").cast("long")
    chosen = chosen.withColumn("n", F.when(F.col("w").isNotNull() & (n > 0), n)).withColumn("a", F.expr("g % n")).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    changed = F.expr("array_join(transform(sequence(0L, n - 1), i -> w[int(if(i < a, i, a + (i - a) % p))]), ' ')")
    return chosen.select("doc_id", F.when(F.col("n").isNotNull(), changed).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """The longest run of each text and digests of its runs and of what is left of it."""
    best = F.expr("array_max(transform(runs, r -> named_struct('length', r.length, 'back', -r.start, 'small', -r.period)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    start, length, period = -F.col("best.back"), F.col("best.length"), -F.col("best.small")
    return found.withColumn("best", F.when(F.size("runs") > 0, best)).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"),
        F.expr("1000 * best.length div -best.small").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
