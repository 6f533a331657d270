"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

A benchmark item of m characters that occurs in a text with at most k edits keeps at least
``m - q + 1 - k q`` of its q-grams, and all of them on diagonals that differ by k at most. Shared q-grams
are therefore counted in overlapping bands of diagonals, and only regions that reach that bound are
aligned, within a band around their diagonals. Every item's k is the largest for which the bound is
still a quarter of its q-grams: about 10 % of its characters with q = 7, and none below 16 characters.

Texts are compared in lower case, with every run of characters that are neither letters nor digits as
one space; results give places in the text as it stands.

Benchmarks of any size are handled in blocks of a bounded number of characters, each of which is matched
against all documents.

Defined cases: null and empty texts match nothing, and so do items without a letter or digit; items of fewer
characters than a q-gram after normalisation match whole words without edits; a text of any length is
matched with all of its item and place pairs that occur, and no table of all pairs is made; repeated rows of documents or items each match for themselves; null ids are
carried along; extra columns are ignored by :func:`find_passages` and kept by :func:`remove_contaminated`;
empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tune

Q = 7
#: Share of an item's q-grams that must be left on a band.
LEFT_SHARE = 0.25
#: Regions aligned together.
ALIGN_AT_ONCE = 64
#: Characters of benchmark text that are broadcast at a time.
BLOCK_CHARS = 2_000_000
#: Code points of documents that are matched at a time.
CHUNK_POINTS = 1_000_000

MATCH_SCHEMA = "doc_id long, item_id long, start long, end long, edits long"


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype="<u4")


def _fold(ch: str) -> int:
    """The lower case of a letter or digit, else a space."""
    low = ch.lower()
    return (ord(low) if len(low) == 1 else ord(ch)) if ch.isalnum() else 32


def _folding() -> np.ndarray:
    """:func:`_fold` of each code point below 65536."""
    return np.array([_fold(chr(c)) for c in range(65536)], dtype=np.uint32)


def normalise(points: np.ndarray, folding: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normalised code points and the place of each in the given ones."""
    folded = folding[np.minimum(points, 65535)]
    far = np.flatnonzero(points >= 65536)
    if len(far):
        kinds, at = np.unique(points[far], return_inverse=True)
        folded[far] = np.array([_fold(chr(c)) for c in kinds], dtype=np.uint32)[at]
    space = folded == 32
    keep = ~space
    keep[1:] |= space[1:] & ~space[:-1]
    at = np.flatnonzero(keep)
    return folded[at], at


def gram_codes(points: np.ndarray, q: int = Q) -> np.ndarray:
    """A 64-bit code of every q-gram."""
    codes = np.zeros(max(0, len(points) - q + 1), dtype=np.uint64)
    for k in range(q):
        codes = codes * np.uint64(0x9E3779B97F4A7C15) + points[k : k + len(codes)]
    return codes ^ (codes >> np.uint64(29))


def edit_budget(m: int, q: int = Q) -> tuple[int, int]:
    """(k, shared q-grams that k edits leave at least) for an item of m characters."""
    grams = m - q + 1
    k = int((1 - LEFT_SHARE) * grams / q)
    return k, grams - k * q


class Index:
    """The q-grams of some benchmark items with their places, ready to be broadcast."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        folding = _folding()
        self.folding, self.ids, self.texts = folding, [], []
        self.short: dict[int, tuple[np.ndarray, int]] = {}
        short: dict[int, list[tuple[int | None, np.ndarray]]] = {}
        codes, owners, places = [], [], []
        for item, text in items:
            points, _ = normalise(_code_points(text or ""), folding)
            points = points[int(len(points) > 0 and points[0] == 32) :]
            points = points[: len(points) - int(len(points) > 0 and points[-1] == 32)]
            if len(points) < Q:
                if len(points):
                    short.setdefault(len(points), []).append((item, points))
                continue
            c = gram_codes(points)
            codes.append(c)
            owners.append(np.full(len(c), len(self.ids), dtype=np.int64))
            places.append(np.arange(len(c), dtype=np.int64))
            self.ids.append(item)
            self.texts.append(points)
        for size, some in short.items():
            # Items of equal text stand in a row; each has a number after those of the longer items.
            some.sort(key=lambda x: int(gram_codes(x[1], size)[0]))
            self.short[size] = np.array([gram_codes(p, size)[0] for _, p in some], dtype=np.uint64), len(self.ids)
            self.ids += [item for item, _ in some]
        self.sizes = np.array([len(t) for t in self.texts], dtype=np.int64)
        flat = np.concatenate(codes) if codes else np.empty(0, dtype=np.uint64)
        order = np.argsort(flat, kind="stable")
        self.owner = np.concatenate(owners)[order] if codes else np.empty(0, dtype=np.int64)
        self.place = np.concatenate(places)[order] if codes else np.empty(0, dtype=np.int64)
        self.keys, self.first = np.unique(flat[order], return_index=True)
        self.count = np.diff(np.append(self.first, len(flat)))
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[(self.keys & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        budgets = [edit_budget(len(t)) for t in self.texts]
        self.edits = np.array([k for k, _ in budgets], dtype=np.int64)
        self.bound = np.array([b for _, b in budgets], dtype=np.int64)


def align_many(items: list[np.ndarray], points: np.ndarray, spans: list[tuple[int, int]], diagonals: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(edits, begin, end) of the best occurrence of each item in its band of diagonals; the edits are huge if there is none.

    ``spans`` bound the text of each item in ``points``, and ``diagonals`` (first, last) its band: cells in which
    place minus item position lies between them. One row of the band is kept per item, and one step per item
    character is made for all at once. A cell holds the cost above and, below, the diagonal where
    its alignment begins, so both are minimised together.
    """
    width = max(z - a + 1 for a, z in diagonals)
    longest = max(map(len, items))
    low = np.array([a for a, _ in diagonals], dtype=np.int64)
    high = np.array([z for _, z in diagonals], dtype=np.int64)
    begins, ends = (np.array(x, dtype=np.int64) for x in zip(*spans))
    base, never = np.int64(1 << 20), np.int64(1 << 50)
    while base <= width:
        base <<= 1
    band = np.arange(width, dtype=np.int64)
    inside = low[:, None] + band <= high[:, None]
    # Character of each place of the band, row by row: row i sees a window that begins at i.
    place = low[:, None] + np.arange(width + longest)
    real = (place >= begins[:, None]) & (place < ends[:, None])
    window = np.where(real, points[np.clip(place, 0, max(0, len(points) - 1))], 0xFFFFFFFF) if len(points) else np.full(place.shape, 0xFFFFFFFF)
    sizes = np.array([len(x) for x in items])
    chars = np.zeros((len(items), longest), dtype=np.uint32)
    for row, x in zip(chars, items):
        row[: len(x)] = x

    def allowed(i: int) -> np.ndarray:
        at = low[:, None] + band + i
        return inside & (at >= begins[:, None]) & (at <= ends[:, None])

    cells = np.where(allowed(0), band, never)
    for i in range(longest):
        new = cells + base * (window[:, i : i + width] != chars[:, i, None])
        np.minimum(new[:, :-1], cells[:, 1:] + base, out=new[:, :-1])
        new[~allowed(i + 1)] = never
        # A step to the right costs one edit: a running minimum after the steps are taken out.
        new -= base * band
        np.minimum.accumulate(new, axis=1, out=new)
        new += base * band
        new[~allowed(i + 1)] = never
        alive = i < sizes
        cells = new if alive.all() else np.where(alive[:, None], new, cells)
    found = []
    for k, row in enumerate(cells):
        end = int(np.argmin(row // base))
        cost, begin = divmod(int(row[end]), int(base))
        found.append((cost, int(low[k]) + begin, int(low[k]) + end + len(items[k])))
    return found


def matches_of(index: Index, texts: list[str | None]) -> list[tuple[int, int, int, int, int]]:
    """(text, item, start, end, edits) of all items found in some texts."""
    found: list[tuple[int, int, int, int, int]] = []
    if not index.ids:
        return found
    pieces, origins, spans, at = [], [], [], 0
    for t in texts:
        points, place = normalise(_code_points(t or ""), index.folding)
        pieces += [points, np.zeros(1, dtype=np.uint32)]
        origins.append(place)
        spans.append((at, at + len(points)))
        at += len(points) + 1
    points = np.concatenate(pieces) if pieces else np.empty(0, dtype=np.uint32)
    starts = np.array([a for a, _ in spans])
    for t, i, a, z in _short_matches(index, points, starts):
        place = origins[t]
        found.append((t, i, int(place[a - starts[t]]), int(place[z - starts[t] - 1]) + 1, 0))
    for t, i, begin, end, edits in _long_matches(index, points, spans):
        place, a = origins[t], spans[t][0]
        found.append((t, i, int(place[begin - a]), int(place[end - a - 1]) + 1, edits))
    # Neighbouring bands find one occurrence twice, sometimes cut short.
    best: list[tuple] = []
    for m in sorted(found, key=lambda m: (m[0], m[1], m[2], m[4])):
        if best and m[:2] == best[-1][:2] and m[2] < best[-1][3]:
            if m[4] < best[-1][4]:
                best[-1] = m
        else:
            best.append(m)
    return best


def _short_matches(index: Index, points: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(text, item, begin, end) of items shorter than a q-gram that stand as whole words."""
    for size, (keys, first) in index.short.items():
        codes = gram_codes(points, size)
        left, right = np.searchsorted(keys, codes, side="left"), np.searchsorted(keys, codes, side="right")
        for at in np.flatnonzero(right > left).tolist():
            # What bounds a word is a space or the nothing between texts.
            if (at == 0 or points[at - 1] in (0, 32)) and points[at + size] in (0, 32):
                text = int(np.searchsorted(starts, at, side="right")) - 1
                for k in range(left[at], right[at]):
                    yield text, first + k, at, at + size


def _long_matches(index: Index, points: np.ndarray, spans: list[tuple[int, int]]) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, item, begin, end, edits) of items found by their q-grams."""
    n_items = len(index.texts)
    if not n_items:
        return
    codes = gram_codes(points)
    maybe = np.flatnonzero(index.maybe[(codes & np.uint64((1 << 20) - 1)).astype(np.int64)])
    key = np.minimum(np.searchsorted(index.keys, codes[maybe]), len(index.keys) - 1)
    hit = index.keys[key] == codes[maybe]
    maybe, key = maybe[hit], key[hit]
    times = index.count[key]
    entry = np.repeat(index.first[key] - (np.cumsum(times) - times), times) + np.arange(times.sum())
    item, position = index.owner[entry], np.repeat(maybe, times)
    # An occurrence lies in two neighbouring stretches at most; those must hold enough q-grams of its item.
    longest = int(index.sizes.max())
    stretch = position // int((index.sizes + index.edits).max())
    pairs, at, near = np.unique((stretch + 1) * n_items + item, return_inverse=True, return_counts=True)

    def beside(step: int) -> np.ndarray:
        k = np.minimum(np.searchsorted(pairs, pairs + step * n_items), max(0, len(pairs) - 1))
        return np.where(pairs[k] == pairs + step * n_items, near[k], 0) if len(pairs) else near

    enough = (near + np.maximum(beside(-1), beside(1)))[at] >= index.bound[item]
    item, position, entry = item[enough], position[enough], entry[enough]
    if not len(item):
        return
    starts = np.array([a for a, _ in spans])
    text = np.searchsorted(starts, position, side="right") - 1
    step = index.edits[item] + 1
    # Diagonals are counted from the text's start; an item may begin before it.
    diagonal = position - starts[text] - index.place[entry] + longest
    band = diagonal // step
    n_bands = int(band.max()) + 2
    # Every place of an item counts once in a band, however often its q-gram is repeated in the text.
    owner, at = np.unique((text * n_items + item) * n_bands + band, return_inverse=True)
    each = np.unique(at * longest + index.place[entry])
    counts = np.bincount(each // longest, minlength=len(owner))
    follows = np.zeros(len(owner), dtype=np.int64)
    follows[:-1] = np.where(owner[1:] == owner[:-1] + 1, counts[1:], 0)
    bands = np.stack([owner // n_bands // n_items, owner // n_bands % n_items, owner % n_bands], axis=1)
    open_ = bands[counts + follows >= index.bound[bands[:, 1]]]
    # Items of like length are aligned together.
    open_ = open_[np.argsort(index.sizes[open_[:, 1]], kind="stable")]
    for first in range(0, len(open_), ALIGN_AT_ONCE):
        some = [(int(t), int(i), int(b)) for t, i, b in open_[first : first + ALIGN_AT_ONCE]]
        diagonals = []
        for t, i, b in some:
            k = int(index.edits[i])
            on = spans[t][0] + b * (k + 1) - longest
            diagonals.append((on - k, on + 2 * (k + 1) - 1 + k))
        for (t, i, _), (edits, begin, end) in zip(some, align_many([index.texts[i] for _, i, _ in some], points, [spans[t] for t, *_ in some], diagonals)):
            if edits <= index.edits[i] and end > begin:
                yield t, i, begin, end, edits


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, list[str | None]]]:
    """Runs of texts of about ``CHUNK_POINTS`` code points, with the number of the first."""
    first, held, size = 0, [], 0
    for i, t in enumerate(texts):
        held.append(t)
        size += len(t or "")
        if size >= CHUNK_POINTS or len(held) >= 500:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held


def benchmark_blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple]]:
    """The items (item_id, text) in blocks of about ``block_chars`` characters, one at a time on the driver."""
    items = benchmark.select("item_id", "text")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-int(chars) // block_chars)
    for k in range(n):
        yield [tuple(r) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()]


def find_passages(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per benchmark item in a document (doc_id, text): where, and with how many edits."""
    spark = docs.sparkSession
    tune(spark)
    result = spark.createDataFrame([], MATCH_SCHEMA)
    for block in benchmark_blocks(benchmark):
        index = spark.sparkContext.broadcast(vars(Index(block)))

        def run(batches: Iterator[pd.DataFrame], shared=index) -> Iterator[pd.DataFrame]:
            known = Index.__new__(Index)
            known.__dict__.update(shared.value)
            for batch in batches:
                ids, rows = batch["doc_id"].astype("Int64"), []
                for first, texts in _chunks(list(batch["text"])):
                    for t, i, start, end, edits in matches_of(known, texts):
                        rows.append((ids.iloc[first + t], known.ids[i], start, end, edits))
                out = pd.DataFrame(rows, columns=["doc_id", "item_id", "start", "end", "edits"])
                yield out.astype({"doc_id": "Int64", "item_id": "Int64"})

        result = result.unionByName(docs.select("doc_id", "text").mapInPandas(run, MATCH_SCHEMA))
    return result


def _clean_texts(shared):
    """A predicate on texts in which no item of a broadcast index is found."""

    @F.pandas_udf("boolean")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = Index.__new__(Index)
        known.__dict__.update(shared.value)
        for batch in batches:
            ok = np.ones(len(batch), dtype=bool)
            for first, texts in _chunks(list(batch)):
                for t, *_ in matches_of(known, texts):
                    ok[first + t] = False
            yield pd.Series(ok)

    return clean


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no benchmark item is found, with all their columns; one pass per benchmark block."""
    spark = docs.sparkSession
    tune(spark)
    for block in benchmark_blocks(benchmark):
        docs = docs.where(_clean_texts(spark.sparkContext.broadcast(vars(Index(block))))(F.col("text")))
    return docs
