"""Language-model scores by online logistic context mixing, with counts of the whole corpus.

A token is a word or the end of a text. Contexts are hashed: the token before, and the two tokens before. What
follows a context in the training texts makes it a candidate for the next token: the class (a part of the
hash) that most often follows it. Whether the candidate comes true is one bit, and if not, whether any other class
that followed the context does is a second one, asked first of the longer context
and then of the shorter one. Several predictors give log odds for that bit: the counts of its own context, what the
other context says of the same class, how often such bits came true so far in this text, and the class's
share of all tokens. A mixer adds them with weights chosen by a gate (which context, how often seen, how pure,
whether the other context agrees); the weights start from values fitted on all training texts and are refined after
every few bits by the gradient of the coding cost, through to the end of the text. The token itself then
costs what its class's share of the other followers and its own share of the class say, or its share of all that wasn't ruled out; words that training texts lack are
an escape and letters, by the letters before. The sum over all tokens is the text's probability; divided by
its bytes it gives bits per byte.

The counts of contexts and words are tables distributed by hash, gathered from every training text, so the model
grows with the corpus. A task handles its texts in flushes: it sends the distinct (context, class) pairs of a
flush, counted, to their ranges of hashes, and gets back what all flushes together know of those contexts.
A training text is scored by what others know: each context's and word's own occurrence is taken out of its
counts. Of fixed size are only the masses of the classes, the letter tables and the mixer's weights.

Defined cases: a null text is empty and has the end token alone; a null id is learned from; rows that repeat an
id are separate texts, learned from as often as they stand there; a text of any length is in one flush;
extra columns are ignored; without training texts every word is spelled; an empty table gives an empty result.
``docs`` is read twice and must give the same rows in the same order within its partitions, as files do.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WordStream, doc_crc, drop_materialised, materialise, mix64, pack_sorted, release, text_runs, trim, tune, unpack_sorted

#: Bits of a class, and the bounds of the bits of a context's hash; together they are at most one 64-bit value.
CLASS_BITS, LEAST_BITS, MOST_BITS = 20, 32, 44
#: Bits of a context's hash beyond those that number the bytes of all texts: how rarely contexts meet by chance.
SPARE_BITS = 6
ORDERS = 2
#: A candidate is asked about if its context was seen at most so many times as often.
LEAST_PART = 16
PREDICTORS = 5
#: Inputs that are sent; what came true so far follows from the bits, and the last input is always 1.
SENT, SO_FAR = [0, 1, 3], 2
#: Kinds of bits: whether the candidate of the longer or shorter context comes true, whether another follower of it does.
KINDS = 2 * ORDERS
#: Gates: kind, times seen (1, 2 to 3, more), pure or not, the other context (unknown, disagrees, agrees).
GATES = KINDS * 3 * 2 * 3
#: Bits between two refinements of a text's weights, and their rate.
STEP, RATE = 64, 0.02
#: Steps of an input's unit; inputs are sent as signed bytes.
SCALE = 16
#: Bytes of text of a flush, and ranges of hashes that a task answers one after the other.
FLUSH_BYTES, RANGES = 2 << 20, 2
#: Texts of more bytes meet their answers in two parts, one after the other, so that only one is on its way at a time.
PART_BYTES = 64 << 20
#: Rows of the letter tables for two and three letters before; a power of two.
LETTER_ROWS = 1 << 12
#: Counters of a letter table that travel together, and the most pieces of a table.
LETTER_PIECE, LETTER_PIECES = 1 << 13, 1000
#: What each follower of a shorter context gives to be shared.
DISCOUNT = 0.75
#: Steps of a bit in which it is sent how much of all tokens the followers of a context leave.
ROOM_STEPS = 16
#: A probability is never closer to 0 or 1 than this.
FLOOR = 1e-5
START = (0.8, 0.2, 0.2, 0.05, 0.0)
#: What the followers of a context leave of all tokens at most, and have of them at most, by the steps that are sent.
_ROOM = 2.0 ** (-np.arange(256) / ROOM_STEPS)
_HELD = np.append(1 - 2.0 ** (-np.arange(1, 255) / ROOM_STEPS), [1.0, 1.0])

ASK_SCHEMA = "bucket int, kind int, flush long, keys binary, counts binary, ask binary"
REPLY_SCHEMA = "flush long, kind int, bucket int, known binary, counts binary, classes binary, pairs binary, stats binary"
PART_SCHEMA = "flush long, kind int, bucket int, known binary, counts binary, classes binary, pairs binary"
FEATURE_SCHEMA = "texts binary, bits binary, gates binary, inputs binary, weights array<double>, n_bits long"
SCORE_SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
_TEXT = np.dtype([("id", "<i8"), ("has_id", "?"), ("held", "?"), ("n_tokens", "<i8"), ("n_known", "<i8"), ("base", "<f8"), ("rest", "<f8"), ("n_bytes", "<i8"), ("n_bits", "<i8")])
_MIX, _ONE = np.uint64(0x9E3779B97F4A7C15), np.uint64(1)
_CLASS = np.uint64(CLASS_BITS)
#: The hash of the end of a text, and what stands before the first token.
END, BEGIN = np.uint64(0x8C5A27F36D1E94B1), np.uint64(0x51F3C2A98B7604ED)


def held_out() -> Column:
    """Whether a text must not be learned from; false for a null id."""
    return F.coalesce(doc_crc() % 10 == 0, F.lit(False))


def pack_counts(counts: np.ndarray) -> bytes:
    """Counts as one byte each, and in full where that is not enough."""
    large = counts[counts >= 255]
    return struct.pack("<Q", len(counts)) + np.minimum(counts, 255).astype(np.uint8).tobytes() + large.astype("<i8").tobytes()


def unpack_counts(data: bytes) -> np.ndarray:
    (n,) = struct.unpack_from("<Q", data)
    out = np.frombuffer(data, np.uint8, count=n, offset=8).astype(np.int64)
    out[out == 255] = np.frombuffer(data, "<i8", offset=8 + n)
    return out


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<double>": pa.list_(pa.float64())}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


class Tokens:
    """The tokens of some texts in a row: hashes, classes, hashed contexts of each order; ``sizes`` counts tokens of each text."""

    def __init__(self, stream: WordStream):
        self.stream, self.sizes = stream, stream.counts + 1
        ends = np.cumsum(self.sizes)
        self.firsts = ends - self.sizes
        self.is_word = np.ones(int(self.sizes.sum()), dtype=bool)
        self.is_word[ends - 1] = False
        self.hashes = np.full(len(self.is_word), END, dtype=np.uint64)
        self.hashes[self.is_word] = stream.hashes
        self.text = np.repeat(np.arange(len(self.sizes)), self.sizes)

    def classes(self) -> np.ndarray:
        return self.hashes >> np.uint64(64 - CLASS_BITS)

    def contexts(self, order: int, bits: int) -> np.ndarray:
        before, spare = self._shifted(self.hashes), np.uint64(64 - bits)
        if order == 1:
            return mix64(before * _MIX + _ONE) >> spare
        return mix64(mix64(before * _MIX + np.uint64(2)) + self._shifted(before)) >> spare

    def pairs(self, order: int, bits: int) -> np.ndarray:
        """Each token's context of one order, and behind it its class."""
        return (self.contexts(order, bits) << _CLASS) | self.classes()

    def _shifted(self, values: np.ndarray) -> np.ndarray:
        out = np.empty_like(values)
        out[1:] = values[:-1]
        out[self.firsts] = BEGIN
        return out

    def letters(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of some words, each with a space after it, in a row; bytes of each)."""
        at = (np.cumsum(self.is_word) - 1)[tokens]
        starts = self.stream.starts[at]
        lengths = self.stream.ends[at] - starts + 1
        ends = np.cumsum(lengths)
        out = np.append(self.stream.data, np.uint8(32))[np.arange(int(lengths.sum())) + np.repeat(starts - (ends - lengths), lengths)]
        out[ends - 1] = 32
        return out, lengths


def letter_rows(letters: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
    """Of every letter the row in each letter table: by the letter before, the two before, the three before."""
    inside = np.arange(len(letters)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    h, rows = np.zeros(len(letters), dtype=np.uint64), []
    for back in (1, 2, 3):
        before = np.zeros(len(letters), dtype=np.uint64)
        before[back:] = letters[:-back]
        h = h * np.uint64(257) + np.where(inside >= back, before, 0).astype(np.uint64)
        rows.append(h.astype(np.int64) if back == 1 else (mix64(h * _MIX) & np.uint64(LETTER_ROWS - 1)).astype(np.int64))
    return rows


def _flushes(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """(number, texts) of each flush of a task's texts; the same however often the task runs."""
    begin = TaskContext.get().partitionId() << 32
    for k, batch in enumerate(text_runs(batches, size)):
        yield begin + k, batch
        trim()


def _firsts(values: np.ndarray) -> np.ndarray:
    """Whether each of ascending values differs from the one before."""
    first = np.ones(len(values), dtype=bool)
    np.not_equal(values[1:], values[:-1], out=first[1:])
    return first


def _counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in ascending order, and how often each occurs."""
    values = np.sort(values)
    first = np.flatnonzero(_firsts(values))
    return values[first], np.diff(np.append(first, len(values)))


def _cuts(values: np.ndarray, n: int, bits: int, shift: int = 0) -> np.ndarray:
    """Where each of ``n`` ranges of ``bits``-bit numbers begins in ascending values that are those numbers, shifted."""
    bounds = np.array([-(-(b << bits) // n) << shift for b in range(1, n)], dtype=np.uint64)
    return np.concatenate([[0], np.searchsorted(values, bounds), [len(values)]])


def context_bits(size: int) -> int:
    """Bits of a context's hash for texts of ``size`` bytes: they grow with the corpus."""
    return min(MOST_BITS, max(LEAST_BITS, int(size).bit_length() + SPARE_BITS))


def _ask(batches: Iterator[pa.RecordBatch], n: int, bits: int, size: int, kinds: tuple[int, ...]) -> Iterator[pa.RecordBatch]:
    """The counted words (kind 0) and pairs of every flush, and the words and pairs that its held-out texts ask about."""
    tables = [np.zeros(256 * (256 if back == 0 else LETTER_ROWS), dtype=np.uint32) for back in range(3)] if 0 in kinds else []
    for flush, batch in _flushes(batches, size):
        tokens = Tokens(WordStream(batch.column("text")))
        learned = ~batch.column("held_out").to_numpy(zero_copy_only=False)[tokens.text]
        rows = []
        for kind in kinds:
            if kind:
                pairs = tokens.pairs(kind, bits)
                keys, counts = _counted(pairs[learned])
                ask = _counted(pairs[~learned])[0]
                a, b = _cuts(keys, n, bits, CLASS_BITS), _cuts(ask, n, bits, CLASS_BITS)
            else:
                at = np.flatnonzero(learned)
                order = np.argsort(tokens.hashes[at])
                keys = tokens.hashes[at[order]]
                first = np.flatnonzero(_firsts(keys))
                keys, counts = keys[first], np.diff(np.append(first, len(keys)))
                single = np.sort(at[order[first[counts == 1]]])
                del at, order, first
                ask = _counted(tokens.hashes[~learned])[0]
                a, b = _cuts(keys, n, 64), _cuts(ask, n, 64)
            for k in range(n):
                if a[k] < a[k + 1] or b[k] < b[k + 1]:
                    rows.append((k, kind, flush, pack_sorted(keys[a[k] : a[k + 1]]), pack_counts(counts[a[k] : a[k + 1]]), pack_sorted(ask[b[k] : b[k + 1]])))
        yield _batch(ASK_SCHEMA, rows)
        if 0 not in kinds:
            continue
        # Words that a flush has once stand for those still unknown: the letter tables learn from them.
        letters, lengths = tokens.letters(single[tokens.is_word[single]])
        for table, row in zip(tables, letter_rows(letters, lengths)):
            table += np.bincount(row * 256 + letters, minlength=len(table)).astype(np.uint32)
    # A task adds its letters up and deals the tables out in pieces.
    rows = []
    for back, table in enumerate(tables):
        for piece, part in enumerate(table.reshape(-1, LETTER_PIECE)):
            if part.any():
                number = back * LETTER_PIECES + piece
                rows.append((number % n, -1, number, None, zlib.compress(part.astype("<u4").tobytes(), 1), None))
    yield _batch(ASK_SCHEMA, rows)


def _answer(kind: int, bucket: int, rows: list[tuple], masses: np.ndarray | None = None) -> Iterator[tuple]:
    """What each flush gets back on its words or contexts in one range; with the classes' masses also what all followers of a context have of them."""
    if kind < 0:
        sums: dict[int, np.ndarray] = {}
        for r in rows:
            part = np.frombuffer(zlib.decompress(r[4]), "<u4")
            sums[r[2]] = sums[r[2]] + part if r[2] in sums else part.astype(np.int64)
        for number, total in sums.items():
            yield (None, -1, number, None, None, None, None, zlib.compress(total.astype("<i8").tobytes(), 1))
        return
    # Counted keys of all flushes, then the keys that held-out texts ask about, which count nothing.
    keys, asks = [unpack_sorted(r[3]) for r in rows], [unpack_sorted(r[5]) for r in rows]
    flush = np.repeat(np.tile(np.arange(len(rows)), 2), [len(k) for k in [*keys, *asks]])
    flat = np.concatenate([*keys, *asks])
    n_counted = sum(map(len, keys))
    del keys, asks
    order = np.argsort(flat)
    flat = flat[order]
    new = _firsts(flat)
    place = np.empty(len(flat), dtype=np.int64)
    place[order] = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    times = np.zeros(len(flat), dtype=np.int64)
    times[:n_counted] = np.concatenate([unpack_counts(r[4]) for r in rows])
    times = np.add.reduceat(times[order], first) if len(first) else times
    flat = flat[first]
    del order, first, new
    # The keys of every flush, one flush after the other, as places among all keys.
    mine = np.sort((flush << 32) | place)
    mine = mine[_firsts(mine)]
    flush_of, at = mine >> 32, mine & 0xFFFFFFFF
    del mine
    flushes = np.arange(len(rows) + 1)
    if kind == 0:
        found, cuts = times[at], np.searchsorted(flush_of, flushes)
        for r, a, b in zip(rows, cuts[:-1], cuts[1:]):
            yield (r[2], 0, bucket, None, pack_counts(found[a:b]), None, None, None)
        learned = np.flatnonzero(times)
        times, classes = times[learned], (flat[learned] >> np.uint64(64 - CLASS_BITS)).astype(np.int64)
        low = int(classes[0]) if len(classes) else 0
        masses = np.bincount(classes - low, weights=times).astype("<i8")
        yield (None, 0, bucket, None, None, None, None, struct.pack("<QQQQ", int(times.sum()), len(times), int((times == 1).sum()), low) + masses.tobytes())
        return
    classes = (flat & np.uint64((1 << CLASS_BITS) - 1)).astype(np.int64)
    new = _firsts(flat >> _CLASS)
    first, context = np.flatnonzero(new), np.cumsum(new) - 1
    is_best = is_second = np.zeros(0, dtype=bool)
    total = kinds = room = best = second = np.zeros(0, dtype=np.int64)
    if len(first):
        total, kinds = np.add.reduceat(times, first), np.add.reduceat(times > 0, first, dtype=np.int64)
        ranked = (np.minimum(times, (1 << 40) - 1) << CLASS_BITS) | classes
        best = np.maximum.reduceat(ranked, first)
        is_best = ranked == best[context]
        ranked[is_best] = 0
        second = np.maximum.reduceat(ranked, first)
        # Without one occurrence of its own, a token can only prefer the second class if both were equally frequent.
        second[second >> CLASS_BITS != best >> CLASS_BITS] = 0
        is_second = (ranked == second[context]) & (second[context] > 0)
        room = np.zeros(len(first), np.int64)
        if masses is not None:
            # Sixteenths of a bit by which the rest of all tokens is rarer; rounded so that the rest is never taken for too small.
            ruled = np.add.reduceat(np.where(times > 0, masses[classes], 0), first)
            room = np.minimum(254, np.floor(-ROOM_STEPS * np.log2(np.maximum(FLOOR, 1 - ruled / max(1.0, masses.sum()))))).astype(np.int64)
    # The contexts of every flush, and those that its held-out texts ask about.
    of = context[at]
    new = _firsts((flush_of << 32) | of)
    starts, number = np.flatnonzero(new), np.cumsum(new) - 1
    asked, asker = of[starts], flush_of[starts]
    # What only this flush has seen once can't help it.
    known = total[asked] > 1
    ask = np.searchsorted((asker << 32) | asked, (flush[n_counted:] << 32) | context[place[n_counted:]])
    known[ask] |= total[asked[ask]] > 0
    del flush, place, ask
    # A candidate is named by its place among the followers that the flush meets, or in full if it isn't there.
    ranks = []
    for role in (is_best, is_second):
        rank, there = np.full(len(starts), 255), np.flatnonzero(role[at])
        rank[number[there]] = np.minimum(255, there - starts[number[there]])
        ranks.append(rank.astype(np.uint8))
    # Of every follower that a flush meets, and not of the most frequent one alone, it learns how often it follows; once is what all of an unknown context do.
    met = np.flatnonzero(known[number])
    follows, met_cuts = times[at[met]], np.searchsorted(flush_of[met], flushes)
    del met, at, of, number, starts
    asked_cuts, to = np.searchsorted(asker, flushes), np.flatnonzero(known)
    cuts, c = np.searchsorted(asker[to], flushes), asked[to]
    counts = np.stack([total[c], best[c] >> CLASS_BITS, second[c] >> CLASS_BITS, kinds[c], room[c]])
    # One compressor for all: a new one for each small message would cost more than the work.
    squeeze = zstandard.ZstdCompressor(level=1).compress
    for k, r in enumerate(rows):
        a, b = cuts[k : k + 2]
        tied = np.flatnonzero(counts[2, a:b]) + a
        rank = np.concatenate([ranks[0][to[a:b]], ranks[1][to[tied]]])
        wide = np.concatenate([best[c[a:b]], second[c[tied]]])[rank == 255] & ((1 << CLASS_BITS) - 1)
        names = squeeze(rank.tobytes())
        names = struct.pack("<I", len(names)) + names + wide.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].tobytes()
        there = squeeze(np.packbits(known[asked_cuts[k] : asked_cuts[k + 1]]).tobytes())
        yield (r[2], kind, bucket, there, squeeze(pack_counts(counts[:, a:b].ravel())), names, squeeze(pack_counts(follows[met_cuts[k] : met_cuts[k + 1]])), None)


class Model:
    """What is known beside the contexts: totals, class masses, letter tables."""

    def __init__(self, replies: DataFrame):
        self.total = self.distinct = self.once = 0
        self.masses = np.zeros(1 << CLASS_BITS, dtype=np.float64)
        tables = [np.zeros((256 if back == 0 else LETTER_ROWS, 256), dtype=np.int64) for back in range(3)]
        for kind, bucket, data in replies.where(F.col("stats").isNotNull()).select("kind", "bucket", "stats").toLocalIterator():
            if kind < 0:
                back, piece = divmod(bucket, LETTER_PIECES)
                tables[back].reshape(-1, LETTER_PIECE)[piece] = np.frombuffer(zlib.decompress(data), "<i8")
                continue
            total, distinct, once, low = struct.unpack_from("<QQQQ", data)
            self.total, self.distinct, self.once = self.total + total, self.distinct + distinct, self.once + once
            masses = np.frombuffer(data, "<i8", offset=32)
            self.masses[low : low + len(masses)] += masses
        self.letters = [(t / np.maximum(1, t.sum(axis=1, keepdims=True))).astype(np.float32) for t in tables]
        self.trust = [(t.sum(axis=1) / (t.sum(axis=1) + 16.0)).astype(np.float32) for t in tables]
        self.escape = (self.once + 1.0) / (self.total + 2.0)

    @cached_property
    def odds(self) -> np.ndarray:
        """Inputs of what share of all tokens each class has: a row with no token taken out, and one with one."""
        totals = np.maximum(1.0, np.array([[self.total], [self.total - 1.0]]))
        mass = np.minimum(self.masses, totals - 0.5)
        return _unit(_odds(mass, totals - mass))

    def spelled(self, letters: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Bits that each of some words costs by its letters."""
        chance = np.full(len(letters), 1 / 256)
        for table, trust, row in zip(self.letters, self.trust, letter_rows(letters, lengths)):
            chance = trust[row] * table[row, letters] + (1 - trust[row]) * chance
        return np.add.reduceat(-np.log2(chance), np.cumsum(lengths) - lengths) if len(lengths) else np.zeros(0)


def _ranks(ranked: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which of the distinct values each value is, the distinct ones), from the values in ascending order and where they stood."""
    new = _firsts(ranked)
    number = np.empty(len(order), dtype=np.int32)
    number[order] = np.cumsum(new, dtype=np.int32) - 1
    return number, ranked[new]


class Candidates:
    """For every token what its context of one order knows: the candidate, times it followed and times the context was seen; followers, and times the token's own class followed."""

    def __init__(self, pairs: np.ndarray, own: np.ndarray, answers: list[tuple], n: int, bits: int):
        """``own`` is 1 for tokens whose own occurrence is among the counts; ``answers`` are those of some of ``n`` ranges."""
        order = np.argsort(pairs)
        pair, distinct = _ranks(pairs.take(order), order)
        del order
        follower = (distinct & np.uint64((1 << CLASS_BITS) - 1)).astype(np.int32)
        distinct >>= _CLASS
        new = _firsts(distinct)
        of_pair, starts, distinct = np.cumsum(new, dtype=np.int32) - 1, np.flatnonzero(new), distinct[new]
        known, cuts = np.zeros(len(distinct), dtype=bool), _cuts(distinct, n, bits)
        counts, ranks, wides, follows = [np.zeros((5, 0), np.int64)], [], [], [np.zeros(0, np.int64)]
        expand = zstandard.ZstdDecompressor().decompress
        for bucket, there, numbers, names, followed in answers:
            low, high = cuts[bucket : bucket + 2]
            known[low:high] = np.unpackbits(np.frombuffer(expand(there), np.uint8), count=high - low).view(bool)
            counts.append(unpack_counts(expand(numbers)).reshape(5, -1))
            (cut,) = struct.unpack_from("<I", names)
            ranks.append(np.frombuffer(expand(names[4 : 4 + cut]), np.uint8))
            wides.append(names[4 + cut :])
            follows.append(unpack_counts(expand(followed)))
        sizes = [c.shape[1] for c in counts[1:]]
        counts, follows = np.concatenate(counts, axis=1), np.concatenate(follows)
        # Half the width does for all but huge counts.
        kind = np.int32 if counts.max(initial=0) < 1 << 26 else np.int64
        tied, here = counts[2] > 0, starts[known]
        first, second = np.full(len(here), 255, dtype=np.int32), np.full(len(here), 255, dtype=np.int32)
        if ranks:
            first[:] = np.concatenate([r[:k] for r, k in zip(ranks, sizes)])
            second[tied] = np.concatenate([r[k:] for r, k in zip(ranks, sizes)])
        # In full stand those names, by range, that aren't among the followers met here.
        wide = np.zeros((sum(map(len, wides)) // 3, 4), dtype=np.uint8)
        wide[:, :3] = np.frombuffer(b"".join(wides), np.uint8).reshape(-1, 3)
        absent = np.concatenate([first == 255, tied & (second == 255)])
        part = np.tile(np.repeat(np.arange(len(sizes)), sizes), 2)
        at = np.flatnonzero(absent)
        named = np.empty(len(absent), dtype=np.int32)
        named[at[np.argsort(part[at], kind="stable")]] = wide.view("<u4").ravel()
        near = ~absent[: len(here)]
        first[near] = follower[here[near] + first[near]]
        first[~near] = named[: len(here)][~near]
        near = tied & (second < 255)
        second[near] = follower[here[near] + second[near]]
        second[tied & ~near] = named[len(here) :][tied & ~near]
        second[~tied] = -1
        # Contexts in which nothing is known share the first row.
        row = np.where(known, np.cumsum(known, dtype=np.int32), 0)[of_pair].take(pair)
        total, n_first, n_second, kinds, self._room = (np.append(0, c).astype(t).take(row) for c, t in zip(counts, [kind, kind, kind, kind, np.uint8]))
        self.first, self.second = (np.append(np.int32(-1), c).take(row) for c in (first, second))
        followed = np.zeros(len(of_pair), dtype=kind)
        followed[known[of_pair]] = follows
        followed = followed.take(pair)
        classes = (pairs & np.uint64((1 << CLASS_BITS) - 1)).astype(np.int32)
        own = own.astype(kind)
        self.total = np.maximum(0, total - own)
        self.n_first, self.n_second = n_first - own * (self.first == classes), n_second - own * (self.second == classes)
        better = self.n_second > self.n_first
        self.name, self.times = np.where(better, self.second, self.first), np.where(better, self.n_second, self.n_first)
        self.asked = (self.times > 0) & (self.times * LEAST_PART >= self.total)
        self.total = np.maximum(self.total, self.times)
        #: The token's own occurrence is the only one of its class here.
        self.alone = (own > 0) & (followed == 1)
        # Followers beside the candidate, if that is asked about: how many, how often they came, and how often the token's own class did.
        self.left = self.total - self.times * self.asked
        self.kinds = np.minimum(self.left, np.maximum(0, kinds - self.alone - self.asked))
        self.follows = np.maximum(0, followed - own)

    @property
    def room(self) -> np.ndarray:
        """What is left of all tokens without the followers, as a share and at most; a class whose only occurrence here is the token's own is none."""
        return _ROOM.take(self._room)

    @property
    def held(self) -> np.ndarray:
        """What the followers have of all tokens, as a share and at most."""
        return _HELD.take(self._room)

    def view_of(self, name: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Times that a class followed the contexts of some tokens, as far as it is known."""
        return np.where(self.first[at] == name, self.n_first[at], np.where(self.second[at] == name, self.n_second[at], 0))


def _odds(yes: np.ndarray, no: np.ndarray, prior: float = 0.4) -> np.ndarray:
    return np.log(((yes + prior) / (no + 0.4)).astype(np.float32))


def _unit(odds: np.ndarray) -> np.ndarray:
    """Log odds as they are sent, in steps."""
    return np.clip(np.rint(SCALE * odds), -127, 127).astype(np.int8)


def _so_far(hit: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Log odds, in steps, of the bits that stand before each bit in its text."""
    ones = np.cumsum(hit, dtype=np.int32) - hit
    first = np.flatnonzero(_firsts(text))
    runs = np.diff(np.append(first, len(text)))
    ones -= np.repeat(ones[first], runs)
    return _unit(_odds(ones, np.arange(len(text), dtype=np.int32) - np.repeat(first.astype(np.int32), runs) - ones))


def decisions(tokens: Tokens, learned: np.ndarray, count: np.ndarray, found: list[Candidates], model: Model, followers: bool) -> tuple[np.ndarray, ...]:
    """(bits, gates, inputs, texts' numbers of bits, texts' remaining cost, and by gate the bits, gates and whether they may be learned from).

    ``count`` is each token's count in the training texts, ``found`` the candidates of the first and second order;
    without ``followers`` only candidates are asked about. Inputs are a row for each predictor but the last and are in the order of the gates, those of one gate in that of the texts.
    """
    classes = tokens.classes().astype(np.int32)
    left, total = count - learned, np.where(learned, max(1.0, model.total - 1.0), max(1.0, model.total))
    known = left > 0
    one, two = found
    hit_two = two.asked & known & (two.name == classes)
    other_two = (two.left > 0) & ~hit_two & followers
    met_two = other_two & known & (two.follows > 0)
    ask_one = one.asked & ~hit_two & ~met_two & ~(two.asked & (one.name == two.name))
    hit_one = ask_one & known & (one.name == classes)
    # Followers of the longer context follow the shorter one as well, at least as often, and are ruled out by now.
    left_one = np.minimum(one.left, one.total - two.total)
    other_one = (left_one > 0) & ~hit_two & ~met_two & ~hit_one & followers
    # A class that the longer context ruled out isn't met.
    met_one = other_one & known & (one.follows > 0) & ~(one.asked & (one.name == classes))
    rest = np.zeros(len(classes))
    hit = hit_one | hit_two | met_one | met_two
    at = np.flatnonzero(hit)
    rest[at] = -np.log2(left[at] / np.maximum(left[at], model.masses[classes[at]] - learned[at]))
    at = np.flatnonzero(met_two)
    rest[at] -= np.log2(np.minimum(two.follows[at], two.left[at]) / two.left[at])
    # Followers of the shorter context give a part of what they came to all of them, to be shared by how frequent they are anyway.
    kinds_one = np.clip(one.kinds - two.kinds - two.asked, 0, left_one.clip(0))
    at = np.flatnonzero(met_one)
    general = (model.masses[classes[at]] - learned[at]).clip(0) / total[at] / one.held[at]
    rest[at] -= np.log2(np.minimum(left_one[at], one.follows[at] - DISCOUNT + DISCOUNT * kinds_one[at] * general) / left_one[at])
    # What was asked and missed is ruled out, so the rest shares its mass.
    missed = np.zeros(len(classes))
    for asked, c in ((two.asked, two), (ask_one, one)):
        at = np.flatnonzero(asked & ~hit)
        missed[at] += model.masses[c.name[at]] / total[at]
    at = np.flatnonzero(other_one & ~hit)
    missed[at] = np.maximum(missed[at], 1 - one.room[at] - np.where(one.alone[at], model.masses[classes[at]] / total[at], 0.0))
    at = np.flatnonzero(known & ~hit)
    rest[at] = np.log2(np.maximum(FLOOR, 1 - (1 - model.escape) * missed[at])) - np.log2((1 - model.escape) * left[at] / total[at])
    at = np.flatnonzero(~known)
    rest[at] = np.log2(np.maximum(FLOOR, 1 - (1 - model.escape) * missed[at])) - np.log2(model.escape)
    new = at[tokens.is_word[at]]
    rest[new] += model.spelled(*tokens.letters(new))
    # Of every token four bits may be asked, in this order.
    asked = np.stack([two.asked, other_two, ask_one, other_one], axis=1)
    values = np.stack([hit_two, met_two, hit_one, met_one], axis=1)
    gates = np.zeros(asked.shape, dtype=np.uint8)
    by_gate = []
    for kind, (slot, c, other) in enumerate(((0, two, one), (2, one, two))):
        at = np.flatnonzero(asked[:, slot])
        name, seen, times, bit = c.name[at], c.total[at], c.times[at], values[at, slot]
        other_seen = other.total[at]
        agreed = np.minimum(other.view_of(name, at), other_seen)
        x = [_unit(_odds(times, seen - times)), _unit(np.where(other_seen > 0, _odds(agreed, other_seen - agreed, 0.2), 0)), _so_far(bit, tokens.text[at]), model.odds[learned[at].view(np.int8), name]]
        gate = ((kind * 3 + (seen > 1).astype(np.uint8) + (seen > 3)) * 2 + (times == seen)) * 3 + (other_seen > 0) * (1 + (agreed > 0).astype(np.uint8))
        gates[at, slot] = gate
        by_gate.append((at, bit, gate, x))
    for kind, (slot, c, other, left_of, kinds_of) in enumerate(((1, two, one, two.left, two.kinds), (3, one, two, left_one, kinds_one)), ORDERS):
        at = np.flatnonzero(asked[:, slot])
        left, kinds, other_left, other_kinds, bit = left_of[at], kinds_of[at], other.left[at], other.kinds[at], values[at, slot]
        # Contexts whose followers come again and again rarely meet a new one.
        x = [_unit(_odds(left, kinds)), _unit(np.where(other_left > 0, _odds(other_left, other_kinds, 0.2), 0)), _so_far(bit, tokens.text[at]), _unit(_odds(left, 1.0))]
        gate = ((kind * 3 + (left > 1).astype(np.uint8) + (left > 3)) * 2 + (kinds == left)) * 3 + (other_left > 0) * (1 + (other_left > other_kinds).astype(np.uint8))
        gates[at, slot] = gate
        by_gate.append((at, bit, gate, x))
    columns: list[list[np.ndarray]] = []
    for at, bit, gate, x in by_gate:
        order = np.argsort(gate.astype(np.uint8), kind="stable")
        columns.append([v[order] for v in (*x, bit, gate.astype(np.uint8), learned[at])])
    *inputs, bit, gate, use = (np.concatenate(c) for c in zip(*columns))
    cost = np.bincount(tokens.text, weights=rest, minlength=len(tokens.sizes))
    n_bits = np.bincount(tokens.text, weights=asked.sum(axis=1, dtype=np.uint8), minlength=len(tokens.sizes)).astype(np.int64)
    return values[asked], gates[asked], np.stack(inputs), n_bits, cost, bit, gate, use


def pack_inputs(inputs: np.ndarray) -> bytes:
    """The inputs that are sent, by gate; those of one gate are much alike."""
    return zstandard.compress(inputs[SENT].tobytes(), 1)


def unpack_inputs(data: bytes, bit: np.ndarray, gate: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Rows of inputs for the mixer, in the order of the texts, with those that weren't sent."""
    order = np.argsort(gate, kind="stable")
    x = np.ones((len(gate), PREDICTORS), dtype=np.float32)
    for k, column in zip(SENT, np.frombuffer(zstandard.decompress(data), np.int8).reshape(len(SENT), -1)):
        x[order, k] = column / np.float32(SCALE)
    kinds = gate // np.uint8(GATES // KINDS)
    for kind in range(KINDS):
        mine = np.flatnonzero(kinds == kind)
        x[mine, SO_FAR] = _so_far(bit[mine], text[mine]) / np.float32(SCALE)
    return x


def fit_weights(bit: np.ndarray, gate: np.ndarray, inputs: np.ndarray) -> np.ndarray:
    """Weights by gate after one pass over some bits, which are in the order of their gates, from fixed ones."""
    weights = np.tile(np.array(START), (GATES, 1))
    squares = np.ones(weights.shape)
    n = max(1, len(bit) // 8192)
    # Every n-th bit is a step, so each step has bits of all texts and of all gates that have enough.
    for k in range(n if len(bit) else 0):
        g = gate[k::n]
        x = np.ones((PREDICTORS, len(g)), dtype=np.float32)
        np.divide(inputs[:, k::n], np.float32(SCALE), out=x[:-1])
        first = np.flatnonzero(_firsts(g))
        there = g[first]
        w = np.repeat(weights[there].T.astype(np.float32), np.diff(np.append(first, len(g))), axis=1)
        p = 1 / (1 + np.exp(-np.clip(np.einsum("ij,ij->j", x, w), -30, 30)))
        step = np.add.reduceat((p - bit[k::n]) * x, first, axis=1, dtype=np.float64).T
        squares[there] += step * step
        weights[there] -= 0.1 * step / np.sqrt(squares[there])
    return weights


def mix(bit: np.ndarray, gate: np.ndarray, inputs: np.ndarray, text: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Cost in bits of every bit, from its gate and the predictors' log odds (a row per bit); ``text`` is non-decreasing.

    All texts are mixed side by side; each has its own weights and refines them after each step, to its end.
    """
    n = len(bit)
    if not n:
        return np.zeros(0)
    new = np.concatenate([[True], text[1:] != text[:-1]])
    heads, number = np.flatnonzero(new), np.cumsum(new) - 1
    lengths = np.diff(np.append(heads, n))
    step = (np.arange(n) - heads[number]) // STEP
    # Longer texts come first, so those that a step concerns are the first ones.
    steps_of = -(-lengths // STEP)
    rank = np.empty_like(steps_of)
    rank[np.argsort(-steps_of, kind="stable")] = np.arange(len(steps_of))
    active = len(steps_of) - np.searchsorted(np.sort(steps_of), np.arange(int(step.max()) + 1), side="right")
    # Bits of one step of all texts lie together.
    order = np.argsort(step, kind="stable")
    cuts = np.searchsorted(step[order], np.arange(int(step.max()) + 2))
    row, x, y = (rank[number] * GATES + gate)[order], inputs[order], bit[order].astype(np.float32)
    weights = np.tile(start.astype(np.float32), (len(heads), 1))
    chance = np.empty(n, dtype=np.float32)
    for a, z, live in zip(cuts[:-1], cuts[1:], active * GATES):
        xs, at = x[a:z], row[a:z]
        p = 1 / (1 + np.exp(-np.einsum("ij,ij->i", xs, weights[at])))
        chance[a:z] = p
        # All of a step's errors are added up before its weights move.
        moves = (np.float32(RATE) * (y[a:z] - p))[:, None] * xs
        cells = at[:, None] * PREDICTORS + np.arange(PREDICTORS)
        weights[:live] += np.bincount(cells.ravel(), weights=moves.ravel(), minlength=live * PREDICTORS).reshape(-1, PREDICTORS)
    chance = np.clip(chance.astype(np.float64), FLOOR, 1 - FLOOR)
    cost = np.empty(n)
    cost[order] = -np.log2(np.where(y > 0, chance, 1 - chance))
    return cost


def _features(own_row: tuple, rows: list[tuple], model: Model, n: int, bits: int, followers: bool) -> tuple:
    """One row of features from the texts of a flush and the answers it got."""
    meta, offsets, data = own_row[3:6]
    tokens = Tokens(WordStream(pa.Array.from_buffers(pa.string(), len(offsets) // 4 - 1, [None, pa.py_buffer(offsets), pa.py_buffer(zstandard.decompress(data))])))
    meta = np.frombuffer(meta, dtype=_TEXT).copy()
    if len(meta) != len(tokens.sizes):
        raise RuntimeError("a flush came back with other texts than it was asked with")
    learned = ~meta["held"][tokens.text]
    order = np.argsort(tokens.hashes)
    number, distinct = _ranks(tokens.hashes.take(order), order)
    counts = np.concatenate([unpack_counts(r[4]) for r in rows if r[1] == 0])
    if len(counts) != len(distinct):
        raise RuntimeError("docs gave other rows when they were read again")
    del order, distinct
    count = counts.take(number)
    meta["n_tokens"] = tokens.sizes
    meta["n_known"] = np.bincount(tokens.text, weights=count > 0, minlength=len(meta))
    meta["base"] = np.bincount(tokens.text, weights=np.log10(counts + 0.1).take(number), minlength=len(meta))
    del number
    found = []
    for kind in range(1, ORDERS + 1):
        found.append(Candidates(tokens.pairs(kind, bits), learned, [r[2:7] for r in rows if r[1] == kind], n, bits))
    bit, gate, inputs, meta["n_bits"], meta["rest"], *sorted_bits, use = decisions(tokens, learned, count, found, model, followers)
    del found
    weights = fit_weights(*(v[use] for v in sorted_bits), inputs[:, use])
    return meta.tobytes(), np.packbits(bit).tobytes(), zstandard.compress(gate.tobytes(), 1), pack_inputs(inputs), weights.ravel().tolist(), int(use.sum())


def mixed(texts: bytes, bits: bytes, gates: bytes, inputs: bytes, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(account of the texts of a row of features, bits that each costs)."""
    meta, gate = np.frombuffer(texts, dtype=_TEXT), np.frombuffer(zstandard.decompress(gates), np.uint8)
    bit = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(gate)).view(bool)
    text = np.repeat(np.arange(len(meta), dtype=np.int32), meta["n_bits"])
    x = unpack_inputs(inputs, bit, gate, text)
    return meta, meta["rest"] + np.bincount(text, weights=mix(bit, gate, x, text, start), minlength=len(meta))


def _replies(source: DataFrame, n_tasks: int, bits: int, size: int, kinds: tuple[int, ...], masses: np.ndarray | None = None) -> DataFrame:
    """What every flush gets back on words or contexts, and with words the parts of the model that are of fixed size; written."""
    n = RANGES * n_tasks
    shared = source.sparkSession.sparkContext.broadcast(masses)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _ask(batches, n, bits, size, kinds)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def close() -> pa.RecordBatch:
            out = _batch(REPLY_SCHEMA, list(_answer(held[0][1], held[0][0], held, shared.value)))
            held.clear()
            trim()
            return out

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0][:2] != row[:2]:
                    yield close()
                held.append(row)
        if held:
            yield close()

    asked = source.mapInArrow(ask, ASK_SCHEMA).repartition(n_tasks, F.floor(F.col("bucket") / RANGES)).sortWithinPartitions("kind", "bucket", "flush")
    found = materialise(asked.mapInArrow(answer, REPLY_SCHEMA), "context-replies")
    shared.unpersist()
    return found


def _bits(source: DataFrame, replies: DataFrame, model: Model, n_tasks: int, bits: int, size: int, followers: bool, n_parts: int) -> DataFrame:
    """The second pass, written: texts and answers meet and give bits with their inputs."""
    shared = source.sparkSession.sparkContext.broadcast(model)
    n = RANGES * n_tasks

    def send(batches: Iterator[pa.RecordBatch], part: int) -> Iterator[pa.RecordBatch]:
        """The texts themselves, by flush; columns stand for an account of the texts, their offsets and their bytes."""
        for flush, batch in _flushes(batches, size):
            if flush % n_parts != part:
                continue
            texts = pc.fill_null(batch.column("text"), "")
            meta = np.zeros(len(texts), dtype=_TEXT)
            ids = batch.column("doc_id").cast(pa.int64())
            meta["id"], meta["has_id"], meta["held"] = pc.fill_null(ids, 0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False), batch.column("held_out").to_numpy(zero_copy_only=False)
            meta["n_bytes"] = pc.binary_length(texts).to_numpy()
            offsets = np.concatenate([[0], np.cumsum(meta["n_bytes"])]).astype(np.int32)
            _, at, data = texts.buffers()
            begin = int(np.frombuffer(at, np.int32)[texts.offset])
            data = data.slice(begin, int(offsets[-1])) if data is not None else b""
            yield _batch(PART_SCHEMA, [(flush, -1, -1, meta.tobytes(), offsets.tobytes(), zstandard.compress(data, 3), None)])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def close() -> pa.RecordBatch:
            out = _batch(FEATURE_SCHEMA, [_features(rows[0], rows[1:], shared.value, n, bits, followers)])
            rows.clear()
            trim()
            return out

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if rows and row[0] != rows[0][0]:
                    yield close()
                rows.append(row)
        if rows:
            yield close()

    found = None
    for k in range(n_parts):
        texts = source.mapInArrow(lambda batches, k=k: send(batches, k), PART_SCHEMA)
        answers = replies.where(F.col("stats").isNull() & (F.col("flush") % n_parts == k)).drop("stats")
        parts = texts.unionByName(answers).repartition(n_tasks, "flush").sortWithinPartitions("flush", "kind", "bucket")
        some = materialise(parts.mapInArrow(features, FEATURE_SCHEMA), "context-bits")
        release(source.sparkSession)
        found = found.unionByName(some) if found else some
    shared.unpersist()
    return found


def score(docs: DataFrame, flush_bytes: int | None = None, followers: bool = False) -> DataFrame:
    """Scores of every text of ``docs`` (doc_id, text) by a model of those that aren't held out.

    ``flush_bytes`` is the text that a worker counts at a time; with more memory than a small executor has, more of
    it means fewer and longer messages. With ``followers``, bits are asked about all followers of the contexts and not
    about their most frequent ones alone. The passes: counts of words and long contexts go out and answers come back; the same
    for short contexts; texts and answers meet and give bits with their inputs; the bits are mixed. Every pass's
    result is written, and its shuffle is released.
    """
    spark = docs.sparkSession
    tune(spark)
    n_tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = docs.select("doc_id", "text", held_out().alias("held_out"))
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = context_bits(n_bytes)
    size = flush_bytes or FLUSH_BYTES
    first = _replies(source, n_tasks, bits, size, (0, 2))
    release(spark)
    model = Model(first)
    whole = first.unionByName(_replies(source, n_tasks, bits, size, (1,), model.masses))
    release(spark)
    found = _bits(source, whole, model, n_tasks, bits, size, followers, 1 + (n_bytes > PART_BYTES))
    drop_materialised(whole)
    release(spark)
    # The mean of the flushes' fitted weights, by their bits.
    sums = found.select(F.posexplode("weights").alias("k", "w"), "n_bits").groupBy("k").agg(F.try_divide(F.sum(F.col("w") * F.col("n_bits")), F.sum("n_bits")))
    start = np.tile(np.array(START), (GATES, 1))
    for k, w in sums.collect():
        if w is not None:
            start[k // PREDICTORS, k % PREDICTORS] = w
    totals = (model.total, float(np.log10(model.total + 0.1 * (model.distinct + 1))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts, bits, gates, inputs in zip(*(c.to_pylist() for c in batch.columns)):
                meta, cost = mixed(texts, bits, gates, inputs, start)
                columns = [
                    pa.array(meta["id"], mask=~meta["has_id"]), pa.array(meta["held"]), pa.array(meta["n_tokens"]), pa.array(meta["n_known"]), pa.array(np.full(len(meta), totals[0], np.int64)),
                    pa.array(meta["base"] - meta["n_tokens"] * totals[1]), pa.array(-cost * np.log10(2)), pa.array(cost / np.maximum(1, meta["n_bytes"])),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in SCORE_SCHEMA.split(", ")])

    result = materialise(found.select("texts", "bits", "gates", "inputs").mapInArrow(run, SCORE_SCHEMA), "lm-scores")
    drop_materialised(found)
    return result
