"""Helpers shared by the text operators: table access, durable intermediate tables, words, hashes."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.durable import drop_materialised, materialise, release, shared_dir  # noqa: F401  for the text operators

#: Bytes and rows of an Arrow batch for text: a batch of very long texts must still fit a Python worker.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 10_000

#: Fixed value: the characters that separate words, the complement of ``[^\x20\x09-\x0D]``.
SPACES = " \t\n\x0b\x0c\r"

_U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables; only Spark touches the path, so any store works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tune(spark: SparkSession) -> None:
    """Bound the Arrow batches that text operators hand to Python, by bytes; the same for all, so callers can't disturb each other."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def doc_crc(column: str = "doc_id"):
    """crc32 of the id as text; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text with A-Z in lower case, as UTF-8."""
    return text.encode().lower().split() if text else []


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> _U64(32))
    x = x * _U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> _U64(32))
    x = x * _U64(0xD6E8FEB86659FD93)
    return x ^ (x >> _U64(32))


#: Keys of the exchanges below have so many bits.
KEY_BITS = 56
#: Bytes of text that are hashed together, so few that a processor's cache holds them, and the length from which a word is hashed by itself.
SEGMENT_BYTES, LONG_WORD = 1 << 15, 256
_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = []
_WIDTHS = np.array([1 << 8 * w for w in range(8)], dtype=np.uint64)


def text_runs(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Batches put together or cut so that each has about ``size`` bytes of ``text``, or one row that is longer."""
    held, bytes_held = [], 0

    def close() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        # A row counts for a few bytes more than its text, so that empty texts don't gather without end.
        each = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 16
        cuts = np.flatnonzero(np.diff(np.cumsum(each, dtype=np.int64) // size)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            held.append(batch.slice(a, b - a))
            bytes_held += int(each[a:b].sum())
            if bytes_held >= size:
                yield close()
                held, bytes_held = [], 0
    if held:
        yield close()


def trim() -> None:
    """Give freed memory of a worker back to the system, where its C library can."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def _power_tables(size: int) -> list[np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2^64."""
    if not _powers or len(_powers[0]) < size:
        inverse = pow(_BASE, -1, 1 << 64)
        _powers[:] = [np.cumprod(np.concatenate([np.ones(1, dtype=np.uint64), np.full(size, x, dtype=np.uint64)])) for x in (_BASE, inverse)]
    return _powers


class WordStream:
    """The words of some texts in a row, with A-Z in lower case: ``hashes`` of 64 bits, and the number of words of each text.

    A word's hash is a polynomial of its bytes, from running sums over all bytes, scrambled; long words are
    hashed by themselves. ``word(i)`` gives a word's bytes.
    """

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts, "")
        _, offsets, data = texts.buffers()
        if not len(texts) or data is None:
            self.data, self.starts, self.ends = np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)
            self.hashes, self.counts = np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
            return
        at = np.frombuffer(offsets, dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        data = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]]
        # A-Z differ from a-z in one bit; bytes below the first of a range wrap around.
        self.data = data | ((data - np.uint8(65) < 26).view(np.uint8) << np.uint8(5))
        at -= at[0]
        space = (self.data == 32) | (self.data - np.uint8(9) < 5)
        before = np.concatenate([[True], space[:-1]])
        before[at[:-1][at[:-1] < len(space)]] = True
        after = np.concatenate([space[1:], [True]])
        after[at[1:][at[1:] > 0] - 1] = True
        self.starts = np.flatnonzero(~space & before[: len(space)])
        self.ends = np.flatnonzero(~space & after[: len(space)]) + 1
        self.counts = np.diff(np.searchsorted(self.starts, at))
        self.hashes = self._hash()

    def _hash(self) -> np.ndarray:
        starts, ends = self.starts, self.ends
        out = np.empty(len(starts), dtype=np.uint64)
        cuts = np.searchsorted(starts, np.arange(0, len(self.data) + SEGMENT_BYTES, SEGMENT_BYTES)).tolist()
        for a, b in zip(cuts[:-1], cuts[1:]):
            low, high = int(starts[a]) if a < b else 0, min(int(ends[b - 1]), int(starts[b - 1]) + LONG_WORD) if a < b else 0
            ahead, back = _power_tables(SEGMENT_BYTES + LONG_WORD + 1)
            sums = np.zeros(high - low + 1, dtype=np.uint64)
            np.cumsum((self.data[low:high].astype(np.uint64) + _U64(1)) * ahead[: high - low], out=sums[1:])
            first = starts[a:b] - low
            out[a:b] = (sums[np.minimum(ends[a:b] - low, high - low)] - sums[first]) * back[first]
        lengths = ends - starts
        out = mix64(out + lengths.astype(np.uint64) * _U64(0xD1342543DE82EF95))
        for i in np.flatnonzero(lengths >= LONG_WORD):
            out[i] = xxhash.xxh3_64_intdigest(self.word(i))
        return out

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def shingle_keys(stream: WordStream, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(keys in a row, keys of each text): sorted distinct ``KEY_BITS``-bit hashes of each text's word shingles.

    With fewer words the whole sequence is one shingle; without words there is none.
    """
    h, counts = stream.hashes, stream.counts
    ends = np.cumsum(counts)

    def fold(at: np.ndarray, span: int) -> np.ndarray:
        acc = np.full(len(at), span, dtype=np.uint64)
        for k in range(span):
            acc = mix64(acc * _U64(0x9E3779B97F4A7C15) + h[at + k])
        return acc >> _U64(64 - KEY_BITS)

    text = np.repeat(np.arange(len(counts)), counts)
    whole = np.flatnonzero(np.arange(len(h)) + width <= ends[text])
    keys, owner = fold(whole, width), text[whole]
    for span in range(1, width):
        short = np.flatnonzero(counts == span)
        keys, owner = np.concatenate([keys, fold(ends[short] - span, span)]), np.concatenate([owner, short])
    order = np.argsort(owner, kind="stable")
    keys, owner = keys[order], owner[order]
    cuts = np.searchsorted(owner, np.arange(len(counts) + 1)).tolist()
    for a, b in zip(cuts[:-1], cuts[1:]):
        keys[a:b].sort()
    new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])])[: len(keys)]
    return keys[new], np.bincount(owner[new], minlength=len(counts))


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending unsigned integers as the first one and the differences, in as few bytes as most need, with a list of larger ones."""
    if not len(keys):
        return b""
    steps = np.diff(keys).astype("<u8")
    over = [*(len(steps) - np.searchsorted(np.sort(steps), _WIDTHS)).tolist(), 0]
    wide = min(range(1, 9), key=lambda w: w * len(steps) + 12 * over[w])
    at = np.flatnonzero(steps >> _U64(8 * wide)) if over[wide] else np.zeros(0, dtype=np.int64)
    head = int(keys[0]).to_bytes(8, "little") + bytes([wide]) + len(at).to_bytes(4, "little")
    return head + at.astype("<u4").tobytes() + steps[at].tobytes() + steps.view(np.uint8).reshape(-1, 8)[:, :wide].tobytes()


def unpack_sorted(data: bytes | None) -> np.ndarray:
    """What :func:`pack_sorted` wrote."""
    if not data:
        return np.zeros(0, dtype=np.uint64)
    wide, n = data[8], int.from_bytes(data[9:13], "little")
    parts = np.frombuffer(data, dtype=np.uint8, offset=13 + 12 * n).reshape(-1, wide)
    out = np.zeros((len(parts) + 1, 8), dtype=np.uint8)
    out[0] = np.frombuffer(data, dtype=np.uint8, count=8)
    out[1:, :wide] = parts
    steps = out.view("<u8").ravel()
    steps[1 + np.frombuffer(data, dtype="<u4", count=n, offset=13).astype(np.int64)] = np.frombuffer(data, dtype="<u8", count=n, offset=13 + 4 * n)
    return np.cumsum(steps, dtype=np.uint64)


def bucket_cuts(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    """Where each of ``n_buckets`` equal ranges of ``KEY_BITS``-bit keys begins in ascending keys, and the end."""
    bounds = [-(-(b << KEY_BITS) // n_buckets) for b in range(1, n_buckets)]
    return np.concatenate([[0], np.searchsorted(keys, np.array(bounds, dtype=np.uint64)), [len(keys)]])
