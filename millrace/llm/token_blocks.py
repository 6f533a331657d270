"""Token ids in files of patched frame-of-reference blocks.

A stream of unsigned 32-bit values is cut into blocks of 128. A block stores its minimum, a bit width at
which a stated share of its values fit after the minimum is subtracted, those low bits, and a list of
exceptions (position, value) for the rest. An index of block starts precedes the blocks, so any block
can be read by itself.

One shard holds the ids of consecutive documents in ascending doc_id order: a header, the doc ids, the
stream of document lengths and the stream of token ids. Shards travel as a binary column of a Parquet
table, since that is what Spark can write to any store; the bytes of a shard are the file format.

Defined cases: a null text is empty and has the end id alone; null ids sort first; rows with equal ids
follow each other in the order of their texts; extra columns are ignored; an empty table gives no shard.
A text longer than a shard gets one by itself.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, text_runs, tune
from .tokens import RUN_BYTES, vocabulary_path, worker_encoder

MAGIC = b"PFORIDS1"
BLOCK = 128
#: Share of a block's values that must fit its bit width.
FIT_SHARE = 0.9
#: Ids after which a shard is closed.
SHARD_IDS = 1 << 19
END_ID = 0

SHARD_SCHEMA = "part int, shard int, n_docs long, n_ids long, start_in_part long, payload binary"
DOC_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    return np.ceil(np.log2(values.astype(np.float64) + 1)).astype(np.int64)


def _overlaps(w: int) -> Iterator[tuple[int, int, int]]:
    """(value, byte, shift) for each value of eight and each of their ``w`` bytes that hold bits of it."""
    for value in range(8):
        for byte in range(value * w // 8, ((value + 1) * w - 1) // 8 + 1):
            yield value, byte, 8 * byte - value * w


def _pack_bits(values: np.ndarray, w: int) -> np.ndarray:
    """The low ``w`` bits of each value of each row one after the other; eight values make ``w`` bytes."""
    columns = np.ascontiguousarray((values & np.uint32((1 << w) - 1)).reshape(-1, 8).T)
    out = np.zeros((w, columns.shape[1]), dtype=np.uint8)
    for value, byte, shift in _overlaps(w):
        moved = columns[value] >> np.uint32(shift) if shift >= 0 else columns[value] << np.uint32(-shift)
        out[byte] |= moved.astype(np.uint8)
    return np.ascontiguousarray(out.T).reshape(len(values), -1)


def _unpack_bits(packed: np.ndarray, w: int) -> np.ndarray:
    """What :func:`_pack_bits` packed."""
    columns = np.ascontiguousarray(packed.reshape(-1, w).T).astype(np.uint32)
    out = np.zeros((8, columns.shape[1]), dtype=np.uint32)
    for value, byte, shift in _overlaps(w):
        out[value] |= columns[byte] << np.uint32(shift) if shift >= 0 else columns[byte] >> np.uint32(-shift)
    return np.ascontiguousarray((out & np.uint32((1 << w) - 1)).T).reshape(len(packed), -1)


def pack_stream(values: np.ndarray) -> bytes:
    """Header (count, blocks), index of block starts, blocks."""
    n = len(values)
    n_blocks = -(-n // BLOCK)
    head = struct.pack("<QI", n, n_blocks)
    if not n:
        return head
    padded = np.full(n_blocks * BLOCK, values[-1], dtype=np.uint32)
    padded[:n] = values
    grid = padded.reshape(n_blocks, BLOCK)
    low = grid.min(axis=1)
    rest = grid - low[:, None]
    need = _bits(rest)
    width = np.sort(need, axis=1)[:, int(np.ceil(FIT_SHARE * BLOCK)) - 1]
    patched = need > width[:, None]
    n_patched = patched.sum(axis=1)
    sizes = 6 + width * (BLOCK // 8) + 5 * n_patched
    starts = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(starts[-1], dtype=np.uint8)
    starts = starts[:-1]
    out[starts[:, None] + np.arange(4)] = low.astype("<u4").view(np.uint8).reshape(-1, 4)
    out[starts + 4] = width
    out[starts + 5] = n_patched
    for w in np.unique(width[width > 0]):
        rows = np.flatnonzero(width == w)
        packed = _pack_bits(rest[rows], int(w))
        out[(starts[rows] + 6)[:, None] + np.arange(packed.shape[1])] = packed
    block, position = np.nonzero(patched)
    if len(block):
        first = np.concatenate([[0], np.cumsum(n_patched)])[block]
        rank = np.arange(len(block)) - first
        lists = starts[block] + 6 + width[block] * (BLOCK // 8)
        out[lists + rank] = position
        at = lists + n_patched[block] + 4 * rank
        out[at[:, None] + np.arange(4)] = rest[block, position].astype("<u4").view(np.uint8).reshape(-1, 4)
    return head + starts.astype("<u8").tobytes() + out.tobytes()


def unpack_stream(data: bytes, at: int = 0) -> tuple[np.ndarray, int]:
    """(values, the offset after the stream)."""
    n, n_blocks = struct.unpack_from("<QI", data, at)
    at += 12
    if not n:
        return np.empty(0, dtype=np.uint32), at
    starts = np.frombuffer(data, dtype="<u8", count=n_blocks, offset=at).astype(np.int64)
    body = np.frombuffer(data, dtype=np.uint8, offset=at + 8 * n_blocks)
    low = body[starts[:, None] + np.arange(4)].copy().view("<u4").ravel()
    width, n_patched = body[starts + 4].astype(np.int64), body[starts + 5].astype(np.int64)
    grid = np.zeros((n_blocks, BLOCK), dtype=np.uint32)
    for w in np.unique(width[width > 0]):
        rows = np.flatnonzero(width == w)
        grid[rows] = _unpack_bits(body[(starts[rows] + 6)[:, None] + np.arange(w * (BLOCK // 8))], int(w))
    block = np.repeat(np.arange(n_blocks), n_patched)
    if len(block):
        rank = np.arange(len(block)) - np.concatenate([[0], np.cumsum(n_patched)])[block]
        lists = starts[block] + 6 + width[block] * (BLOCK // 8)
        values = lists + n_patched[block] + 4 * rank
        grid[block, body[lists + rank]] = body[values[:, None] + np.arange(4)].copy().view("<u4").ravel()
    ends = int(starts[-1] + 6 + width[-1] * (BLOCK // 8) + 5 * n_patched[-1])
    return (grid + low[:, None]).ravel()[:n], at + 8 * n_blocks + ends


def pack_shard(doc_ids: pa.Array, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """The file of some documents' ids, which follow each other in ``ids``."""
    missing = doc_ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8)
    known = pc.fill_null(doc_ids, 0).to_numpy().astype("<i8")
    return b"".join([MAGIC, struct.pack("<Q", len(doc_ids)), missing.tobytes(), known.tobytes(), pack_stream(lengths), pack_stream(ids)])


def unpack_shard(data: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The doc ids, the number of ids of each document, and all ids in a row."""
    if data[: len(MAGIC)] != MAGIC:
        raise ValueError("not a file of packed token ids")
    (n,) = struct.unpack_from("<Q", data, len(MAGIC))
    at = len(MAGIC) + 8
    missing = np.frombuffer(data, dtype=np.uint8, count=n, offset=at)
    known = np.frombuffer(data, dtype="<i8", count=n, offset=at + n)
    lengths, at = unpack_stream(data, at + 9 * n)
    flat, _ = unpack_stream(data, at)
    return pa.array(known, mask=missing.astype(bool)), lengths.astype(np.int64), flat


def write_shards(docs: DataFrame, vocabulary: str | None = None, end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encode and write all documents (doc_id, text) in ascending order of ids; returns the written table of shards.

    One range shuffle puts the texts in order; a task then encodes its range as a stream and holds one
    shard at a time.
    """
    spark = docs.sparkSession
    tune(spark)
    path = vocabulary or vocabulary_path("byte_bpe_50k.json")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # A repeated or null id may stand before many rows: the text's hash deals those out as well.
    order = [F.col("doc_id"), F.xxhash64("text")]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = worker_encoder(path), TaskContext.get().partitionId()
        names: list[pa.Array] = []
        ids: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        held = shard = start = 0

        def close() -> pa.RecordBatch:
            nonlocal held, shard, start
            doc_ids = pa.concat_arrays(names)
            payload = pack_shard(doc_ids, np.concatenate(sizes), np.concatenate(ids))
            row = [part, shard, len(doc_ids), held, start, payload]
            shard, start, held = shard + 1, start + held, 0
            for x in (names, ids, sizes):
                x.clear()
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=[c.split()[0] for c in SHARD_SCHEMA.split(", ")])

        for batch in text_runs(batches, RUN_BYTES):
            found, counts = encoder.batch(batch.column("text"))
            lengths = counts + 1
            ends = np.cumsum(lengths)
            flat = np.full(int(lengths.sum()), end_id, dtype=np.uint32)
            inside = np.ones(len(flat), dtype=bool)
            inside[ends - 1] = False
            flat[inside] = found
            docs_of = batch.column("doc_id").cast(pa.int64())
            # A shard ends with the document that fills it.
            a = 0
            while a < len(ends):
                b = min(len(ends), int(np.searchsorted(ends, shard_ids - held + (ends[a - 1] if a else 0))) + 1)
                names.append(docs_of.slice(a, b - a))
                sizes.append(lengths[a:b].astype(np.uint32))
                ids.append(flat[ends[a] - lengths[a] : ends[b - 1]])
                held += len(ids[-1])
                if held >= shard_ids:
                    yield close()
                a = b
        if held:
            yield close()

    ordered = docs.select("doc_id", "text").repartitionByRange(n, *order).sortWithinPartitions("doc_id", "text")
    return materialise(ordered.mapInArrow(encode, SHARD_SCHEMA), "token-shards")


def read_shards(shards: DataFrame) -> DataFrame:
    """Every document in a table of shards with its place in the whole stream, its length and its ids' crc32.

    The driver only sees one total per partition of the writer.
    """
    totals = sorted((r[0], r[1]) for r in shards.groupBy("part").agg(F.sum("n_ids")).collect())
    bases, at = {}, 0
    for part, n in totals:
        bases[part] = at
        at += n

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, begin, payload in zip(*(c.to_pylist() for c in batch.columns)):
                docs, lengths, ids = unpack_shard(payload)
                ends = np.cumsum(lengths)
                starts = ends - lengths
                data = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([docs, pa.array(bases[part] + begin + starts), pa.array(lengths), pa.array(crc, pa.int64())], names=[c.split()[0] for c in DOC_SCHEMA.split(", ")])

    tune(shards.sparkSession)
    return shards.select("part", "start_in_part", "payload").mapInArrow(decode, DOC_SCHEMA)
