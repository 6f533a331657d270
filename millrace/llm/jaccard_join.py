"""Exact Jaccard self-join of texts on word shingles, with signature trees.

1. Shared elements. Every element of every set is dealt out by ranges of its hash; where it meets itself
   in another set, its number of occurrences goes back to the sets that have it. A task first counts its
   own sets, so an element of a third of all texts is sent once by each flush. Links are made of shared
   elements only, so a set of which fewer than ``LEAST`` percent are shared can have no link and is done.
2. Candidates. Two sets of similarity t or more share one of the first ``n - ceil(t n) + 1`` elements under any
   common order; the order is by rarity, now known exactly, so that unshared elements come first and
   passages of many texts last. Sets that share such an element and whose sizes a link allows, directly or
   through others, form a candidate group.
3. Links. Inside a group, a signature tree is built: its nodes hold the OR of their sets' bitmaps and their
   range of sizes. The tree is traversed against itself; a pair of nodes is left out when even the largest
   overlap its bitmaps and sizes allow is too small, or when all its sets are already in one component.
   Remaining pairs of sets are verified on their shared elements and sizes.

All three steps move data in proportion to the texts; nothing is broadcast and nothing is held back. Equal
sets are one node of the graph, so copies cost nothing. A task never holds more than two blocks
of a group. Large groups are joined block by block: every block with itself and with the first one, and
then only those pairs of blocks that did not come out as one component.

Defined cases: a null text, or one without words, has an empty set and is linked with nothing; a text
of fewer words than a shingle has one element; rows with a null id are returned with a null component
and linked with nothing; rows that repeat an id and text share a component, and so do all sets of one id with
their partners; a text of any length is hashed in segments; extra columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import KEY_BITS, WordStream, bucket_cuts, drop_materialised, materialise, pack_sorted, release, shingle_keys, text_runs, trim, tune, unpack_sorted
from .components import connected_components

#: Similarity as a share of 100: links have 100 * intersection >= LEAST * union.
LEAST = 75
WIDTH = 5
#: Size classes within the largest ratio of linked sets.
SIZE_STEPS = 16
#: Bytes of text hashed together; elements, and sets, that a task holds before it hands them on.
RUN_BYTES, FLUSH_KEYS, FLUSH_SETS = 2 << 20, 1_000_000, 60_000
#: Postings of prefixes that a task holds before it hands them on.
HELD_POSTINGS = 500_000
#: Bytes of sets of a candidate group in one block.
BLOCK_BYTES = 2 << 20
#: Signature trees: 64-bit words of a bitmap, sets of a leaf, children of a node.
BITMAP_WORDS, LEAF, FANOUT = 16, 16, 8

EXCHANGE_SCHEMA = "dest int, flush long, bucket int, keys binary, sets binary, common binary, counts binary, local binary, meta binary"
SET_SCHEMA = "id long, n_shingles long, set_id long, shared binary, prefix binary"
EDGE_SCHEMA = "a long, b long"
_META = np.dtype([("id", "<i8"), ("has_id", "?"), ("n", "<i8"), ("set_id", "<i8"), ("slot", "<i4")])


def _least_overlap(n: int) -> int:
    """The least intersection that a set of ``n`` needs with any partner."""
    return -(-LEAST * n // 100)


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def _occurrence_levels(counts: np.ndarray) -> np.ndarray:
    """Counts as one byte, about eight steps per doubling."""
    return np.minimum(255, np.round(8 * np.log2(counts))).astype(np.uint8)


def shared_elements(docs: DataFrame, id_column: str = "doc_id", width: int = WIDTH) -> DataFrame:
    """One row per row of ``docs`` with the size and name of its set; for sets that may have links, once per flush, also
    their shared elements and those of their prefix.

    A flush is a run of one task's texts. Its elements go out by ranges of hashes (``dest``), and what comes
    back is put together by flush, so both shuffles are even whatever the texts hold. A range gets each
    element once per flush: with its set if the flush has it once, else with a count, since it is known to
    be shared already and only its number of occurrences is asked for.
    """
    spark = docs.sparkSession
    tune(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        metas: list[np.ndarray] = []
        slots: list[np.ndarray] = []
        seen: set[int] = set()
        held = 0
        flush_id = TaskContext.get().partitionId() << 32

        def flush() -> pa.RecordBatch:
            nonlocal held, flush_id
            key = np.concatenate([np.zeros(0, np.uint64), *keys])
            slot = np.repeat(np.arange(len(slots), dtype=np.uint16), [len(k) for k in keys])
            order = np.argsort(key)
            key, slot = key[order], slot[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[: len(key)])
            times = np.diff(np.append(first, len(key)))
            alone = times == 1
            single, single_slot = key[first[alone]], slot[first[alone]]
            common, common_times = key[first[~alone]], times[~alone]
            local = slot[np.repeat(~alone, times)]
            rows = []
            a, b = bucket_cuts(single, n), bucket_cuts(common, n)
            for k in range(n):
                one, many = slice(a[k], a[k + 1]), slice(b[k], b[k + 1])
                if one.start < one.stop or many.start < many.stop:
                    rows.append((k, flush_id, k, pack_sorted(single[one]), single_slot[one].tobytes(), pack_sorted(common[many]), common_times[many].astype("<u2").tobytes(), None, None))
            rows.append((int(flush_id >> 32) % n, flush_id, -1, None, None, pack_sorted(common), common_times.astype("<u2").tobytes(), local.astype("<u2").tobytes(), np.concatenate(metas).tobytes()))
            for x in (keys, metas, slots, seen):
                x.clear()
            held, flush_id = 0, flush_id + 1
            trim()
            return _batch(EXCHANGE_SCHEMA, rows)

        for batch in text_runs(batches, RUN_BYTES):
            found, sizes = shingle_keys(WordStream(batch.column("text")), width)
            ids = batch.column("id").cast(pa.int64())
            meta = np.zeros(len(sizes), dtype=_META)
            meta["id"], meta["has_id"], meta["n"], meta["slot"] = pc.fill_null(ids, 0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False), sizes, -1
            ends = np.cumsum(sizes)
            raw = memoryview(found.tobytes())
            begin = 0
            for i, end in enumerate(ends.tolist()):
                size = int(sizes[i])
                if size:
                    name = xxhash.xxh3_64_intdigest(raw[8 * (end - size) : 8 * end])
                    meta["set_id"][i] = np.uint64(name).astype(np.int64)
                    if meta["has_id"][i] and name not in seen:
                        seen.add(name)
                        meta["slot"][i] = len(slots)
                        slots.append(i)
                        keys.append(found[end - size : end])
                        held += size
                if held >= FLUSH_KEYS or len(slots) >= FLUSH_SETS:
                    metas.append(meta[begin : i + 1])
                    begin = i + 1
                    yield flush()
            if begin < len(meta):
                metas.append(meta[begin:])
        if metas:
            yield flush()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        current = None

        def answer() -> pa.RecordBatch:
            """For each flush: its elements that others have too, their sets and levels, and the levels of its common ones."""
            alone = [unpack_sorted(r[3]) for r in held]
            common = [unpack_sorted(r[5]) for r in held]
            key = np.concatenate([*alone, *common])
            times = np.concatenate([np.ones(sum(map(len, alone)), np.int64), *(np.frombuffer(r[6], "<u2").astype(np.int64) for r in held)])
            order = np.argsort(key)
            ranked = key[order]
            first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])[: len(ranked)])
            total = np.add.reduceat(times[order], first) if len(first) else np.zeros(0, np.int64)
            level, often = np.empty(len(key), np.uint8), np.empty(len(key), bool)
            level[order] = np.repeat(_occurrence_levels(total), np.diff(np.append(first, len(key))))
            often[order] = np.repeat(total > 1, np.diff(np.append(first, len(key))))
            rows, at, after = [], 0, sum(map(len, alone))
            for r, one, many in zip(held, alone, common):
                mine = np.flatnonzero(often[at : at + len(one)])
                slot = np.frombuffer(r[4], np.uint16)[mine]
                rows.append((None, r[1], r[2], pack_sorted(one[mine]), slot.tobytes(), None, level[at : at + len(one)][mine].tobytes(), level[after : after + len(many)].tobytes(), None))
                at, after = at + len(one), after + len(many)
            held.clear()
            trim()
            return _batch(EXCHANGE_SCHEMA, rows)

        for batch in batches:
            own = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[2] < 0:
                    own.append(row)
                    continue
                if row[2] != current and held:
                    yield answer()
                current = row[2]
                held.append(row)
            if own:
                yield _batch(EXCHANGE_SCHEMA, own)
        if held:
            yield answer()

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def close() -> pa.RecordBatch:
            """The rows of a flush; the first of ``held`` is its own account, the others are answers in the order of their ranges."""
            own, answers = held[0], held[1:]
            meta = np.frombuffer(own[8], dtype=_META)
            common, times = unpack_sorted(own[5]), np.frombuffer(own[6], "<u2").astype(np.int64)
            levels = np.concatenate([np.zeros(0, np.uint8), *(np.frombuffer(r[7], np.uint8) for r in answers)])
            slot = np.concatenate([np.frombuffer(own[7], "<u2"), *(np.frombuffer(r[4], np.uint16) for r in answers)])
            key = np.concatenate([np.repeat(common, times), *(unpack_sorted(r[3]) for r in answers)])
            level = np.concatenate([np.repeat(levels, times), *(np.frombuffer(r[6], np.uint8) for r in answers)])
            n_slots = int(meta["slot"].max(initial=-1)) + 1
            held_by = np.bincount(slot, minlength=n_slots)
            size = np.zeros(n_slots, dtype=np.int64)
            size[meta["slot"][meta["slot"] >= 0]] = meta["n"][meta["slot"] >= 0]
            able = 100 * held_by >= LEAST * size
            wanted = able[slot]
            slot, key, level = slot[wanted], key[wanted], level[wanted]
            order = np.lexsort((key, slot))
            slot, key, level = slot[order], key[order], level[order]
            cuts = np.searchsorted(slot, np.arange(n_slots + 1))
            shared: list[bytes | None] = [None] * len(meta)
            prefix: list[bytes | None] = [None] * len(meta)
            for i in np.flatnonzero(meta["slot"] >= 0).tolist():
                k = meta["slot"][i]
                if able[k]:
                    mine = slice(cuts[k], cuts[k + 1])
                    # Unshared elements are the rarest, so they take up the prefix first.
                    take = int(size[k]) - _least_overlap(int(size[k])) + 1 - (int(size[k]) - int(held_by[k]))
                    order_of = (level[mine].astype(np.uint64) << np.uint64(KEY_BITS)) | key[mine]
                    shared[i] = pack_sorted(key[mine])
                    prefix[i] = np.sort(np.partition(order_of, take - 1)[:take]).astype("<u8").tobytes()
            held.clear()
            columns = [pa.array(meta["id"], mask=~meta["has_id"]), pa.array(meta["n"]), pa.array(meta["set_id"], mask=meta["n"] == 0), pa.array(shared, pa.binary()), pa.array(prefix, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in SET_SCHEMA.split(", ")])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0][1] != row[1]:
                    yield close()
                held.append(row)
        if held:
            yield close()

    texts = docs.select(F.col(id_column).alias("id"), "text")
    sent = texts.mapInArrow(describe, EXCHANGE_SCHEMA).repartition(n, "dest").sortWithinPartitions("bucket", "flush")
    answers = sent.mapInArrow(meet, EXCHANGE_SCHEMA).repartition(n, "flush").sortWithinPartitions("flush", "bucket")
    return materialise(answers.mapInArrow(assemble, SET_SCHEMA), "sets")


def size_class(n: int) -> int:
    """A size in steps of which :data:`SIZE_STEPS` make the largest ratio that linked sets can have."""
    return int(SIZE_STEPS * np.log(n) / np.log(100 / LEAST))


def _runs(keys: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of postings: the least id of each distinct (key, size class), and distinct edges.

    Edges join ids of one key and size class to the least one, and those to the next size class of the key
    that a link can reach. So any two sets that share a key and may be linked are connected, while sets
    on both sides of a gap in sizes are not.
    """
    order = np.lexsort((ids, sizes, keys))
    keys, ids, sizes = keys[order], ids[order], sizes[order]
    first = np.concatenate([[True], (keys[1:] != keys[:-1]) | (sizes[1:] != sizes[:-1])])
    leaders = ids[first][np.cumsum(first) - 1]
    other = ids != leaders
    same = np.stack([ids[other], leaders[other]], axis=1)
    keys, ids, sizes = keys[first], ids[first], sizes[first]
    # Sizes are rounded down, so a ratio within bounds is at most one step more.
    reach = (keys[1:] == keys[:-1]) & (sizes[1:] - sizes[:-1] <= SIZE_STEPS + 1) & (ids[1:] != ids[:-1])
    chain = np.stack([ids[1:][reach], ids[:-1][reach]], axis=1)
    return keys, ids, sizes, np.unique(np.concatenate([same, chain]), axis=0)


def candidate_edges(sets: DataFrame) -> DataFrame:
    """Edges (a, b) between set names that share a prefix element; linear in the postings.

    A task joins its own postings first and hands on one posting per element and size class, so an element
    of a third of all texts reaches the next task a bounded number of times from each task. There, the sets
    of each element are chained in the order of their sizes.
    """
    n = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = "bucket int, keys binary, ids binary, sizes binary, pairs binary"

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        whole: list[tuple[int, int, int]] = []
        held = 0

        def flush() -> pa.RecordBatch:
            about = np.array(whole, dtype=np.int64)
            key, ids, sizes, pairs = _runs(np.concatenate(keys), *(np.repeat(about[:, k], about[:, 2]) for k in (0, 1)))
            bucket, edge_bucket = (key % np.uint64(n)).astype(np.int64), pairs[:, 0] % n
            order, edge_order = np.argsort(bucket, kind="stable"), np.argsort(edge_bucket, kind="stable")
            cuts, edge_cuts = (np.searchsorted(np.sort(x), np.arange(n + 1)) for x in (bucket, edge_bucket))
            rows = []
            for k in range(n):
                at, mine = order[cuts[k] : cuts[k + 1]], pairs[edge_order[edge_cuts[k] : edge_cuts[k + 1]]]
                if len(at) or len(mine):
                    rows.append((k, key[at].astype("<u8").tobytes(), ids[at].astype("<i8").tobytes(), sizes[at].astype("<u2").tobytes(), mine.astype("<i8").tobytes()))
            keys.clear()
            whole.clear()
            return _batch(schema, rows)

        for batch in batches:
            for set_id, size, prefix in zip(*(c.to_pylist() for c in batch.columns)):
                keys.append(np.frombuffer(prefix, dtype="<u8"))
                whole.append((set_id, size_class(size), len(keys[-1])))
                held += len(keys[-1])
                if held >= HELD_POSTINGS:
                    yield flush()
                    held = 0
        if held:
            yield flush()

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[list[np.ndarray]] = [[], [], [], []]
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                for part, data, kind in zip(parts, row[1:], ("<u8", "<i8", "<u2", "<i8")):
                    part.append(np.frombuffer(data, dtype=kind))
        if parts[0]:
            keys, ids, sizes, pairs = (np.concatenate(p) for p in parts)
            *_, found = _runs(keys, ids, sizes.astype(np.int64))
            found = np.unique(np.concatenate([found, pairs.reshape(-1, 2)]), axis=0)
            for at in range(0, len(found), 200_000):
                yield pa.RecordBatch.from_arrays([pa.array(found[at : at + 200_000, k]) for k in (0, 1)], names=["a", "b"])

    postings = sets.where(F.col("prefix").isNotNull()).select("set_id", "n_shingles", "prefix").mapInArrow(post, schema)
    return postings.repartition(n, "bucket").mapInArrow(chain, EDGE_SCHEMA)


class SignatureTree:
    """Sets in leaves of ``LEAF``, neighbours in the order of their least element; nodes know bitmaps and sizes."""

    def __init__(self, sets: list[np.ndarray], sizes: list[int]):
        """``sets`` are the sorted elements that may be in common, ``sizes`` those of the whole sets."""
        self.order = sorted(range(len(sets)), key=lambda i: (int(sets[i][0]), sizes[i]))
        self.sets = [sets[i] for i in self.order]
        self.sizes = np.array([sizes[i] for i in self.order], dtype=np.int64)
        self.bits = np.zeros((len(sets), BITMAP_WORDS), dtype=np.uint64)
        for row, s in zip(self.bits, self.sets):
            np.bitwise_or.at(row, (s >> np.uint64(6)) % np.uint64(BITMAP_WORDS), np.uint64(1) << (s & np.uint64(63)))
        #: Elements beyond the first of each bit: what a bitmap can hide of an overlap.
        self.hidden = np.array([len(s) for s in self.sets], dtype=np.int64) - np.bitwise_count(self.bits).sum(axis=1).astype(np.int64)
        #: Levels from the leaves up: (first set, bitmap, least size, largest size, most hidden) of each node.
        self.levels = []
        starts = np.arange(0, len(sets), LEAF)
        while True:
            fold = [f.reduceat(x, starts) for f, x in ((np.minimum, self.sizes), (np.maximum, self.sizes), (np.maximum, self.hidden))]
            self.levels.append((np.append(starts, len(sets)), np.bitwise_or.reduceat(self.bits, starts, axis=0), *fold))
            if len(starts) == 1:
                break
            starts = starts[::FANOUT]

    def join(self) -> list[tuple[int, int]]:
        """Links between the given sets that connect all that are linked, as positions in the given order."""
        label = np.arange(len(self.sets))
        links: list[tuple[int, int]] = []

        def united(a: tuple[int, int], b: tuple[int, int]) -> bool:
            one = label[a[0]]
            return bool((label[a[0] : a[1]] == one).all() and (label[b[0] : b[1]] == one).all())

        def leaf(a: tuple[int, int], b: tuple[int, int]) -> None:
            ia, ib = np.arange(*a), np.arange(*b)
            na, nb = self.sizes[ia][:, None], self.sizes[ib][None, :]
            most = np.bitwise_count(self.bits[ia][:, None, :] & self.bits[ib][None, :, :]).sum(axis=2).astype(np.int64)
            most = np.minimum(most + np.minimum(self.hidden[ia][:, None], self.hidden[ib][None, :]), np.minimum(na, nb))
            open_ = (100 * most >= LEAST * (na + nb - most)) & (ia[:, None] < ib[None, :])
            for i, j in zip(*np.nonzero(open_)):
                i, j = ia[i], ib[j]
                if label[i] != label[j] and linked(self.sets[i], self.sets[j], self.sizes[i], self.sizes[j]):
                    label[label == label[j]] = label[i]
                    links.append((self.order[i], self.order[j]))

        def visit(level: int, a: int, b: int) -> None:
            starts, bits, low, high, hidden = self.levels[level]
            span_a, span_b = (starts[a], starts[a + 1]), (starts[b], starts[b + 1])
            if a != b or level == 0:
                most = int(np.bitwise_count(bits[a] & bits[b]).sum()) + int(min(hidden[a], hidden[b]))
                most = min(most, int(high[a]), int(high[b]))
                if 100 * most < LEAST * (int(low[a]) + int(low[b]) - most):
                    return
            if united(span_a, span_b):
                return
            if level == 0:
                leaf(span_a, span_b)
                return
            below = len(self.levels[level - 1][0]) - 1
            kids_a = range(a * FANOUT, min(below, (a + 1) * FANOUT))
            kids_b = range(b * FANOUT, min(below, (b + 1) * FANOUT))
            for i in kids_a:
                for j in kids_b:
                    if i <= j:
                        visit(level - 1, i, j)

        if self.sets:
            visit(len(self.levels) - 1, 0, 0)
        return links


def linked(x: np.ndarray, y: np.ndarray, size_x: int, size_y: int) -> bool:
    """Whether two sets are similar enough, by the sorted elements that they may have in common and their sizes."""
    if LEAST * max(size_x, size_y) > 100 * min(len(x), len(y)):
        return False
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    both = int((y[at] == x).sum())
    return 100 * both >= LEAST * (int(size_x) + int(size_y) - both)


def _join_tasks(rows: DataFrame) -> DataFrame:
    """Links within each ``task`` of ``rows`` (task, set_id, n_shingles, shared)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, ids, sets, sizes, out = None, [], [], [], []

        def close() -> None:
            if len(ids) > 1:
                out.extend((ids[i], ids[j]) for i, j in SignatureTree(sets, sizes).join())
            for x in (ids, sets, sizes):
                x.clear()

        for batch in batches:
            for task, set_id, size, data in zip(*(c.to_pylist() for c in batch.columns)):
                if task != current:
                    close()
                    current = task
                if not ids or ids[-1] != set_id:
                    ids.append(set_id)
                    sizes.append(size)
                    sets.append(unpack_sorted(data))
            if len(out) > 100_000:
                yield _batch(EDGE_SCHEMA, out)
                out.clear()
        close()
        yield _batch(EDGE_SCHEMA, out)

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.select("task", "set_id", "n_shingles", "shared").repartition(n, "task").sortWithinPartitions("task", "set_id").mapInArrow(run, EDGE_SCHEMA)


def link_sets(sets: DataFrame, candidates: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Verified links between the sets of each candidate group, enough of them to connect all that are linked.

    ``sets`` has set_id, n_shingles and shared; ``candidates`` has node and root.
    """
    members = sets.join(candidates.withColumnRenamed("node", "set_id"), "set_id")
    sizes = members.groupBy("root").agg(F.sum(F.octet_length("shared")).alias("bytes"))
    blocks = F.ceil(F.col("bytes") / block_bytes)
    members = members.join(sizes, "root").select("root", "set_id", "n_shingles", "shared", blocks.alias("blocks"), F.pmod(F.xxhash64("set_id", F.lit(7)), blocks).alias("block"))
    members = materialise(members, "members")
    most_blocks = members.agg(F.max("blocks")).first()[0] or 0
    # The first block is also sent to every other block of its group.
    tasks = F.when((F.col("block") == 0) & (F.col("blocks") > 1), F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(F.array("block"))
    links = materialise(_join_tasks(members.withColumn("at", F.explode(tasks)).withColumn("task", F.struct("root", "at").cast("string"))), "links")
    if most_blocks > 2:
        label = connected_components(links)
        large = members.where(F.col("blocks") > 2).select("root", "block", "set_id")
        labelled = large.join(label.withColumnRenamed("root", "label"), large["set_id"] == label["node"], "left").select("root", "block", F.coalesce("label", "set_id").alias("label"))
        ends = labelled.groupBy("root", "block").agg(F.min("label").alias("low"), F.max("label").alias("high"))
        one, two = ends.alias("one"), ends.alias("two")
        apart = (F.col("one.low") != F.col("one.high")) | (F.col("two.low") != F.col("two.high")) | (F.col("one.low") != F.col("two.low"))
        pairs = one.join(two, F.col("one.root") == F.col("two.root")).where((F.col("one.block") > 0) & (F.col("one.block") < F.col("two.block")) & apart)
        pairs = pairs.select(F.col("one.root").alias("root"), F.col("one.block").alias("i"), F.col("two.block").alias("j"))
        pairs = pairs.withColumn("task", F.struct("root", "i", "j").cast("string")).select("root", "task", F.explode(F.array("i", "j")).alias("block"))
        pairs = materialise(pairs, "block-pairs")
        if pairs.limit(1).count():
            more = materialise(_join_tasks(members.join(pairs, ["root", "block"])), "links")
            links = links.unionByName(more)
    drop_materialised(members)
    return links


def _one_row_of_each(sets: DataFrame) -> DataFrame:
    """One row of each set_id; there is one row from each flush at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            names = batch.column("set_id").to_numpy()
            if len(names):
                new = np.concatenate([[last is None or names[0] != last], names[1:] != names[:-1]])
                last = names[-1]
                yield batch.filter(pa.array(new))

    n = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return sets.repartition(n, "set_id").sortWithinPartitions("set_id").mapInArrow(run, sets.schema)


def set_components(docs: DataFrame, id_column: str = "doc_id", width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """(rows, components): id, n_shingles and set_id of every row; set_id and root of every set that has a link."""
    spark = docs.sparkSession
    found = shared_elements(docs, id_column, width)
    release(spark)
    rows, able = found.select("id", "n_shingles", "set_id"), materialise(_one_row_of_each(found.where(F.col("prefix").isNotNull()).drop("id")), "able")
    candidates = materialise(connected_components(candidate_edges(able)), "candidates")
    release(spark)
    components = connected_components(link_sets(able, candidates, block_bytes)).select(F.col("node").alias("set_id"), "root")
    drop_materialised(able, candidates)
    release(spark)
    return rows, components


def near_duplicates(docs: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_shingles and component_id, the least doc_id reachable by links."""
    rows, components = set_components(docs, "doc_id", width, block_bytes)
    rows = rows.withColumnRenamed("id", "doc_id")
    named = rows.where(F.col("doc_id").isNotNull() & F.col("set_id").isNotNull()).groupBy("set_id").agg(F.min("doc_id").alias("doc_id"))
    named = named.join(components, "set_id", "left").select("set_id", "doc_id", F.coalesce("root", "set_id").alias("root"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    by_set = named.join(least, "root").select("set_id", "component_id")
    component = F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("component_id", "doc_id"))
    found = rows.join(by_set, "set_id", "left").select("doc_id", "n_shingles", component.alias("component_id"))
    result = materialise(found, "near-duplicates")
    drop_materialised(rows, components)
    return result


def keep_one_of_each(docs: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row of each component of texts, the first by id, rows without an id last; rows without words stay.

    Rows are told apart by a number of their own and not by their id, so different texts that share an id
    are separate, copies with one id or none are not, and no component loses all its rows. The rows are
    written with their numbers first, so the numbers stay the same. Only numbers are shuffled.
    """
    number, at = (f"{name}_of_{'_'.join(docs.columns)}" for name in ("row", "first"))
    whole = materialise(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    rows, components = set_components(whole, number, width, block_bytes)
    ids = whole.select(F.col(number).alias("id"), "doc_id")
    group = F.coalesce("root", "set_id").alias("group")
    worded = rows.where(F.col("set_id").isNotNull()).join(components, "set_id", "left").select("id", group).join(ids, "id")
    first = worded.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "id")).getField("id").alias(at)).select(at)
    stay = first.unionByName(rows.where(F.col("set_id").isNull()).select(F.col("id").alias(at)))
    return whole.join(stay.hint("shuffle_hash"), F.col(number) == F.col(at), "left_semi").select(*docs.columns)
