"""Best-fit packing by bin completion.

Pieces of equal length are interchangeable, so the whole problem is a histogram with one count per
length, however many pieces there are. The driver plans on that histogram: for the largest length left
it searches the fillings of the remaining room by branch and bound and uses the best one as often as the
counts allow. The plan is a bounded table of intervals of ranks within a length; a piece finds its
sequence by its own rank, which is computed in two steps so that a length held by a third of all pieces
is not gathered anywhere.

Defined cases: a null text is an empty document of its end id; a row's document is its own even if ids
repeat or are null; extra columns are ignored; an empty table gives an empty result; pieces longer than
the capacity are an error of :func:`plan_sequences`, since only :func:`cut_pieces` knows how to cut.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, text_runs, tune
from .tokens import RUN_BYTES, vocabulary_path, worker_encoder

CAPACITY, END_ID = 2048, 0
#: Nodes of the search for one filling, after which the exact sums decide.
SEARCH_NODES = 3000
#: Fillings that the search over whole plans may try around one piece, and the steps that it may take; how many a new piece costs.
FILLINGS, PLAN_STEPS, NODE_STEPS = 200, 20_000, 10

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank_in_part long"


def best_fit_filling(left: np.ndarray, room: int) -> list[tuple[int, int]]:
    """The incumbent: always the largest remaining length that fits, as (length, times)."""
    filling = []
    size = room
    while room > 0:
        size = min(size, room)
        while size > 0 and not left[size]:
            size -= 1
        if size == 0:
            break
        times = int(min(left[size], room // size))
        filling.append((size, times))
        room -= size * times
        size -= 1
    return filling


def least_waste(sizes: list[int], counts: list[int], room: int) -> list[tuple[int, int]]:
    """A filling of ``room`` with the least waste there is, from the sums that each prefix of the sizes can reach.

    Bit ``k`` of a prefix's number says whether its pieces can fill ``k``; every size takes a few shifts.
    """
    mask, reach = (1 << (room + 1)) - 1, [1]
    for size, count in zip(sizes, counts):
        sums, step, left = reach[-1], 1, min(count, room // size)
        while left > 0:
            step = min(step, left)
            sums |= sums << (size * step) & mask
            left -= step
            step *= 2
        reach.append(sums)
    filling, at = [], reach[-1].bit_length() - 1
    for k in range(len(sizes) - 1, -1, -1):
        times = 0
        while not reach[k] >> at & 1:
            at -= sizes[k]
            times += 1
        if times:
            filling.append((sizes[k], times))
    return filling


def complete_bin(left: np.ndarray, room: int, nodes: int = SEARCH_NODES) -> list[tuple[int, int]]:
    """A filling of ``room`` from the lengths in ``left`` with the least waste there is.

    Lengths are tried in descending order, so each set of lengths is seen once. A branch is cut when even
    all smaller pieces together, or the room itself, can't bring its waste under the incumbent's. A pair
    of lengths whose sum is also left, beyond what the branch has used of it, is dominated by that single
    piece, which is harder to place later, and isn't enumerated. A search that has not ended after ``nodes``
    nodes is settled by :func:`least_waste`, which is exact but blind to dominance.
    """
    best = best_fit_filling(left, room)
    waste = room - sum(s * t for s, t in best)
    if waste == 0:
        return best
    sizes = np.flatnonzero(left[: room + 1])[::-1]
    sizes = [int(s) for s in sizes if s]
    counts = [int(left[s]) for s in sizes]
    below = np.concatenate([np.cumsum((np.array(sizes) * np.array(counts))[::-1])[::-1], [0]]) if sizes else [0]
    budget = nodes
    used: dict[int, int] = {}
    chosen: list[tuple[int, int]] = []

    def search(at: int, rest: int) -> bool:
        nonlocal best, waste, budget
        if rest < waste:
            best, waste = list(chosen), rest
        if waste == 0 or budget <= 0:
            return True
        for i in range(at, len(sizes)):
            size = sizes[i]
            if size > rest:
                continue
            if rest - min(rest, below[i]) >= waste:
                return False
            if any(size + other <= room and left[size + other] > used.get(size + other, 0) for other, _ in chosen):
                continue
            budget -= 1
            for times in range(min(counts[i], rest // size), 0, -1):
                chosen.append((size, times))
                used[size] = times
                done = search(i + 1, rest - size * times)
                chosen.pop()
                del used[size]
                if done:
                    return True
        return False

    search(0, room)
    return best if waste == 0 or budget > 0 else least_waste(sizes, counts, room)


class Budget:
    """Steps that a search may still take."""

    def __init__(self, steps: int):
        self.left = steps

    def spend(self, steps: int = 1) -> bool:
        self.left -= steps
        return self.left >= 0


def _sums_from(sizes: list[int], counts: list[int], room: int) -> list[int]:
    """For each place in ``sizes`` a number whose bit ``k`` says whether the sizes from there on can fill ``k`` of the room."""
    mask, sums = (1 << (room + 1)) - 1, [1]
    for size, count in zip(reversed(sizes), reversed(counts)):
        reach, step, left = sums[-1], 1, min(count, room // size)
        while left > 0:
            step = min(step, left)
            reach |= reach << (size * step) & mask
            left -= step
            step *= 2
        sums.append(reach)
    return sums[::-1]


def _fillings(left: np.ndarray, room: int, most_waste: int, budget: Budget) -> list[dict[int, int]]:
    """Undominated fillings of ``room`` that waste at most ``most_waste``, the fullest first; ``FILLINGS`` of them at most.

    A branch is only entered if the pieces still to come can bring its waste to the bound, which their sums tell exactly, so
    none ends in vain. Branches are taken from a stack, each a step of the budget.
    """
    sizes = [int(s) for s in np.flatnonzero(left[: room + 1])[::-1] if s]
    counts = [int(left[s]) for s in sizes]
    sums = _sums_from(sizes, counts, room)
    most_waste = min(most_waste, room)
    found: list[tuple[int, dict[int, int]]] = []

    def fits(at: int, rest: int) -> bool:
        low = max(0, rest - most_waste)
        return bool(sums[at] >> low & ((1 << (rest - low + 1)) - 1))

    stack: list[tuple[int, int, tuple[tuple[int, int], ...]]] = [(0, room, ())] if fits(0, room) else []
    while stack and len(found) < FILLINGS and budget.spend():
        at, rest, chosen = stack.pop()
        while at < len(sizes) and sizes[at] > rest:
            at += 1
        if at == len(sizes):
            used = dict(chosen)
            # Maximal if nothing that is left fits; dominated if one of its pieces could be a larger one that is left.
            if not any(s <= rest and left[s] > used.get(s, 0) for s in sizes) and not any(left[s] > used.get(s, 0) for size in used for s in range(size + 1, min(size + rest, room) + 1)):
                found.append((rest, used))
            continue
        size = sizes[at]
        # Pushed from none to as many as fit: the fullest are tried first.
        for times in range(min(counts[at], rest // size) + 1):
            if fits(at + 1, rest - size * times):
                stack.append((at + 1, rest - size * times, (*chosen, (size, times)) if times else chosen))
    return [f for _, f in sorted(found, key=lambda x: x[0])]


def _greedy(left: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """(pattern, times): the largest length left with the fullest completion, as often as the counts allow."""
    left, plan, largest = left.copy(), [], capacity
    while largest > 0:
        if not left[largest]:
            largest -= 1
            continue
        left[largest] -= 1
        pattern = dict(complete_bin(left, capacity - largest))
        left[largest] += 1
        pattern[largest] = pattern.get(largest, 0) + 1
        times = int(min(left[size] // per for size, per in pattern.items()))
        for size, per in pattern.items():
            left[size] -= per * times
        plan.append((pattern, times))
    return plan


def best_patterns(counts: np.ndarray, capacity: int, steps: int = PLAN_STEPS) -> list[tuple[dict[int, int], int]]:
    """(pattern, times) for all pieces, in as few sequences as found.

    The incumbent fills one sequence after the other. No sequence can hold more than the fullest sum of pieces that there is, so the
    pieces' sum and that give a bound. If the incumbent needs more, other fillings around each largest piece are tried depth first, each
    as often as the counts allow and then less often; a branch may waste no more in all than leaves
    it fewer sequences than the incumbent. A level of the search is a pattern and not a sequence, so its depth
    depends on the lengths there are and not on how many pieces have them. The search ends when it is exhausted, reaches the bound, or
    has taken ``steps`` steps; the best plan so far is then the answer.
    """
    sizes = np.flatnonzero(counts)
    sizes = sizes[sizes > 0]
    total = int((counts[sizes] * sizes).sum())
    fullest = _sums_from(sizes.tolist(), counts[sizes].tolist(), capacity)[0].bit_length() - 1
    bound = max(-(-total // max(1, fullest)), int(counts[capacity // 2 + 1 :].sum()))
    best = _greedy(counts, capacity)
    fewest, budget = sum(t for _, t in best), Budget(steps)
    if fewest <= bound:
        return best
    left, path = counts.copy(), []
    sequences = wasted = 0

    def options() -> Iterator[tuple[dict[int, int], int]]:
        """Patterns around the largest piece left that a better plan may use, and how often."""
        largest, spare = int(np.flatnonzero(left).max()), (fewest - 1) * fullest - total - wasted
        if spare < 0 or not budget.spend(NODE_STEPS):
            return
        left[largest] -= 1
        fillings = _fillings(left, capacity - largest, spare + capacity - fullest, budget)
        left[largest] += 1
        for filling in fillings:
            pattern = {**filling, largest: filling.get(largest, 0) + 1}
            waste = fullest - sum(s * p for s, p in pattern.items())
            most = min(int(left[s] // p) for s, p in pattern.items())
            for times in range(min(most, spare // waste) if waste > 0 else most, 0, -1):
                yield pattern, times

    def move(pattern: dict[int, int], times: int) -> None:
        nonlocal sequences, wasted
        for size, per in pattern.items():
            left[size] -= per * times
        sequences += times
        wasted += times * (fullest - sum(s * p for s, p in pattern.items()))

    stack = [options()]
    while stack and budget.left > 0:
        step = next(stack[-1], None) if sequences < fewest else None
        if step is None:
            stack.pop()
            if path:
                pattern, times = path.pop()
                move(pattern, -times)
            continue
        budget.spend()
        move(*step)
        path.append(step)
        if left[1:].any():
            stack.append(options())
            continue
        if sequences < fewest:
            best, fewest = list(path), sequences
        if fewest <= bound:
            break
        pattern, times = path.pop()
        move(pattern, -times)
    return best


def plan_sequences(counts: np.ndarray, capacity: int = CAPACITY) -> tuple[pd.DataFrame, int]:
    """(plan, number of sequences) for ``counts[length]`` pieces.

    Plan rows: pieces of ``length`` with ranks from ``low`` up to ``high`` go ``per`` to a sequence, from
    sequence ``first`` on, the first of each at ``offset``.
    """
    if len(counts) > capacity + 1 and counts[capacity + 1 :].any():
        raise ValueError("a piece is longer than a sequence")
    left = np.zeros(capacity + 1, dtype=np.int64)
    left[: len(counts)] = counts[: capacity + 1]
    left[0] = 0
    used = np.zeros_like(left)
    rows, sequence = [], 0
    for pattern, times in best_patterns(left, capacity):
        offset = 0
        for size, per in sorted(pattern.items(), reverse=True):
            rows.append((size, used[size], used[size] + per * times, per, sequence, offset))
            used[size] += per * times
            offset += size * per
        sequence += times
    plan = pd.DataFrame(rows, columns=["length", "low", "high", "per", "first", "offset"], dtype="int64")
    return plan.sort_values(["length", "low"], ignore_index=True), sequence


def cut_pieces(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Tokenise documents (doc_id, text) and cut those longer than ``capacity``; written, so that ranks stay.

    ``rank_in_part`` counts the pieces of one length within the task that wrote them.
    """
    spark = docs.sparkSession
    tune(spark)
    path = vocabulary or vocabulary_path("word_bpe_49k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = worker_encoder(path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in text_runs(batches, RUN_BYTES):
            found, counts = encoder.batch(batch.column("text"))
            # Every document's ids with the end id after them, in a row.
            sizes = counts + 1
            ends = np.cumsum(sizes)
            ids = np.full(int(sizes.sum()), end_id, dtype="<u4")
            inside = np.ones(len(ids), dtype=bool)
            inside[ends - 1] = False
            ids[inside] = found
            pieces = -(-sizes // capacity)
            doc = np.repeat(np.arange(len(sizes)), pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            length = np.minimum(capacity, sizes[doc] - start)
            first = (ends - sizes)[doc] + start
            data = memoryview(ids.tobytes())
            crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(first.tolist(), (first + length).tolist())]
            # The rank of each piece among those of its length that this task has had.
            order = np.argsort(length, kind="stable")
            per = np.bincount(length, minlength=capacity + 1)
            rank = np.empty(len(doc), dtype=np.int64)
            rank[order] = np.arange(len(doc)) - np.repeat((np.cumsum(per) - per), per)
            rank += seen[length]
            seen += per
            parts = [batch.column("doc_id").cast(pa.int64()).take(pa.array(doc)), pa.array(piece, pa.int32()), start, length, crc, np.full(len(doc), part, dtype=np.int32), rank]
            yield pa.RecordBatch.from_arrays([pa.array(x) if not isinstance(x, pa.Array) else x for x in parts], names=[c.split()[0] for c in PIECE_SCHEMA.split(", ")])

    return materialise(docs.select("doc_id", "text").mapInArrow(run, PIECE_SCHEMA), "pieces")


def assign_sequences(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with ``length``, ``part`` and ``rank_in_part``.

    The driver gets one count per length, at most ``capacity`` of them; the plan it sends out has at most
    a few thousand rows, whatever the number of pieces.
    """
    per_part = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_part.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in per_part.groupBy("length").agg(F.sum("n")).collect():
        counts[length] = n
    plan, _ = plan_sequences(counts, capacity)
    columns = {c: plan[c].to_numpy() for c in plan}
    span = int(counts.max(initial=0)) + 1

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys = columns["length"] * span + columns["low"]
        for batch in batches:
            length, rank = batch["length"].to_numpy(), (batch["base"] + batch["rank_in_part"]).to_numpy()
            at = np.searchsorted(keys, length * span + rank, side="right") - 1
            nth, per = rank - columns["low"][at], columns["per"][at]
            batch["sequence_id"] = columns["first"][at] + nth // per
            batch["offset"] = columns["offset"][at] + nth % per * length
            yield batch.drop(columns=["base", "part", "rank_in_part"])

    kept = [c for c in pieces.columns if c not in ("part", "rank_in_part")]
    schema = ", ".join(f"`{c}` {t}" for c, t in pieces.select(*kept).dtypes) + ", sequence_id long, offset long"
    tune(pieces.sparkSession)
    joined = pieces.join(bases, ["part", "length"]).select(*kept, "part", "rank_in_part", "base")
    return joined.mapInPandas(place, schema)


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of every document (doc_id, text) with its sequence and place there."""
    return assign_sequences(cut_pieces(docs, vocabulary, capacity), capacity)
