"""Near-duplicates by Hamming distance on 64-bit hashes: pairs, order-dependent removal, exact removal."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..durable import drop_materialised, materialise
from ..functions.hashing import band_layout, bands, first_shared, hamming, prefix, probe_keys, rest_bands
from .components import component_roots
from .quantiles import exact_percentiles

#: Hashes with one key above which they are told apart further, and the most that meet in one block then.
HOT = 20_000
#: Near pairs that one task decides in order.
TASK_EDGES = 2_000_000


def distinct_hashes(items: DataFrame) -> DataFrame:
    """(h, ordinal): each hash once, with its first ordinal; a hash that many items share is one row."""
    return items.groupBy("h").agg(F.min("ordinal").alias("ordinal"))


def _meet(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both sides (ordinal, h, keys...) with equal keys and a lower ordinal on the left, as a, b, ha, hb and the keys."""
    one = left.select(F.col("ordinal").alias("a"), F.col("h").alias("ha"), *keys)
    two = right.select(F.col("ordinal").alias("b"), F.col("h").alias("hb"), *keys)
    return one.join(two, keys).where(F.col("a") < F.col("b"))


def _in_blocks(rows: DataFrame, sizes: DataFrame, keys: list[str], hot: int) -> DataFrame:
    """Rows with one more key: the cells (i, j) of a triangle of blocks, when a key has more than ``hot`` rows, else one cell.

    A row of block b is in every cell that has b as one of its two blocks, so each two rows of a key meet where their
    blocks do, and in no cell of more than two blocks' rows.
    """
    sized = rows.join(sizes, keys, "left").withColumn("_blocks", F.greatest(F.lit(1), F.ceil(F.col("n") / hot)).cast("int")).drop("n")
    sized = sized.withColumn("block", F.pmod(F.xxhash64("ordinal"), F.col("_blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    return sized.withColumn("_other", other).select(*rows.columns, "block", F.least("block", "_other").alias("i"), F.greatest("block", "_other").alias("j"))


def _join_on_keys(left: DataFrame, right: DataFrame, keys: list[str], most: int, hot: int) -> DataFrame:
    """Pairs (a, b, ha, hb, keys...) of rows (ordinal, h, keys..., rest) that share the keys and could be within ``most`` bits.

    ``rest`` holds the bits of a hash that its keys don't fix. Keys with more than ``hot`` rows are told apart by bands of those, of
    which a near pair shares one whole, and what is still large then is joined in a triangle of blocks. So
    no task holds a key that all hashes share. A pair comes out once for each of its keys.
    """
    counted = right.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > hot)
    heavy = materialise(counted, "hot-keys")
    if not heavy.limit(1).count():
        return _meet(left, right, keys).select("a", "b", "ha", "hb", *keys)
    light = _meet(left.join(heavy, keys, "left_anti"), right.join(heavy, keys, "left_anti"), keys)
    finer = [*keys, "sub", "part"]
    post = lambda side: side.join(heavy.drop("n"), keys, "left_semi").withColumn("_p", F.explode(rest_bands(F.col("rest"), most + 1))).select("ordinal", "h", *keys, F.col("_p.band").alias("sub"), F.col("_p.key").alias("part"))
    one, two = post(left), post(right)
    sizes = two.groupBy(*finer).agg(F.count("*").alias("n")).where(F.col("n") > hot)
    cells = [*finer, "i", "j"]
    one, two = _in_blocks(one, sizes, finer, hot).withColumnRenamed("block", "block_a"), _in_blocks(two, sizes, finer, hot).withColumnRenamed("block", "block_b")
    met = one.select(F.col("ordinal").alias("a"), F.col("h").alias("ha"), "block_a", *cells).join(two.select(F.col("ordinal").alias("b"), F.col("h").alias("hb"), "block_b", *cells), cells)
    # In a cell of two blocks, rows of the same block have met elsewhere.
    met = met.where((F.col("a") < F.col("b")) & ((F.col("i") == F.col("j")) | (F.col("block_a") != F.col("block_b"))))
    return light.select("a", "b", "ha", "hb", *keys).unionByName(met.select("a", "b", "ha", "hb", *keys).distinct())


def hamming_pairs(items: DataFrame, most: int, mode: str = "exact", prefix_bits: int = 12, hot: int = HOT) -> DataFrame:
    """Pairs (a, b, distance) of ordinals a < b within ``most`` bits, from items (ordinal, h) of distinct hashes.

    exact: ``most + 1`` bands, one of which any such pair shares whole; each pair counts in its first
    common band. prefix: the approximate rule, which probes the prefix and its one-bit
    neighbours. Both are equi-joins on keys, of which those of more than ``hot`` hashes are cut further, at no
    loss of pairs. Give distinct hashes, since equal ones make all pairs.
    """
    distance = hamming(F.col("ha"), F.col("hb"))
    if mode == "exact":
        posted = items.select("ordinal", "h", F.explode(bands(F.col("h"), most + 1)).alias("p")).select("ordinal", "h", "p.band", "p.key", "p.rest")
        met = _join_on_keys(posted, posted, ["band", "key"], most, hot).where(distance <= most)
        met = met.where(F.col("band") == first_shared(F.expr("ha ^ hb"), band_layout(most + 1)))
    elif mode == "prefix":
        left = items.select("ordinal", "h", F.explode(probe_keys(F.col("h"), prefix_bits)).alias("key"), F.col("h").alias("rest"))
        right = items.select("ordinal", "h", prefix(F.col("h"), prefix_bits).alias("key"), F.col("h").alias("rest"))
        met = _join_on_keys(left, right, ["key"], most, hot).where(distance <= most)
    else:
        raise ValueError(f"no such mode: {mode}")
    return met.select("a", "b", distance.alias("distance"))


def exact_duplicates(items: DataFrame) -> DataFrame:
    """Items (ordinal, h) with ``kept``: whether the item is the first of its hash."""
    first = items.groupBy("h").agg(F.min("ordinal").alias("first"))
    return items.join(first, items["h"].eqNullSafe(first["h"])).select(items["*"], (F.col("ordinal") == F.col("first")).alias("kept"))


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of edges (root, a, b) in order of root, b and a, the later ends that a kept item is near to.

    By the time b comes up, whether a is dropped has been decided, so the dropped items of one component are all there is to remember.
    """
    current, dropped = None, set()
    for batch in batches:
        found = []
        for root, a, b in zip(*(c.to_pylist() for c in batch.columns)):
            if root != current:
                current, dropped = root, set()
            if b not in dropped and a not in dropped:
                dropped.add(b)
                found.append(b)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], names=["ordinal"])


def _decide_here(edges: DataFrame, parts: Column | None = None) -> DataFrame:
    """Dropped ordinals of edges (root, a, b), each component in one task, or all of them in one."""
    dealt = edges.repartition(1) if parts is None else edges.repartition(parts)
    return dealt.sortWithinPartitions("root", "b", "a").select("root", "a", "b").mapInArrow(_decide, "ordinal long")


def _decide_at_large(edges: DataFrame, task_edges: int) -> DataFrame:
    """Dropped ordinals of edges (a, b) of components too large for a task.

    Open edges lead from an item that isn't dropped to one that is undecided. A round decides
    what has no open edge leading to it, and all that is near to that. Where rounds decide little, as in a long chain, the
    edges of the lowest ordinals, as many as a task takes, are decided in order. Each step decides something, so this ends
    whatever the edges.
    """
    open_edges, left = materialise(edges, "open"), edges.count()
    all_dropped = None
    while left:
        before = left
        ends = open_edges.select(F.col("b").alias("a")).distinct()
        settled = open_edges.select("a").distinct().join(ends, "a", "left_anti")
        dropped = materialise(open_edges.join(settled, "a", "left_semi").select(F.col("b").alias("ordinal")).distinct(), "dropped")
        open_edges, left = _still_open(open_edges, dropped)
        all_dropped = dropped if all_dropped is None else all_dropped.unionByName(dropped)
        if left and left > 0.8 * before:
            (cut,) = exact_percentiles(open_edges, F.col("b"), [min(1.0, task_edges / left)])
            low = open_edges.where(F.col("b") <= int(cut)).withColumn("root", F.lit(0))
            dropped = materialise(_decide_here(low), "dropped")
            # The items up to the cut that aren't dropped are kept, and drop what they are near to.
            beyond = open_edges.where(F.col("b") > int(cut))
            kept_below = beyond.where(F.col("a") <= int(cut)).join(dropped.withColumnRenamed("ordinal", "a"), "a", "left_anti")
            more = materialise(kept_below.select(F.col("b").alias("ordinal")).distinct(), "dropped")
            all_dropped = all_dropped.unionByName(dropped).unionByName(more)
            open_edges, left = _still_open(beyond, dropped.unionByName(more))
    return all_dropped


def _still_open(open_edges: DataFrame, dropped: DataFrame) -> tuple[DataFrame, int]:
    """Edges neither of whose ends has been dropped, and their number."""
    rest = open_edges
    for end in ("a", "b"):
        rest = rest.join(dropped.withColumnRenamed("ordinal", end), end, "left_anti")
    rest = materialise(rest.select("a", "b"), "open")
    drop_materialised(open_edges)
    return rest, rest.count()


def greedy_dedup(items: DataFrame, most: int, mode: str = "exact", hot: int = HOT, task_edges: int = TASK_EDGES) -> DataFrame:
    """Ordinals that stay when items come in order and one is dropped if it is near a kept one.

    Only the near pairs matter. Up to ``task_edges`` of them, one task walks through them in order. More are
    cut into connected components, each of which is walked through by itself, many at a time; components of more than ``task_edges``
    pairs are decided in rounds and stretches. The answer is the sequential one whatever the way.
    A negative distance keeps all. Items without a hash count as equal.
    """
    if most < 0:
        return items.select("ordinal")
    unique = distinct_hashes(items)
    edges = materialise(hamming_pairs(unique, most, mode, hot=hot).select("a", "b"), "edges")
    if edges.count() <= task_edges:
        dropped = _decide_here(edges.withColumn("root", F.lit(0)))
    else:
        roots = component_roots(edges)
        rooted = materialise(edges.join(roots.withColumnRenamed("node", "b"), "b").select("root", "a", "b"), "edges")
        large = rooted.groupBy("root").agg(F.count("*").alias("n")).where(F.col("n") > task_edges).select("root")
        large = materialise(large, "large")
        dropped = _decide_here(rooted.join(large, "root", "left_anti"), F.col("root"))
        beyond = rooted.join(large, "root", "left_semi").select("a", "b")
        if large.limit(1).count():
            dropped = dropped.unionByName(_decide_at_large(beyond, task_edges))
    dropped = materialise(dropped, "dropped")
    drop_materialised(edges)
    return unique.select("ordinal").join(dropped, "ordinal", "left_anti")


def leaked(evaluation: DataFrame, training: DataFrame, most: int) -> DataFrame:
    """Rows of ``evaluation`` (id, h) within ``most`` bits of some row of ``training`` (id, h)."""
    post = lambda df: df.select("id", "h", F.explode(bands(F.col("h"), most + 1)).alias("p")).select("id", "h", "p.band", "p.key")
    left, right = post(evaluation).alias("l"), post(training.select("id", "h").dropDuplicates(["h"])).alias("r")
    near = (F.col("l.band") == F.col("r.band")) & (F.col("l.key") == F.col("r.key")) & (hamming(F.col("l.h"), F.col("r.h")) <= most)
    return left.join(right, near, "left_semi").select("id").distinct()
