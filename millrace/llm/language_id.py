"""Language identification by words first, then shorter and shorter character n-grams.

A known word is scored by its log frequency in each language. An unknown word is looked up by its
character n-grams of five, then four, down to one character; the longest length of which the model
knows an n-gram decides for that word. The score of a text is the sum over its words.

A word is a run of letters in lower case; batches of texts are cut by table look-ups over their code points.

Counts cover every training text, and every counted word and n-gram decides. The driver broadcasts the most
frequent ones, ``top_words`` words and ``top_grams`` n-grams of each length per language at most, with their counts
in all languages. Words of a text that aren't among them are looked up by joins to all counts, which stay
in a distributed table; if the broadcast holds every entry, no join is needed.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so is every text when no
labelled row exists. Null languages are not learned from; null ids are scored and learned from; repeated
rows count as often as they stand there; a text of any length is one run at most; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import doc_crc, drop_materialised, materialise, mix64, text_runs, trim, tune

TOP_WORDS, TOP_GRAMS, LONGEST = 50_000, 4_000, 5
#: Bytes of text cut together; words whose n-grams are counted together.
RUN_BYTES, WORDS_AT_ONCE = 2 << 20, 60_000
#: Steps of a doubling in which counts are compared with the bounds of the broadcast.
STEPS = 8
#: Times that an entry counts for in a language that never showed it.
UNSEEN = 0.5
#: Nats a word by which a label must fall behind the best language to be contradicted. On the 0.1 tables right labels
#: fall behind by up to 2.8, texts of two languages included, and 99 % of wrong ones by over 4.1.
CONTRADICTED = 3.5

UNKNOWN = "und"

PREDICTION_SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


def _letter(ch: str) -> int:
    """The lower case of a letter, else a space."""
    low = ch.lower()
    return (ord(low) if len(low) == 1 else ord(ch)) if ch.isalpha() else 32


_LETTERS: list[np.ndarray] = []


def cut_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, number of each word of all texts in a row, words of each text)."""
    if not _LETTERS:
        _LETTERS.append(np.array([_letter(chr(c)) for c in range(65536)], dtype=np.uint32))
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    whole = "\n".join(texts.to_pylist()) + "\n"
    points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    folded = _LETTERS[0][np.minimum(points, 65535)]
    far = np.flatnonzero(points >= 65536)
    if len(far):
        kinds, at = np.unique(points[far], return_inverse=True)
        folded[far] = np.array([_letter(chr(c)) for c in kinds], dtype=np.uint32)[at]
    inside = folded != 32
    after = np.concatenate([[False], inside[:-1]])
    starts = np.flatnonzero(inside & ~after)
    bounds = np.concatenate([[0], np.cumsum(pc.utf8_length(texts).to_numpy().astype(np.int64) + 1)])
    counts = np.diff(np.searchsorted(starts, bounds))
    # Every word with the space after it.
    row = folded[inside | after].tobytes().decode("utf-32-le", "surrogatepass")
    pieces = pc.split_pattern(pa.array([row[:-1]], pa.large_string()), " ").values if len(starts) else pa.array([], pa.large_string())
    coded = pieces.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), counts


def held_out() -> Column:
    """Whether a row's language must not be learned from; false for a null id."""
    return F.coalesce(doc_crc() % 4 == 2, F.lit(False))


def word_counts(labelled: DataFrame) -> DataFrame:
    """(lang, word, n) over all labelled texts (lang, text), counted in the tasks before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_runs(batches, RUN_BYTES):
            names, at, counts = cut_words(batch.column("text"))
            langs = batch.column("lang").dictionary_encode()
            of_word = np.repeat(langs.indices.to_numpy(), counts)
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                times = np.bincount(at[of_word == k], minlength=len(names))
                seen = np.flatnonzero(times)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(seen), pa.string()), names.take(pa.array(seen)).cast(pa.string()), pa.array(times[seen])], names=["lang", "word", "n"])
            trim()

    parts = labelled.select("lang", "text").mapInArrow(count, "lang string, word string, n long")
    return parts.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, top_words: int, top_grams: int) -> DataFrame:
    """The entries of each (lang, size) over a count that at most ``top_words`` or ``top_grams`` of them exceed.

    The driver gets the number of entries by language, size and eighth of a doubling, so nothing is sorted.
    """
    level = F.floor(F.log2("n") * STEPS).cast("int")
    by_size: dict[tuple, list[tuple[int, int]]] = {}
    for lang, size, at, n in counts.groupBy("lang", "size", level.alias("level")).agg(F.count("*")).collect():
        by_size.setdefault((lang, size), []).append((at, n))
    floors = []
    for (lang, size), levels in by_size.items():
        room, floor = top_grams if size else top_words, None
        for at, n in sorted(levels, reverse=True):
            room -= n
            if room < 0:
                break
            floor = at
        if floor is not None:
            floors.append((lang, size, floor))
    least = counts.sparkSession.createDataFrame(floors, "lang string, size int, least int")
    return counts.join(F.broadcast(least), ["lang", "size"]).where(level >= F.col("least"))


def gram_hashes(points: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of every window of ``n`` code points."""
    h = np.full(max(0, len(points) - n + 1), n, dtype=np.uint64)
    for k in range(n):
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + points[k : k + len(h)])
    return h


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.uint64)


def _marked_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of some words in a row, each between angle brackets, and the word of each."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 2
    return code_points("".join([f"<{w}>" for w in words])), np.repeat(np.arange(len(words)), lengths)


def _word_runs(batches: Iterable[pa.RecordBatch], size: int = WORDS_AT_ONCE) -> Iterator[pa.Table]:
    """Batches put together until they have ``size`` rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= size:
            yield pa.Table.from_batches(held)
            held = []
    if held and any(b.num_rows for b in held):
        yield pa.Table.from_batches(held)


class Model:
    """Log frequencies per language: tables[0] of words, tables[n] of n-grams by their sorted hashes.

    ``rest`` is None if the tables hold every counted entry; else it holds them all, as (size, entry, word,
    times by language), and ``totals`` by size and language belong to it.
    """

    def __init__(self, languages: list[str], tables: dict[int, tuple], rest: DataFrame | None = None, totals: dict[int, np.ndarray] | None = None):
        self.rest, self.totals = rest, totals
        self.languages, self.data = languages, (languages, tables)
        self.words = {w: i for i, w in enumerate(tables[0][0])}
        self.word_scores = tables[0][1]
        self.grams = {n: tables[n] for n in range(1, LONGEST + 1)}

    def vectors(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(scores by language, whether known) of each word; a word without one known letter is unknown."""
        out, known = np.zeros((len(words), len(self.languages))), np.zeros(len(words), dtype=bool)
        rest = []
        for i, w in enumerate(words):
            at = self.words.get(w)
            if at is None:
                rest.append(i)
            else:
                out[i], known[i] = self.word_scores[at], True
        for n in range(LONGEST, 0, -1):
            keys, scores = self.grams[n]
            if not rest or not len(keys):
                continue
            points, owner = _marked_points([words[i] for i in rest])
            h = gram_hashes(points, n)
            inside = owner[: len(h)] == owner[n - 1 :]
            h, owner = h[inside], owner[: len(h)][inside]
            at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            hit = keys[at] == h
            hits = np.bincount(owner[hit], minlength=len(rest))
            found = np.flatnonzero(hits)
            rows = np.array(rest)[found]
            for k in range(len(self.languages)):
                sums = np.bincount(owner[hit], weights=scores[at[hit], k], minlength=len(rest))
                out[rows, k] = sums[found] / hits[found]
            known[rows] = True
            rest = [i for i, seen in zip(rest, hits) if not seen]
        return out, known


class Predictor:
    """Scores runs of texts with a model."""

    def __init__(self, model: Model):
        if model.rest is not None:
            raise ValueError("this model's words must be looked up by joins")
        self.model = model

    def predict(self, texts: list[str | None] | pa.Array) -> list[tuple[str, float]]:
        """Language and score of whole texts.

        The score is the posterior of the best language, with the evidence of all words divided by the
        square root of their number, since words of a text aren't independent.
        """
        return [x[:2] for x in self.judge(texts)]

    def judge(self, texts: list[str | None] | pa.Array, labels: list[str | None] | None = None) -> list[tuple[str, float, float]]:
        """The same, and how many nats a word the text's label falls behind the best language; 0 without a known label."""
        languages = self.model.languages
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        names, at, counts = cut_words(texts)
        if not languages:
            return [(UNKNOWN, 0.0, 0.0)] * len(texts)
        scores, known = self.model.vectors(names.to_pylist())
        text = np.repeat(np.arange(len(counts)), counts)
        total = np.stack([np.bincount(text, weights=scores[at, k], minlength=len(counts)) for k in range(len(languages))], axis=1)
        n = np.bincount(text, weights=known[at], minlength=len(counts))
        best = total.argmax(axis=1)
        spread = (total - total[np.arange(len(best)), best][:, None]) / np.sqrt(np.maximum(n, 1.0))[:, None]
        score = 1.0 / np.exp(spread).sum(axis=1)
        top = total[np.arange(len(best)), best]
        own = np.array([languages.index(x) if x in languages else -1 for x in labels or [None] * len(best)], dtype=np.int64)
        behind = np.where(own >= 0, (top - total[np.arange(len(best)), own]) / np.maximum(n, 1.0), 0.0)
        return [(languages[b], float(s), float(g)) if c else (UNKNOWN, 0.0, 0.0) for b, s, g, c in zip(best, score, behind, counts)]


def train(labelled: DataFrame, top_words: int = TOP_WORDS, top_grams: int = TOP_GRAMS) -> Model:
    """Learn from labelled texts (lang, text). N-grams are counted over all words, not only the kept ones."""
    counts = word_counts(labelled.where(F.col("lang").isNotNull()))
    spark = counts.sparkSession
    tune(spark)

    def gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _word_runs(batches):
            langs = table.column("lang").combine_chunks().dictionary_encode()
            words, times, lang = table.column("word").to_pylist(), table.column("n").to_numpy(), langs.indices.to_numpy()
            for k, name in enumerate(langs.dictionary.to_pylist()):
                mine = np.flatnonzero(lang == k)
                points, owner = _marked_points([words[i] for i in mine])
                for n in range(1, LONGEST + 1):
                    h, own = gram_hashes(points, n), owner[: max(0, len(points) - n + 1)]
                    inside = own == owner[n - 1 :]
                    keys, at = np.unique(h[inside], return_inverse=True)
                    sums = np.bincount(at, weights=times[mine][own[inside]]).astype(np.int64)
                    columns = [pa.array([name] * len(keys), pa.string()), pa.array(np.full(len(keys), n, np.int32)), pa.array(keys.view(np.int64)), pa.array([""] * len(keys), pa.string()), pa.array(sums, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, names=["lang", "size", "entry", "word", "n"])

    grams = counts.mapInArrow(gram_counts, "lang string, size int, entry long, word string, n long")
    grams = grams.groupBy("lang", "size", "entry", "word").agg(F.sum("n").alias("n"))
    entries = grams.unionByName(counts.select("lang", F.lit(0).alias("size"), F.xxhash64("word").alias("entry"), "word", "n"))
    entries = materialise(entries, "lang-entries")
    sums = entries.groupBy("lang", "size").agg(F.sum("n")).collect()
    languages = sorted({r[0] for r in sums})
    at = {lang: i for i, lang in enumerate(languages)}
    all_totals = {n: np.ones(len(languages)) for n in range(LONGEST + 1)}
    for lang, n, total in sums:
        all_totals[n][at[lang]] += total
    times = F.array(F.lit(UNSEEN), *[F.coalesce(F.max(F.when(F.col("lang") == lang, F.col("n"))).cast("double"), F.lit(UNSEEN)) for lang in languages])
    rest = materialise(entries.groupBy("size", "entry", "word").agg(F.slice(times, 2, max(1, len(languages))).alias("times")), "lang-model")
    head = rest.join(most_frequent(entries, top_words, top_grams).select("size", "entry", "word").distinct(), ["size", "entry", "word"])
    head, tables, held = materialise(head, "lang-head"), {}, 0
    for n, totals in all_totals.items():
        # Arrow columns: rows of Python objects would take many times the driver's memory.
        part = head.where(F.col("size") == n).select("word" if n == 0 else "entry", "times").toArrow()
        keys = np.array(part.column(0).to_pylist(), dtype=object) if n == 0 else part.column(0).to_numpy().astype(np.uint64)
        order = np.argsort(keys)
        matrix = part.column(1).combine_chunks().flatten().to_numpy().reshape(len(keys), len(languages))
        # What a language never showed is as rare in all languages, however little text they had.
        shares = np.where(matrix[order] < 1, UNSEEN / totals.max(initial=1.0), matrix[order] / totals)
        tables[n] = (list(keys[order]) if n == 0 else keys[order]), np.log(shares)
        held += len(keys)
    drop_materialised(entries, head)
    if held == rest.count():
        return Model(languages, tables)
    return Model(languages, tables, rest, all_totals)


def word_vectors(words: DataFrame, model: Model) -> DataFrame:
    """(word, scores by language) of some distinct words, by all counts; scores are null without one known letter."""

    def logs(n: int) -> Column:
        unseen = F.lit(float(np.log(UNSEEN / model.totals[n].max())))
        return F.array(*[F.when(F.col("times")[k] < 1, unseen).otherwise(F.log(F.col("times")[k] / F.lit(float(total)))) for k, total in enumerate(model.totals[n])]).alias("scores")

    def windows(n: int):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                points, owner = _marked_points(batch["word"].tolist())
                h, own = gram_hashes(points, n), owner[: max(0, len(points) - n + 1)]
                inside = own == owner[n - 1 :]
                yield pd.DataFrame({"word": batch["word"].to_numpy(dtype=object)[own[inside]], "entry": h[inside].view(np.int64)})

        return run

    part = materialise(words.join(model.rest.where(F.col("size") == 0).select("word", logs(0)), "word", "left"), "lang-vectors")
    found = part.where(F.col("scores").isNotNull())
    for n in range(LONGEST, 0, -1):
        unknown = part.where(F.col("scores").isNull()).select("word")
        if not unknown.limit(1).count():
            return found
        grams = unknown.mapInPandas(windows(n), "word string, entry long").join(model.rest.where(F.col("size") == n).select("entry", logs(n)), "entry")
        hits = grams.groupBy("word").agg(F.array(*[F.avg(F.col("scores")[k]) for k in range(len(model.languages))]).alias("scores"))
        part = materialise(unknown.join(hits, "word", "left"), "lang-vectors")
        found = found.unionByName(part.where(F.col("scores").isNotNull()))
    return found


def predict_by_joins(docs: DataFrame, model: Model, keys: list[str]) -> DataFrame:
    """(keys, lang_pred, score) of every row of ``docs`` (keys, text), with words outside the broadcast looked up by joins."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model.data)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model(*shared.value)
        uid = TaskContext.get().partitionId() << 36
        for batch in text_runs(batches, RUN_BYTES):
            names, at, counts = cut_words(batch.column("text"))
            text, rows = np.repeat(np.arange(len(counts)), counts), len(counts)
            place = np.fromiter((known.words.get(w, -1) for w in names.to_pylist()), dtype=np.int64, count=len(names))[at]
            here = place >= 0
            sums = [np.bincount(text[here], weights=known.word_scores[place[here], k], minlength=rows) for k in range(len(known.languages))]
            # The words of each text that aren't in the broadcast, with their numbers.
            pairs, times = np.unique(text[~here] * max(1, len(names)) + at[~here], return_counts=True)
            tail = pa.StructArray.from_arrays([names.take(pa.array(pairs % max(1, len(names)))).cast(pa.string()), pa.array(times.astype(np.int64))], names=["word", "n"])
            ends = np.cumsum(np.bincount(pairs // max(1, len(names)), minlength=rows))
            columns = [
                pa.array(uid + np.arange(rows)), pa.array(counts > 0), pa.array(np.bincount(text[here], minlength=rows).astype(np.float64)),
                pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * len(sums), pa.int32()), pa.array(np.stack(sums, axis=1).ravel() if sums else [], pa.float64())),
                pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), tail),
            ]
            columns += [batch.column(k).cast(pa.int64()) if k == "doc_id" else batch.column(k) for k in keys]
            yield pa.RecordBatch.from_arrays(columns, names=["uid", "lettered", "head_known", "head", "tail", *keys])
            uid += rows
            trim()

    types = {f.name: f.dataType.simpleString() for f in docs.schema.fields} | {"doc_id": "bigint"}
    schema = "uid long, lettered boolean, head_known double, head array<double>, tail array<struct<word: string, n: long>>, "
    summed = materialise(docs.select(*keys, "text").mapInArrow(run, schema + ", ".join(f"{k} {types[k]}" for k in keys)), "lang-sums")
    tail = summed.select("uid", F.explode("tail").alias("t")).select("uid", "t.word", "t.n")
    vectors = word_vectors(tail.select("word").distinct(), model)
    more = [F.sum(F.col("n") * F.col("scores")[k]) for k in range(len(model.languages))]
    by_text = tail.join(vectors, "word").groupBy("uid").agg(F.sum("n").alias("tail_known"), F.array(*more).alias("more"))
    total = F.when(F.col("more").isNull(), F.col("head")).otherwise(F.zip_with("head", "more", lambda a, b: a + b))
    scored = summed.drop("tail").join(by_text, "uid", "left").withColumn("total", total).withColumn("best", F.array_max("total"))
    spread = F.sqrt(F.greatest(F.col("head_known") + F.coalesce("tail_known", F.lit(0)), F.lit(1.0)))
    parts = F.aggregate(F.transform("total", lambda x: F.exp((x - F.col("best")) / spread)), F.lit(0.0), lambda a, x: a + x)
    languages = F.array(*map(F.lit, model.languages))
    named = F.element_at(languages, F.array_position("total", F.col("best")).cast("int"))
    lettered = F.col("lettered")
    more = []
    if "lang" in keys:
        place = F.array_position(languages, F.col("lang")).cast("int")
        gap = (F.col("best") - F.element_at("total", F.when(place > 0, place).otherwise(1))) / F.pow(spread, 2)
        more = [F.when(lettered & (place > 0), gap).otherwise(0.0).alias("behind")]
    return scored.select(*keys, *more, F.when(lettered, named).otherwise(UNKNOWN).alias("lang_pred"), F.when(lettered, 1 / parts).otherwise(0.0).alias("score"))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """The predicted language of every row of ``docs`` (doc_id, text): one pass, and a shuffle of the words that aren't broadcast."""
    tune(docs.sparkSession)
    if model.rest is not None:
        return predict_by_joins(docs.select("doc_id", "text", held_out().alias("held_out")), model, ["doc_id", "held_out"])
    shared = docs.sparkSession.sparkContext.broadcast(model.data)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = Predictor(Model(*shared.value))
        for batch in text_runs(batches, RUN_BYTES):
            names, scores = zip(*predictor.predict(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return docs.select("doc_id", "text", held_out().alias("held_out")).mapInArrow(run, PREDICTION_SCHEMA)


def filter_by_language(docs: DataFrame, model: Model, least: float = 0.5, contradicted: float = CONTRADICTED) -> DataFrame:
    """The rows of ``docs`` whose language is recognised, with all their columns.

    A row goes if it has no letter, if its best language has a score under ``least``, or if its own ``lang``, one
    that the model knows, falls ``contradicted`` nats a word behind the best; a text of two languages, one of
    them its own, is within that. A null ``lang`` contradicts nothing.
    """
    tune(docs.sparkSession)
    good = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least) & (F.col("behind") < contradicted)
    if model.rest is not None:
        number, found_at = (f"{name}_of_{'_'.join(docs.columns)}" for name in ("row", "found"))
        rows = materialise(docs.withColumn(number, F.monotonically_increasing_id()), "lang-rows")
        asked = rows.select(F.col(number).alias("row"), "text", "lang")
        found = predict_by_joins(asked, model, ["row", "lang"]).where(good).select(F.col("row").alias(found_at))
        return rows.join(found.hint("shuffle_hash"), F.col(number) == F.col(found_at), "left_semi").select(*docs.columns)
    shared = docs.sparkSession.sparkContext.broadcast(model.data)

    @F.pandas_udf("boolean")
    def keep(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        predictor = Predictor(Model(*shared.value))
        for texts, langs in batches:
            judged = predictor.judge(texts.tolist(), langs.tolist())
            yield pd.Series([lang != UNKNOWN and score >= least and behind < contradicted for lang, score, behind in judged], dtype=bool)

    return docs.where(keep(F.col("text"), F.col("lang")))
