"""Quality classifier by positive-unlabelled learning.

Trusted positives are texts labelled good; the unlabelled sample is drawn from all texts, whatever their
label. A linear model over hashed word features and measurements of style minimises the non-negative
unbiased risk: the negative part of the risk is estimated as that of the unlabelled texts less the
prior times that of the positives, and where this estimate falls under zero its gradient is reversed.
The class prior comes from the labelled rows themselves, as the share of good ones among them with one
added to each class. A fifth of both samples is kept back from the fit, and the same risk on it sets the
scale and the shift that turn margins into probabilities.

Fitting uses at most ``SAMPLE`` positives and ``SAMPLE`` unlabelled texts, those whose hashed ids are least;
every text is scored. Of rows that share an id, one is sampled.

Defined cases: null and empty texts are scored as texts without words; without any positive the score of
every text is the prior; a null id is not learned from; a label that is null is ignored; an id labelled
twice is good if any of its labels is; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import doc_crc, tune

SAMPLE = 6000
HASH_BITS = 14
STYLE = 28
STYLE_WEIGHT, WORD_WEIGHT = 5.0, 0.3
THRESHOLD = 0.3
EPOCHS, BATCH, RATE, DECAY = 40, 512, 0.3, 1e-5
#: Scales and shifts of margins that the calibration chooses from.
SCALES, SHIFTS = np.geomspace(0.25, 4, 25), np.linspace(-6, 6, 49)

SCORE_SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def held_out() -> Column:
    """Whether a row's labels must not be learned from; false for a null id."""
    return F.coalesce(doc_crc() % 5 == 0, F.lit(False))


def style_of(text: str, raw: bytes, tokens: list[bytes]) -> np.ndarray:
    """Measurements of a text that don't depend on its vocabulary, and the same cut off at a third."""
    n, size = max(1, len(tokens)), max(1, len(raw))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    pairs = list(zip(tokens, tokens[1:], tokens[2:]))
    count = raw.count
    upper = size - len(raw.translate(None, bytes(range(65, 91))))
    measured = np.array(
        [
            0.2,
            np.log1p(len(tokens)) / 4,
            float(len(tokens) < 50),
            size / n / 8,
            10 * upper / size,
            float(2 * upper > size),
            20 * sum(map(count, (b"#", b"*", b"$", b"%", b"&"))) / size,
            20 * count(b"|") / size,
            10 * count(b"!") / size,
            10 * sum(map(count, (b".", b","))) / n,
            1 - len(set(tokens)) / n,
            1 - len(set(pairs)) / max(1, len(pairs)),
            1 - len(set(lines)) / max(1, len(lines)),
            min(3.0, n / max(1, len(lines)) / 40),
        ]
    )
    # Style outweighs words: these few measurements are the same in any vocabulary.
    return STYLE_WEIGHT * np.concatenate([measured, np.minimum(1.0, 3 * measured)])


class WordSlots(dict):
    """Memo from a word to its slot among the hashed features."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 400_000:
            self.clear()
        value = self[word] = STYLE + (xxhash.xxh3_64_intdigest(word.lower().strip(b".,;:")) & ((1 << HASH_BITS) - 1))
        return value


def features(text: str | None, slots: WordSlots) -> tuple[np.ndarray, np.ndarray]:
    """(positions, values): style first, then word features of equal length in all texts."""
    text = text or ""
    raw = text.encode()
    tokens = raw.split()
    style = style_of(text, raw, tokens)
    if not tokens:
        return np.arange(STYLE), style
    at, times = np.unique(np.fromiter(map(slots.__getitem__, tokens), dtype=np.int64, count=len(tokens)), return_counts=True)
    words = np.sqrt(times)
    return np.concatenate([np.arange(STYLE), at]), np.concatenate([style, WORD_WEIGHT * words / np.linalg.norm(words)])


def class_prior(labels: DataFrame) -> float:
    """Share of good rows among those that may be learned from."""
    row = labels.where(~held_out() & F.col("quality").isNotNull()).agg(F.count("*"), F.sum((F.col("quality") == 1).cast("long"))).first()
    return ((row[1] or 0) + 1) / (row[0] + 2)


def fit(positive: list[tuple[np.ndarray, np.ndarray]], unlabelled: list[tuple[np.ndarray, np.ndarray]], prior: float, seed: int = 1) -> np.ndarray:
    """Weights of the least non-negative risk, by adaptive gradient steps over mixed batches."""
    rng = np.random.default_rng(seed)
    weights = np.zeros(STYLE + (1 << HASH_BITS))
    if not positive or not unlabelled:
        weights[0] = np.log(prior / (1 - prior))
        return weights
    squares = np.full_like(weights, 1e-6)

    def flat(rows: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.concatenate([a for a, _ in rows]), np.concatenate([v for _, v in rows]), np.repeat(np.arange(len(rows)), [len(a) for a, _ in rows])

    def margins(part: tuple, n: int) -> np.ndarray:
        at, values, row = part
        return np.bincount(row, weights=values * weights[at], minlength=n)

    def gradient(part: tuple, slopes: np.ndarray) -> np.ndarray:
        at, values, row = part
        return np.bincount(at, weights=values * slopes[row], minlength=len(weights))

    steps = max(1, max(len(positive), len(unlabelled)) // BATCH)
    for epoch in range(EPOCHS):
        p_order, u_order = rng.permutation(len(positive)), rng.permutation(len(unlabelled))
        for p_at, u_at in zip(np.array_split(p_order, steps), np.array_split(u_order, steps)):
            if not len(p_at) or not len(u_at):
                continue
            p_part, u_part = flat([positive[i] for i in p_at]), flat([unlabelled[i] for i in u_at])
            p, u = margins(p_part, len(p_at)), margins(u_part, len(u_at))
            # Logistic loss: of a positive log(1 + e^-m), of a negative log(1 + e^m).
            p_sig, u_sig = 1 / (1 + np.exp(-p)), 1 / (1 + np.exp(-u))
            negative_risk = np.logaddexp(0, u).mean() - prior * np.logaddexp(0, p).mean()
            negative = gradient(u_part, u_sig / len(u_at)) - prior * gradient(p_part, p_sig / len(p_at))
            step = -negative if negative_risk < 0 else negative + prior * gradient(p_part, (p_sig - 1) / len(p_at))
            step += DECAY * weights
            squares += step * step
            weights -= RATE * (1 - epoch / EPOCHS) * step / np.sqrt(squares)
    return weights


def calibration(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[float, float]:
    """(scale, shift) of margins for the least non-negative risk of the logistic loss, on a grid."""

    def risk(scale: float, shift: float) -> float:
        p, u = scale * positive + shift, scale * unlabelled + shift
        negative = np.logaddexp(0, u).mean() - prior * np.logaddexp(0, p).mean()
        return prior * np.logaddexp(0, -p).mean() + max(0.0, negative)

    return min(((a, b) for a in SCALES for b in SHIFTS), key=lambda x: (risk(*x), abs(np.log(x[0])), abs(x[1])))


def fit_calibrated(positive: list, unlabelled: list, prior: float) -> np.ndarray:
    """Weights of :func:`fit` on four fifths of the samples, scaled and shifted by the rest."""
    weights = fit([f for i, f in enumerate(positive) if i % 5], [f for i, f in enumerate(unlabelled) if i % 5], prior)
    kept = [np.array([float(v @ weights[a]) for a, v in some[::5]]) for some in (positive, unlabelled)]
    if len(positive) >= 10 and len(unlabelled) >= 10:
        scale, shift = calibration(*kept, prior)
        weights *= scale
        # The first measurement is the same for all texts.
        weights[0] += shift / (STYLE_WEIGHT * 0.2)
    return weights


def sample_features(docs: DataFrame, ids: DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
    """Features of the documents with the given ids, of which the caller has bounded the number."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slots = WordSlots()
        for batch in batches:
            found = [features(t, slots) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "at": [a.astype("<i4").tobytes() for a, _ in found], "v": [v.astype("<f4").tobytes() for _, v in found]})

    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").mapInPandas(run, "doc_id long, at binary, v binary")
    rows = [(r[0], *r[1]) for r in rows.groupBy("doc_id").agg(F.min(F.struct("at", "v"))).collect()]
    rows.sort(key=lambda r: (r[0], r[1], r[2]))
    return [(np.frombuffer(r[1], dtype="<i4").astype(np.int64), np.frombuffer(r[2], dtype="<f4").astype(np.float64)) for r in rows]


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """(weights, prior). Only ids are sorted for the samples; the texts of the chosen ids are read then."""
    tune(docs.sparkSession)
    usable = labels.where(F.col("doc_id").isNotNull() & ~held_out())
    prior = class_prior(labels)

    def least(ids: DataFrame, salt: int) -> DataFrame:
        return ids.select("doc_id").distinct().orderBy(F.xxhash64("doc_id", F.lit(salt)), "doc_id").limit(sample)

    positive = sample_features(docs, least(usable.where(F.col("quality") == 1), 1))
    unlabelled = sample_features(docs, least(docs.where(F.col("doc_id").isNotNull() & ~held_out()), 2))
    return fit_calibrated(positive, unlabelled, prior), prior


def score_texts(texts: list[str | None], weights: np.ndarray, slots: WordSlots) -> np.ndarray:
    """Scores between 0 and 1."""
    margins = np.array([float(v @ weights[a]) for a, v in (features(t, slots) for t in texts)])
    return 1 / (1 + np.exp(-np.clip(margins, -40, 40)))


def score(docs: DataFrame, weights: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """Quality score of every row of ``docs`` (doc_id, text), in one pass without a shuffle."""
    tune(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slots = WordSlots()
        for batch in batches:
            scores = score_texts(list(batch["text"]), shared.value, slots)
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "held_out": batch["held_out"], "score": scores, "predicted": (scores >= threshold).astype(np.int32)})

    return docs.select("doc_id", "text", held_out().alias("held_out")).mapInPandas(run, SCORE_SCHEMA)
