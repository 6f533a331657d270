"""Quality rules as a short-circuit cascade.

A rule looks at a text and says whether to reject it. All rules are conjunctive, so the verdict does
not depend on their order, but the cost does: the cascade measures each rule's cost and its rejection
rate on a bounded sample and evaluates the rules by rejection per second, stopping at the first hit.

Defined cases: a null or empty text has no words and is rejected by ``few_words``; repeated rows each
get their own verdict; a null id is carried along, and labels or languages are never looked at; a text of any
length is judged whole; an empty table gives an empty result; other columns of the input are ignored
by :func:`quality_verdicts` and kept by :func:`filter_by_quality`, whatever their names.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator
from functools import cached_property

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, tune

#: Characters counted as symbols.
SYMBOLS = "#*$%&|<>"
#: Rows of the sample on which cost and selectivity are estimated.
SAMPLE_ROWS = 200

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))

STATS_SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, rejected_by string"
)


class TextView:
    """A text whose measurements are computed when first asked for and then kept."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def raw(self) -> bytes:
        return self.text.encode()

    @cached_property
    def words(self) -> list[bytes]:
        return self.raw.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, SPACES))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def _lines(self) -> tuple[int, int]:
        lines = [x for x in self.raw.split(b"\n") if x.strip()]
        return len(lines), len(lines) - len(set(lines))

    @cached_property
    def n_lines(self) -> int:
        return self._lines[0]

    @cached_property
    def n_dup_lines(self) -> int:
        return self._lines[1]

    @cached_property
    def n_upper(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, _UPPER))

    @cached_property
    def n_lower(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, _LOWER))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside some three-word window that the text holds at least twice."""
        w = self.words
        seen = Counter(zip(w, w[1:], w[2:]))
        if len(seen) == max(0, len(w) - 2):
            return 0
        covered, end = 0, 0
        for i, gram in enumerate(zip(w, w[1:], w[2:])):
            if seen[gram] > 1:
                covered += i + 3 - max(i, end)
                end = i + 3
        return covered


#: Each rule: what it rejects. Thresholds are in integers so that any engine decides alike.
RULES: dict[str, Callable[[TextView], bool]] = {
    "few_words": lambda t: t.n_words < 50,
    "repeated_phrases": lambda t: 100 * t.n_repeat_words > 50 * t.n_words,
    "symbols": lambda t: 20 * t.n_symbols > t.word_chars,
    "repeated_lines": lambda t: 2 * t.n_dup_lines > t.n_lines,
    "word_length": lambda t: t.word_chars > 15 * t.n_words or 2 * t.word_chars < 3 * t.n_words,
    "capitals": lambda t: 2 * t.n_upper > t.n_upper + t.n_lower and t.n_upper > 0,
}


def plan_cascade(sample: list[str | None], rules: dict[str, Callable[[TextView], bool]] = RULES) -> list[dict]:
    """Cost, selectivity and order of the rules from a sample of texts.

    Every rule is timed on fresh views, so its cost includes all that it must measure itself.
    An empty sample keeps the order in which the rules are written.
    """
    found = []
    for name, rule in rules.items():
        views = [TextView(t) for t in sample]
        began = time.perf_counter()
        hits = sum(bool(rule(v)) for v in views)
        cost = (time.perf_counter() - began) / max(1, len(views))
        found.append({"rule": name, "cost_s": cost, "selectivity": hits / max(1, len(views))})
    if sample:
        found.sort(key=lambda r: (-(r["selectivity"] + 1e-6) / max(r["cost_s"], 1e-9), r["rule"]))
    return found


def sample_texts(docs: DataFrame, rows: int = SAMPLE_ROWS) -> list[str | None]:
    """At most ``rows`` texts for the estimate; Spark reads only as many files as that takes."""
    return [r[0] for r in docs.select("text").limit(rows).collect()]


def first_reject(view: TextView, order: list[str], rules: dict[str, Callable[[TextView], bool]] = RULES) -> str | None:
    """The first rule, in cascade order, that rejects the text."""
    return next((name for name in order if rules[name](view)), None)


def quality_verdicts(docs: DataFrame, order: list[str] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Base measurements and the cascade's verdict for every row of ``docs`` (doc_id, text).

    One pass without a shuffle. ``rejected_by`` names the rule that fired first in cascade order, so it
    may differ between orders; ``kept`` may not.
    """
    tune(docs.sparkSession)
    if order is None:
        order = [r["rule"] for r in plan_cascade(sample_texts(docs, sample_rows))]

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc_id"], batch["text"]):
                v = TextView(text)
                hit = first_reject(v, order)
                base = RULES["few_words"](v) or RULES["repeated_phrases"](v)
                rows.append((doc, v.n_words, v.word_chars, v.n_symbols, v.n_dup_lines, v.n_repeat_words, base, hit is None, hit))
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in STATS_SCHEMA.split(", ")])
            out["doc_id"] = batch["doc_id"].astype("Int64").to_numpy()
            yield out

    return docs.select("doc_id", "text").mapInPandas(judge, STATS_SCHEMA)


def filter_by_quality(docs: DataFrame, order: list[str] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with all their columns. Measures only what the cascade asks for."""
    tune(docs.sparkSession)
    if order is None:
        order = [r["rule"] for r in plan_cascade(sample_texts(docs, sample_rows))]

    @F.pandas_udf("boolean")
    def keep(texts: pd.Series) -> pd.Series:
        return pd.Series([first_reject(TextView(t), order) is None for t in texts], dtype=bool)

    return docs.where(keep(F.col("text")))
