"""Licence scans by a trained paragraph classifier.

A paragraph is a run of lines that hold words, so wrapped notices stay whole; comment marks, punctuation
and white space are no words, and a line of them alone ends a paragraph. A notice is a stretch of a paragraph
in which enough of one template's words stand in order. A sparse logistic regression over the word pairs and triples that a
paragraph shares with the licence templates names its licence families, or the class unknown,
which is learned from lines of the documents themselves; whatever else stands there adds nothing. Only the templates of
families that are named are compared, and every stretch that confirms one is found. The probability on the stretch is calibrated by a
temperature and a threshold, both set on examples that the fit didn't see. Of stretches that overlap, the
longest counts. A short notice that is denied (``not licensed under``) is none.

The fit uses the templates and at most ``SAMPLE`` paragraphs, those with the least hashes; every
paragraph of every text is scored.

Defined cases: null and empty texts have no paragraph; a stretch that shares no pair of words with a
template is unknown; a paragraph with several notices gives a row for each, with its span in characters;
repeated lines and rows each count; null ids are carried along; extra columns are ignored; an empty table
gives an empty result and a model that knows the templates alone.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tune

# Short notices and characteristic sentences of licence families.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.", "Licensed under the MIT license", "This project is licensed under the terms of the MIT license.", "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.", "Released under the Apache License 2.0", "SPDX-License-Identifier: Apache-2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.", "Licensed under the GPL v3", "SPDX-License-Identifier: GPL-3.0-or-later", "Released under the GNU GPL version 3",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.", "Licensed under the GPL v2", "SPDX-License-Identifier: GPL-2.0-only",
        "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License",
    ],
    "LGPL": [
        "Licensed under the GNU Lesser General Public License, version 2.1.", "Licensed under the LGPL v3", "SPDX-License-Identifier: LGPL-2.1-or-later",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    ],
    "AGPL-3.0": ["Licensed under the GNU Affero General Public License, version 3.", "Licensed under the AGPL v3", "SPDX-License-Identifier: AGPL-3.0-only"],
    "BSD": [
        "Licensed under the BSD 3-Clause License.", "Released under the BSD 2-Clause License", "SPDX-License-Identifier: BSD-3-Clause", "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ],
    "MPL-2.0": ["Licensed under the Mozilla Public License, Version 2.0.", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "SPDX-License-Identifier: MPL-2.0"],
    "ISC": ["Licensed under the ISC License.", "SPDX-License-Identifier: ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "SPDX-License-Identifier: CC-BY-4.0"],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "SPDX-License-Identifier: CC-BY-SA-4.0"],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "CC0": ["Licensed under CC0 1.0.", "To the extent possible under law, the author has dedicated all copyright to the public domain", "SPDX-License-Identifier: CC0-1.0"],
    "Unlicense": ["This is free and unencumbered software released into the public domain.", "SPDX-License-Identifier: Unlicense"],
    "EPL-2.0": ["Licensed under the Eclipse Public License, version 2.0.", "SPDX-License-Identifier: EPL-2.0"],
}
# Short names of the families, as headings, badges and package files have them.
NAMES = {
    "MIT": ["MIT"], "Apache-2.0": ["Apache 2.0"], "GPL-3.0": ["GPL 3.0", "GPLv3", "GPL v3"], "GPL-2.0": ["GPL 2.0", "GPLv2", "GPL v2"], "LGPL": ["LGPL", "LGPLv3", "LGPLv2.1"], "AGPL-3.0": ["AGPL 3.0", "AGPLv3"],
    "BSD": ["BSD", "BSD 3 Clause", "BSD 2 Clause"], "MPL-2.0": ["MPL 2.0", "Mozilla Public"], "ISC": ["ISC"], "CC-BY": ["CC BY 4.0"], "CC-BY-SA": ["CC BY SA 4.0"], "CC-BY-NC": ["CC BY NC 4.0"], "CC0": ["CC0", "CC0 1.0"],
    "Unlicense": ["Unlicense"], "EPL-2.0": ["EPL 2.0"], "Zlib": ["zlib"],
}
# Notices that are made of a family's short name.
FORMS = ["{} license", "license: {}", "distributed under the {} license", "covered by the {} license", "licensed under {}"]
# Other headings and sentences.
TEMPLATES["Apache-2.0"] += ["Apache License Version 2.0, January 2004", "Licensed to the Apache Software Foundation under one or more contributor license agreements"]
TEMPLATES["GPL-3.0"] += ["GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"]
TEMPLATES["GPL-2.0"] += ["GNU GENERAL PUBLIC LICENSE Version 2, June 1991"]
for _family, _kind, _version in (("GPL-3.0", "", 3), ("GPL-2.0", "", 2), ("LGPL", "Lesser ", 3), ("AGPL-3.0", "Affero ", 3)):
    TEMPLATES[_family] += [f"GNU {_kind}General Public License v{_version}"]
TEMPLATES["Zlib"] = ["This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software", "SPDX-License-Identifier: Zlib"]
for _family, _names in NAMES.items():
    TEMPLATES[_family] += [form.format(name) for name in _names for form in FORMS]
# Spellings that are taken as one, and words that deny the notice that follows them.
SPELLINGS = {"licence": "license", "licences": "licenses", "licenced": "licensed", "licencing": "licensing"}
DENIALS = {"not", "never", "no", "cannot", "without", "isn", "aren", "wasn", "neither", "nor"}
#: Words before a notice among which a denial counts, and the length from which a notice is a legal text, whose own words may be such.
DENIED_WITHIN, LEGAL_WORDS = 5, 12
#: Words without an n-gram of any template that part one place where notices may be from the next; the probability from which a family is looked for there.
GAP, NAMED = 30, 0.02

UNKNOWN = "unknown"
FAMILIES = [UNKNOWN, *TEMPLATES]

#: Paragraphs of documents that the fit sees, and what lies between two paragraphs (Java's syntax).
SAMPLE = 200
BLANK = "\\n[^\\p{L}\\p{N}]*\\n"
#: Examples made of each template, passes over them, step size.
VARIANTS, EPOCHS, RATE = 30, 400, 2.0
#: Share of a template's words that must stand in a paragraph in order.
CONFIRM = 0.8
#: Share of unknown paragraphs that may pass the probability threshold, and the least it is.
FALSE_SHARE, LEAST_SURE = 0.002, 0.5

_WORD = re.compile(r"[^\W_]+(?:\.\d+)*")
_STOP = re.compile(r"[.!?;:\n]")
HIT_SCHEMA = "doc_id long, paragraph long, family string, probability double, similarity double, text string, start long, end long"


def tokens(text: str) -> list[str]:
    return [SPELLINGS.get(w, w) for w in _WORD.findall(text.lower())]


def longest_common(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence of words."""
    row = [0] * (len(b) + 1)
    for x in a:
        diagonal = 0
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], diagonal + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def similarity(template: list[str], words: list[str]) -> float:
    """Share of a template's words that stand in order within a stretch of a paragraph.

    The stretch may be a quarter longer than the template, so that its words aren't picked from all over.
    """
    known = set(template)
    places = [i for i, w in enumerate(words) if w in known]
    span = len(template) + len(template) // 4 + 1
    best, done = 0, -1
    for n, i in enumerate(places):
        if i <= done:
            continue
        here = [words[j] for j in places[n : n + span] if j < i + span]
        if len(here) > best:
            best = max(best, longest_common(template, here))
    return best / len(template)


def common_places(a: list[str], b: list[str]) -> list[int]:
    """Places in ``b`` of a longest common subsequence of words."""
    table = [[0] * (len(b) + 1)]
    for x in a:
        above, row = table[-1], [0]
        for j, y in enumerate(b):
            row.append(above[j] + 1 if x == y else max(above[j + 1], row[j]))
        table.append(row)
    places, i, j = [], len(a), len(b)
    while i and j:
        if table[i][j] == table[i][j - 1]:
            j -= 1
        elif table[i][j] == table[i - 1][j]:
            i -= 1
        else:
            i, j = i - 1, j - 1
            places.append(j)
    return places[::-1]


def stretches(template: list[str], words: list[str]) -> list[tuple[int, int, int]]:
    """(first word, last word, words in common) of every separate stretch that confirms a template.

    Of overlapping stretches of one template, that with most words in common stays, then the shortest.
    """
    known = Counter(template)
    places = [i for i, w in enumerate(words) if w in known]
    span, needed = len(template) + len(template) // 4 + 1, words_to_confirm(template)
    found: list[tuple[int, int, int]] = []
    end = 0
    for n, i in enumerate(places):
        while end < len(places) and places[end] < i + span:
            end += 1
        if end - n < needed:
            continue
        at = common_places(template, [words[j] for j in places[n:end]])
        if len(at) >= needed:
            found.append((places[n + at[0]], places[n + at[-1]], len(at)))
    return apart(sorted(set(found), key=lambda f: (-f[2], f[1] - f[0], f[0])))


def apart(ranked: list[tuple]) -> list[tuple]:
    """Those of some (first, last, ...), best first, that overlap none before them that was taken."""
    taken: list[tuple] = []
    for one in ranked:
        if all(one[1] < other[0] or other[1] < one[0] for other in taken):
            taken.append(one)
    return sorted(taken)


def words_to_confirm(template: list[str]) -> int:
    """The least number of words whose share of the template reaches ``CONFIRM``."""
    return next(n for n in range(len(template) + 1) if n / len(template) >= CONFIRM)


def paragraphs(text: str) -> Iterator[list[re.Match]]:
    """The words of every paragraph: a line without a word lies between one paragraph and the next."""
    held: list[re.Match] = []
    for word in _WORD.finditer(text):
        if held and text.count("\n", held[-1].end(), word.start()) > 1:
            yield held
            held = []
        held.append(word)
    if held:
        yield held


class Classifier:
    """Weights by n-gram and class, the temperature and the threshold."""

    def __init__(self, grams: dict[tuple[str, ...], int], weights: np.ndarray, temperature: float, threshold: float):
        self.grams, self.weights, self.temperature, self.threshold = grams, weights, temperature, threshold
        self.templates = [(k, tokens(t)) for k, f in enumerate(FAMILIES) for t in TEMPLATES.get(f, [])]
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for _, t in self.templates for w in t}))}
        self.times = np.zeros((len(self.templates), len(self.vocabulary)), dtype=np.int64)
        for row, (_, t) in zip(self.times, self.templates):
            np.add.at(row, [self.vocabulary[w] for w in t], 1)
        self.needed = np.array([words_to_confirm(t) for _, t in self.templates])

    def features(self, words: list[str]) -> list[int]:
        """Numbers of the known n-grams in a paragraph."""
        found = {self.grams[g] for g in zip(words, words[1:]) if g in self.grams}
        if found:
            found |= {self.grams[g] for g in zip(words, words[1:], words[2:]) if g in self.grams}
        return sorted(found)

    def probabilities(self, found: list[int]) -> np.ndarray:
        z = (self.weights[found].sum(axis=0) + self.weights[-1]) / self.temperature
        e = np.exp(z - z.max())
        return e / e.sum()

    def possible(self, words: set[str]) -> list[tuple[int, list[str]]]:
        """(family number, template) that a text of these words can confirm: no stretch has more in common with one."""
        here = [self.vocabulary[w] for w in words & self.vocabulary.keys()]
        return [self.templates[i] for i in np.flatnonzero(self.times[:, here].sum(axis=1) >= self.needed)]

    def named(self, words: list[str]) -> set[int]:
        """Families that the regression sees anywhere in a paragraph.

        Each place where known n-grams lie close together is scored as a whole; what else stands there adds nothing.
        """
        at = [i for i, g in enumerate(zip(words, words[1:])) if g in self.grams]
        found: set[int] = set()
        first = 0
        for n in range(1, len(at) + 1):
            if n == len(at) or at[n] - at[n - 1] > GAP:
                p = self.probabilities(self.features(words[at[first] : at[n - 1] + 3]))
                found |= {k for k in range(1, len(p)) if p[k] >= NAMED}
                first = n
        return found

    def scan(self, text: str | None) -> list[tuple[int, str, float, float, str, int, int]]:
        """(line where the paragraph begins, family, probability, similarity, lines, start, end) of every notice of a text.

        The regression names the families of a paragraph; stretches of it that are close enough to one of their templates
        are its notices, if the regression is sure of the family on the stretch alone. A notice after a denial is none.
        ``start`` and ``end`` bound the notice in the text's characters; ``lines`` are the whole lines that it is on.
        """
        hits = []
        possible = self.possible(set(tokens(text))) if text else []
        for paragraph in paragraphs(text) if possible else ():
            words = [SPELLINGS.get(w, w) for w in (m.group().lower() for m in paragraph)]
            named, found = self.named(words), []
            for k, template in possible:
                for first, last, n in stretches(template, words) if k in named else ():
                    before = [i for i in range(max(0, first - DENIED_WITHIN), first) if words[i] in DENIALS]
                    # A denial reaches to the end of its sentence or line.
                    if len(template) < LEGAL_WORDS and any(not _STOP.search(text, paragraph[i].end(), paragraph[first].start()) for i in before):
                        continue
                    # Words that the template lacks may say which family it is, as a version does.
                    lost = len(template) - n
                    features = self.features(words[max(0, first - lost) : last + 1 + lost])
                    p = self.probabilities(features) if features else None
                    if p is not None and p[k] >= self.threshold and p[k] > p[0]:
                        found.append((first, last, k, float(p[k]), n / len(template)))
            # Of stretches that overlap the longest counts, as it says most.
            for first, last, k, p, close in apart(sorted(found, key=lambda f: (f[0] - f[1], -f[3], -f[4], f))):
                start, end = paragraph[first].start(), paragraph[last].end()
                stop = text.find("\n", end)
                lines = text[text.rfind("\n", 0, start) + 1 : stop if stop >= 0 else len(text)]
                hits.append((text.count("\n", 0, paragraph[0].start()), FAMILIES[k], p, close, lines, start, end))
        return hits


def variants(rng: np.random.Generator, words: list[str], filler: list[str]) -> list[str]:
    """A template as it may stand in a text: a word lost or changed, other words around it."""
    out = [w for w in words if rng.random() > 0.04]
    around = [[filler[i] for i in rng.integers(0, len(filler), rng.integers(0, 12))] if filler else [] for _ in range(2)]
    return [*around[0], *out, *around[1]]


def fit(paragraphs: list[str], seed: int = 3) -> Classifier:
    """Learn from the templates and from paragraphs of documents, which are unknown unless a template is in them."""
    rng = np.random.default_rng(seed)
    templates = {f: [tokens(t) for t in ts] for f, ts in TEMPLATES.items()}
    grams: dict[tuple[str, ...], int] = {}
    for ts in templates.values():
        for t in ts:
            for g in [*zip(t, t[1:]), *zip(t, t[1:], t[2:])]:
                grams.setdefault(g, len(grams))
    blank = Classifier(grams, np.zeros((len(grams) + 1, len(FAMILIES))), 1.0, 0.5)
    unknown = [w for w in map(tokens, paragraphs) if not any(similarity(t, w) >= CONFIRM for _, t in blank.possible(set(w)))]
    filler = sorted({w for words in unknown for w in words})
    rows: list[tuple[list[int], int]] = [(blank.features(w), 0) for w in unknown]
    rows += [([], 0)] * 20
    #: What each example was made of: 0 what is unknown, and a number for each template.
    sources = [0] * len(rows)
    # Pieces of templates are unknown too, unless they are a template themselves: a few words of a notice name no family.
    for k, ts in enumerate(templates.values(), 1):
        for t in ts:
            made = [blank.features(variants(rng, t, filler)) for _ in range(VARIANTS)]
            # What has lost all its n-grams shows no family.
            rows += [(features, k) for features in made if features]
            sources += [len(set(sources))] * (len(rows) - len(sources))
            for _ in range(VARIANTS // 6):
                at, size = rng.integers(0, len(t)), rng.integers(2, 4)
                piece = t[at : at + size]
                if len(t) > 8 and not any(similarity(other, piece) >= CONFIRM for _, other in blank.possible(set(piece))):
                    rows.append((blank.features(piece), 0))
                    sources.append(0)
    x = np.zeros((len(rows), len(grams) + 1), dtype=np.float32)
    for row, (found, _) in zip(x, rows):
        row[found] = 1
    x[:, -1] = 1
    y = np.array([k for _, k in rows])
    check = rng.random(len(rows)) < 0.2
    weights = np.zeros((x.shape[1], len(FAMILIES)), dtype=np.float32)
    one_hot, use = np.eye(len(FAMILIES), dtype=np.float32)[y], ~check
    # Each template counts the same, and what is unknown as much as a family does on the average.
    origin = np.array(sources)
    share = (1 / np.maximum(1, np.bincount(origin[use])))[origin[use]] * np.where(y[use] == 0, origin.max() / max(1, len(TEMPLATES)), 1.0)
    # Equal examples are one with their shares added up; most unknown lines have no known n-gram at all.
    kinds: dict[tuple, int] = {}
    number = np.array([kinds.setdefault((tuple(found), k), len(kinds)) for (found, k), taken in zip(rows, use) if taken], dtype=np.int64)
    first = np.flatnonzero(use)[np.unique(number, return_index=True)[1]] if len(number) else np.zeros(0, dtype=np.int64)
    balance = (np.bincount(number, weights=share) / share.sum())[:, None].astype(np.float32)
    seen, wanted = x[first], one_hot[first]
    for epoch in range(EPOCHS):
        z = seen @ weights
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        weights -= RATE * (seen.T @ (balance * (p - wanted)) + 1e-5 * weights)
    # Small weights go, so that the model is sparse.
    weights[:-1][np.abs(weights[:-1]) < 0.01] = 0
    z = x[check] @ weights

    def likelihood(t: float) -> float:
        e = np.exp((z - z.max(axis=1, keepdims=True)) / t)
        return float(np.log(e[np.arange(len(e)), y[check]] / e.sum(axis=1) + 1e-12).mean())

    temperature = max((0.05 * 1.2**i for i in range(24)), key=likelihood) if check.any() else 1.0
    e = np.exp((z - z.max(axis=1, keepdims=True)) / temperature)
    e /= e.sum(axis=1, keepdims=True)
    outside = e[y[check] == 0, 1:].max(axis=1) if (y[check] == 0).any() else np.zeros(1)
    return Classifier(grams, weights, temperature, float(max(LEAST_SURE, np.quantile(outside, 1 - FALSE_SHARE))) if len(outside) else LEAST_SURE)


def train(docs: DataFrame, sample: int = SAMPLE) -> Classifier:
    """Fit on the templates and a bounded sample of paragraphs, drawn from all paragraphs of all texts by their hashes."""
    parts = docs.select(F.explode(F.split("text", BLANK)).alias("p")).where(F.col("p").rlike("[\\p{L}\\p{N}]")).withColumn("h", F.xxhash64("p"))
    # Hashes are even, so a bound under which twice the sample is expected lets few rows through; equal ones are one.
    distinct = parts.agg(F.approx_count_distinct("h")).first()[0]
    bound = -(1 << 63) + int((1 << 64) * min(1.0, 2 * sample / max(1, distinct))) - 1
    few = parts.where(F.col("h") <= bound).groupBy("h").agg(F.min("p").alias("p"))
    drawn = few.orderBy("h").limit(sample).select("p").collect()
    blank = Classifier({}, np.zeros((1, len(FAMILIES))), 1.0, 0.5)
    lines = []
    for text in sorted(r[0] for r in drawn):
        for paragraph in paragraphs(text):
            words = [SPELLINGS.get(w, w) for w in (m.group().lower() for m in paragraph)]
            # A line of a wrapped notice isn't unknown, though it confirms no template by itself.
            if not any(stretches(t, words) for _, t in blank.possible(set(words))):
                lines += text[paragraph[0].start() : paragraph[-1].end()].split("\n")
    return fit(lines)


def scan(docs: DataFrame, model: Classifier) -> DataFrame:
    """One row per licence notice of every text of ``docs`` (doc_id, text), in one pass without a shuffle."""
    tune(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.grams, model.weights, model.temperature, model.threshold))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Classifier(*shared.value)
        names = ["doc_id", "paragraph", "family", "probability", "similarity", "text", "start", "end"]
        for batch in batches:
            rows = [(doc, *hit) for doc, text in zip(batch["doc_id"].astype("Int64"), batch["text"]) for hit in known.scan(text)]
            yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    return docs.select("doc_id", "text").mapInPandas(run, HIT_SCHEMA)
