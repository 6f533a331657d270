"""The text operators against brute force, round trips and odd tables."""

import hashlib
import itertools
import json
import math
import re
import resource
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from millrace.llm import chat_format, common, context_mixing, decontaminate, jaccard_join, language_id, license_scan, packing, pu_quality, quality_rules, token_blocks, tokens

PLAIN: dict = {}
TEMPLATE = "This project is licensed under the terms of the MIT license."
WORDS = "ka lo mi ren tu sa vek pol dur nim".split()


def text(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(WORDS, rng.integers(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows and ids, copies, a column that clashes with inner names."""
    rows = [(1, text(1, 80)), (2, text(1, 80)), (2, text(1, 80)), (3, None), (4, ""), (5, " \n\t "), (None, text(2, 60)), (6, "a b"), (7, "a  B"), (8, text(3, 5000)), (9, text(1, 79) + " ende"), (10, "1234 !!! 55"), (None, None)]
    return spark.createDataFrame([(d, t, "en" if d and d % 2 else None, "x", 0) for d, t in rows], "doc_id long, text string, lang string, source string, set_id int")


def empty(odd):
    return odd.where("false")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a<|text|>b"]), st.lists(st.sampled_from(["<|end|>", "<", "\\", "<\\|end|>", "[INST]", "</s>", "x", "|end|>", "\n"])).map("".join)), max_size=4))
def test_chat_round_trip(turns):
    formatted, spans = chat_format.render(turns)
    assert chat_format.parse(formatted) == turns
    assert [chat_format.unescape(formatted[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]
    assert formatted.count("<|end|>") == len(turns) and "[INST]" not in formatted and "</s>" not in formatted


def test_layouts():
    known = chat_format.registry()
    turns = lambda r: chat_format.canonical_turns(r, known)
    assert turns('{"instruction": "i", "input": "", "output": "o"}') == ("instruction", [("user", "i"), ("assistant", "o")])
    assert turns('{"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": null}]}') == ("sharegpt", [("user", "h"), ("assistant", "")])
    for other in ({"prompt": 5, "completion": "x"}, {"prompt": True, "completion": "x"}, {"messages": [{"role": 1, "content": "a"}]}, {"messages": [{"role": "user"}, {"content": "a"}]}, {"messages": [None]}, {"messages": None}, [], 5, None):
        assert turns(json.dumps(other)) == (None, None)
    assert turns(json.dumps({"messages": [{"role": None, "content": None}]})) == ("messages", [("", "")])
    assert turns('{"messages": []}') == ("messages", []) and turns('{"b": 1}') == (None, None) and turns("no") == (None, None)


def test_chat_digests(spark):
    rows = spark.createDataFrame([(1, 1, "assistant", "b"), (1, 0, "user", None), (1, 1, "assistant", "b"), (None, 0, None, "x")], "conv_id long, turn long, role string, text string")
    found = {r.conv_id: r for r in chat_format.digests(chat_format.format_records(chat_format.records_from_rows(rows))).collect()}
    assert found[1].turns_sha256 == hashlib.sha256(b"user\n\nassistant\nb\nassistant\nb\n").hexdigest()
    assert (found[1].loss_chars, found[1].loss_sha256) == (2, hashlib.sha256(b"bb").hexdigest()) and found[None].n_turns == 1
    assert chat_format.digests(chat_format.format_records(chat_format.records_from_rows(rows.where("false")))).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=14))
def test_repeat_words(words):
    covered = {p for i, j in itertools.permutations(range(max(0, len(words) - 2)), 2) if words[i : i + 3] == words[j : j + 3] for p in range(i, i + 3)}
    assert quality_rules.TextView(" ".join(words)).n_repeat_words == len(covered)


def test_any_order_gives_the_same_verdict(odd):
    names = list(quality_rules.RULES)
    found = [sorted(map(str, quality_rules.quality_verdicts(odd, order).drop("rejected_by").collect())) for order in (names, names[::-1])]
    assert found[0] == found[1] and len(found[0]) == 13
    kept = quality_rules.filter_by_quality(odd, names)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} <= {1, 2, 8, 9, None}
    assert quality_rules.quality_verdicts(empty(odd), names).count() == 0 and quality_rules.plan_cascade([])[0]["rule"] == names[0]


def test_language(spark, odd):
    de, en = "der und nicht strasse haus", "the and not street house"
    labelled = spark.createDataFrame([(i, f"{a} {text(i, 3)}", lang) for i in range(20) for lang, a in (("de", de), ("en", en))], "doc_id long, text string, lang string")
    model = language_id.train(labelled)
    predictor = language_id.Predictor(model)
    got = predictor.predict(["the house", "das haus und strassen", "1234 !", None, "streets", "ω"])
    assert [g[0] for g in got[:5]] == ["en", "de", "und", "und", "en"] and got[5][0] in ("de", "en")
    rows = language_id.identify(odd, model).collect()
    assert len(rows) == 13 and all(0 <= r.score <= 1 for r in rows) and {r.lang_pred for r in rows if r.doc_id in (3, 4, 5, 10)} == {"und"}
    assert {r.lang_pred for r in language_id.identify(odd, language_id.train(empty(odd))).collect()} == {"und"}
    assert language_id.filter_by_language(odd, model, 0.0).columns == odd.columns


def test_the_language_stage_rejects(spark):
    labelled = spark.createDataFrame([(i, f"{a} {text(i, 3)}", lang) for i in range(20) for lang, a in (("de", "der und nicht strasse haus"), ("en", "the and not street house"))], "doc_id long, text string, lang string")
    docs = spark.createDataFrame([(1, "the house and street", "en"), (2, "the house and street", "de"), (3, "12 !", "en"), (4, None, "de"), (5, "das haus und der", None), (6, "the haus", None), (6, "THE HOUSE", "en")], labelled.schema)
    for model in (language_id.train(labelled), language_id.train(labelled, 2, 1)):
        for gap in (2.0, 99.0):
            kept = [tuple(r) for r in language_id.filter_by_language(docs, model, 0.6, gap).collect()]
            assert sorted(d for d, *_ in kept if d != 6) == ([1, 5] if gap < 9 else [1, 2, 5]) and (6, "THE HOUSE", "en") in kept


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("aBéΣ1² _\n\U0001d400\U00010400\u0301"), max_size=12)), max_size=5))
def test_words_of_letters(texts):
    names, at, counts = language_id.cut_words(pa.array(texts, pa.string()))
    expected = [["".join(chr(language_id._letter(c)) for c in w) for w in "".join(c if c.isalpha() else " " for c in t or "").split()] for t in texts]
    assert list(counts) == list(map(len, expected)) and [names[i].as_py() for i in at.tolist()] == [w for ws in expected for w in ws]


def test_language_keeps_what_is_not_broadcast(spark, odd):
    labelled = spark.createDataFrame([(lang, f"{text(i + seed, 40)} {common_word}") for i in range(10) for lang, seed, common_word in (("de", 0, "haus"), ("en", 500, "haus " * 3))], "lang string, text string")
    whole, small = language_id.train(labelled), language_id.train(labelled, 2, 1)
    assert whole.rest is None and small.rest is not None
    docs = odd.unionByName(spark.createDataFrame([(50 + i, t, None, "x", 0) for i, t in enumerate([text(3, 9), text(503, 9), "haus", "kalom\u00fc xyz", "\u03c9"])], odd.schema))
    rows = lambda m: sorted(((r.doc_id or -1, r.held_out, r.lang_pred, round(r.score, 9)) for r in language_id.identify(docs, m).collect()))
    assert rows(small) == rows(whole)
    kept = lambda m: sorted(map(str, language_id.filter_by_language(docs, m, 0.6).collect()))
    assert kept(small) == kept(whole)


def shingles(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def components(sets):
    """The least key reachable from each key by links of its set."""
    root = {d: d for d, _ in sets}
    find = lambda x: x if root[x] == x else find(root[x])
    for (a, x), (b, y) in itertools.combinations(sets, 2):
        if x and y and 100 * len(x & y) >= 75 * len(x | y):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {d: find(d) for d, _ in sets}


def near_copies():
    rng, rows = np.random.default_rng(5), []
    base, passage = text(11, 60).split(), text(99, 45)
    for i in range(24):
        w = list(base)
        for _ in range(i % 5):
            w[rng.integers(0, len(w))] = f"w{i}"
        rows.append((i, " ".join(w[: 60 - i // 2])))
    # Many texts that are mostly one passage but are no near copies of each other.
    rows += [(200 + i, f"{text(300 + i, 22 + i)} {passage}") for i in range(12)]
    return rows + [(100, text(12, 40)), (101, text(12, 40).upper()), (102, None), (103, ""), (None, text(12, 40)), (104, "a b"), (105, "A  b"), (100, text(12, 40)), (106, "x" * 300), (107, "X" * 300 + "\n"), (108, "x" * 301)]


@pytest.mark.parametrize("block_bytes,flush", [(8 << 20, 3_000_000), (500, 200)])
def test_jaccard_is_exact(spark, monkeypatch, block_bytes, flush):
    monkeypatch.setattr(jaccard_join, "FLUSH_KEYS", flush)
    monkeypatch.setattr(jaccard_join, "HELD_POSTINGS", flush)
    rows = near_copies()
    found = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(2), block_bytes=block_bytes).collect()
    assert {r.doc_id: r.component_id for r in found if r.doc_id is not None} == components([(d, shingles(t)) for d, t in rows if d is not None])
    assert sorted((r.doc_id or -1, r.n_shingles) for r in found) == sorted((d or -1, len(shingles(t))) for d, t in rows)
    assert [r.component_id for r in found if r.doc_id is None] == [None]


def test_one_of_each_component_stays(spark, odd):
    a, b, b2 = text(61, 60), text(62, 60), text(62, 59) + " ende"
    rows = [(1, a), (5, a), (5, b), (7, b2), (5, text(63, 40)), (5, text(64, 40)), (None, a), (None, text(65, 40)), (None, text(65, 40)), (8, None), (8, None), (9, " ")]
    docs = spark.createDataFrame([(d, t, i, 0) for i, (d, t) in enumerate(rows)], "doc_id long, text string, id int, root int")
    kept = jaccard_join.keep_one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r.id for r in kept.collect()) in ([0, 2, 4, 5, 7, 9, 10, 11], [0, 2, 4, 5, 8, 9, 10, 11])
    again = jaccard_join.keep_one_of_each(spark.createDataFrame(near_copies(), "doc_id long, text string")).collect()
    sets = [(i, shingles(t)) for i, (_, t) in enumerate(near_copies())]
    assert len(again) == len(set(components(sets).values()))
    assert jaccard_join.keep_one_of_each(empty(odd)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(st.sampled_from(["a", "B", "ab", " ", "  ", "\n", "é", "x" * 300, "\xa0"]), max_size=14).map("".join)), max_size=5))
def test_words_and_shingles_of_a_stream(texts):
    stream = common.WordStream(pa.array(["zz", *texts], pa.string())[1:])
    expected = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()) for t in texts]
    flat = [w for ws in expected for w in ws]
    assert list(stream.counts) == list(map(len, expected)) and [stream.word(i) for i in range(len(stream.starts))] == flat
    assert len(set(zip(stream.hashes.tolist(), flat))) == len(set(flat)) == len(set(stream.hashes.tolist()))
    keys, sizes = common.shingle_keys(stream)
    assert list(sizes) == [len(shingles(t)) for t in texts]
    assert all((np.diff(k.astype(np.int64)) > 0).all() for k in np.split(keys, np.cumsum(sizes)))
    assert np.array_equal(common.unpack_sorted(common.pack_sorted(np.sort(keys))), np.sort(keys))


def test_signature_tree_links_what_brute_force_links():
    rng = np.random.default_rng(1)
    sets = []
    for _ in range(40):
        core = rng.integers(0, 2**47, 60).astype(np.uint64)
        sets += [np.unique(np.concatenate([core[: 60 - k], rng.integers(0, 2**47, k).astype(np.uint64)])) for k in rng.integers(0, 14, 4)]
    root = list(range(len(sets)))
    find = lambda x: x if root[x] == x else find(root[x])

    def parts(links):
        for i in range(len(root)):
            root[i] = i
        for a, b in links:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
        return [find(i) for i in range(len(root))]

    every = [(i, j) for i, j in itertools.combinations(range(len(sets)), 2) if jaccard_join.linked(sets[i], sets[j], len(sets[i]), len(sets[j]))]
    assert parts(every) == parts(jaccard_join.SignatureTree(sets, list(map(len, sets))).join())


def distance(item, region):
    """Edits of the best occurrence of an item in a region."""
    row = [0] * (len(region) + 1)
    for n, x in enumerate(item, 1):
        above, row[0] = row[:], n
        for j, y in enumerate(region, 1):
            row[j] = min(above[j] + 1, row[j - 1] + 1, above[j - 1] + (x != y))
    return min(row)


def test_passages():
    items = [(1, text(21, 40)), (2, text(22, 30)), (3, "short"), (4, None), (5, "  ! ")]
    index = decontaminate.Index(items)
    spoiled = items[0][1].split()
    spoiled[10] = "zzz"
    emoji = items[1][1].replace(" ", " \U0001f600 ")
    docs = [text(23, 50) + "  " + items[0][1].upper().replace(" ", ",  ") + ". " + text(24, 20), " ".join(spoiled), text(25, 300), None, "", items[1][1][:60], items[1][1] + " " + text(26, 9) + " " + items[1][1], "a short!", "shorts", emoji, "SHORT"]
    found = decontaminate.matches_of(index, docs)
    assert {(t, index.ids[i]) for t, i, *_ in found} == {(0, 1), (1, 1), (6, 2), (7, 3), (9, 2), (10, 3)} and len([m for m in found if m[0] == 6]) == 2
    t, i, a, b, edits = next(m for m in found if m[0] == 0)
    assert docs[0][a:b] == items[0][1].upper().replace(" ", ",  ") and edits == 0
    assert [docs[7][a:b] for t, _, a, b, _ in found if t == 7] == ["short"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=12), st.lists(st.integers(0, 2), max_size=30)), min_size=1, max_size=5), st.integers(0, 6))
def test_bands_are_aligned_exactly(pairs, slack):
    """A band that holds every cell gives the true distance; a narrow one, the distance of what lies within it."""
    points = np.concatenate([np.array([*r, 9], dtype=np.uint32) for _, r in pairs])
    ends = np.cumsum([len(r) + 1 for _, r in pairs]) - 1
    spans = [(int(e) - len(r), int(e)) for e, (_, r) in zip(ends, pairs)]
    items = [np.array(x, dtype=np.uint32) for x, _ in pairs]
    whole = [(a - len(x), z) for (a, z), x in zip(spans, items)]
    assert [c for c, *_ in decontaminate.align_many(items, points, spans, whole)] == [distance(x, r) for x, r in pairs]
    for (cost, begin, end), (a, z), x in zip(decontaminate.align_many(items, points, spans, whole), spans, items):
        assert a <= begin <= end <= z and distance(x, points[begin:end]) == cost
    narrow = [(a - slack, a + slack) for a, _ in spans]
    for (cost, *_), x, (a, z) in zip(decontaminate.align_many(items, points, spans, narrow), items, spans):
        rows = {(0, j): 0 for j in range(0, z - a + 1) if j <= slack}
        for i in range(1, len(x) + 1):
            for j in range(0, z - a + 1):
                if abs(j - i) <= slack:
                    options = [rows.get((i - 1, j), 1e9) + 1, rows.get((i, j - 1), 1e9) + 1]
                    options += [rows.get((i - 1, j - 1), 1e9) + (x[i - 1] != points[a + j - 1])] if j else []
                    rows[i, j] = min(options)
        best = min([rows.get((len(x), j), 1e9) for j in range(0, z - a + 1)])
        assert cost == best if best < 1e9 else cost > 1000


def test_every_edited_item_is_found():
    """Items planted with as many edits as their budget allows, at any place: full recall."""
    rng = np.random.default_rng(8)
    items = [(i, text(500 + i, int(rng.integers(3, 60)))) for i in range(40)]
    index = decontaminate.Index(items)
    docs, planted = [], set()
    for t in range(60):
        i = int(rng.integers(0, 40))
        chars = list(decontaminate.normalise(decontaminate._code_points(items[i][1]), index.folding)[0])
        for _ in range(decontaminate.edit_budget(len(chars))[0]):
            at = int(rng.integers(0, len(chars)))
            kind = rng.integers(0, 3)
            if kind == 0:
                chars[at] = ord("q")
            elif kind == 1:
                chars.insert(at, ord("x"))
            else:
                del chars[at]
        docs.append(f"{text(700 + t, int(rng.integers(0, 40)))} {''.join(map(chr, chars))} {text(800 + t, int(rng.integers(0, 40)))}")
        planted.add((t, i))
    found = decontaminate.matches_of(index, docs)
    assert planted <= {(t, i) for t, i, *_ in found}
    for t, i, a, b, edits in found:
        x = decontaminate.normalise(decontaminate._code_points(items[i][1]), index.folding)[0]
        region = decontaminate.normalise(decontaminate._code_points(docs[t][a:b]), index.folding)[0]
        assert distance(x, region) <= edits <= decontaminate.edit_budget(len(x))[0]


def test_many_short_items_stay_small():
    items = [(i, f"question number {i} asks {i * 7}") for i in range(50_000)]
    index = decontaminate.Index(items)
    doc = " ".join(text(900 + i, 400) for i in range(20)) + " question number 777 asks 5439 " + text(950, 400)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    found = decontaminate.matches_of(index, [doc])
    assert 777 in {index.ids[i] for _, i, *_ in found}
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 600_000


def test_decontamination_tables(spark, odd):
    bench = spark.createDataFrame([(1, text(1, 30)), (2, None)], "item_id long, text string")
    assert {r.doc_id for r in decontaminate.find_passages(odd, bench).collect()} == {1, 2, 9}
    clean = decontaminate.remove_contaminated(odd, bench)
    assert clean.columns == odd.columns and clean.count() == 9
    assert decontaminate.find_passages(odd, bench.where("false")).count() == 0 and decontaminate.find_passages(empty(odd), bench).count() == 0


def test_licences(spark, odd):
    model = license_scan.fit([text(i, 12) for i in range(60)] + ["the house of the lord"])
    lines = [(f, t) for f, ts in license_scan.TEMPLATES.items() for t in ts]
    assert all([h[1] for h in model.scan(f"{text(1, 9)}\n{text(2, 5)} {t} {text(3, 5)}")] == [f] for f, t in lines)
    assert not any(model.scan(x) for x in (None, "", "the license of poets", "permission was denied", text(4, 99)))
    assert license_scan.scan(odd, model).count() == 0
    notice = TEMPLATE
    rows = [(1, notice), (1, notice), (None, f"{text(5, 9)}\n\n{notice}"), (2, None), (3, ""), (4, text(6, 3000) + "\n" + notice)]
    docs = spark.createDataFrame([(d, t, "x", 0) for d, t in rows], "doc_id long, text string, family string, start int")
    found = sorted((r.doc_id or 0, r.family, r.text) for r in license_scan.scan(docs, license_scan.train(docs)).collect())
    assert found == [(0, "MIT", notice), (1, "MIT", notice), (1, "MIT", notice), (4, "MIT", notice)]
    assert license_scan.scan(docs, license_scan.train(empty(odd))).count() == 4


def test_scan_without_the_filter_finds_the_same(monkeypatch):
    model = license_scan.fit([text(i, 12) for i in range(60)] + ["the house of the lord"])
    rng, words = np.random.default_rng(9), "licensed under the terms of mit apache license version 2 0 gnu general public gpl v3 bsd cc by sa 4 released".split()
    texts = ["\n".join(" ".join(rng.choice(words, rng.integers(1, 9))) for _ in range(rng.integers(1, 6))) for _ in range(150)]
    texts += [" ".join(t.split()[: 1 + i % 9]) + " " + text(i, 4) for i, t in enumerate(t for ts in license_scan.TEMPLATES.values() for t in ts)]
    filtered = [model.scan(t) for t in texts]
    monkeypatch.setattr(license_scan.Classifier, "possible", lambda self, words: self.templates)
    assert filtered == [model.scan(t) for t in texts] and any(filtered)


def test_licences_wrapped_and_several():
    model = license_scan.fit([text(i, 12) for i in range(60)] + ["the house of the lord"])
    families = lambda t: [h[1] for h in model.scan(t)]
    gpl = " * you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by\n * the Free Software Foundation, either version 3 of the License, or\n"
    mit = "# Permission is hereby granted, free of charge, to any person obtaining a copy\n# of this software and associated documentation files (the Software)\n"
    assert families(gpl) == ["GPL-3.0"] and families(mit) == ["MIT"] and families(f"{mit}#\n{gpl}") == ["MIT", "GPL-3.0"]
    assert families(gpl.replace("General", "General\n *\n *")) == [] and families("Released under the MIT terms") == ["MIT"]
    line = f"{text(1, 5)} Licensed under the MIT license and {text(2, 3)} Licensed under the Apache License, Version 2.0. {text(3, 3)}"
    found = model.scan(f"{text(4, 5)}\n\n{line}")
    assert [(h[0], h[1], h[4]) for h in found] == [(2, "MIT", line), (2, "Apache-2.0", line)]
    assert [f"{text(4, 5)}\n\n{line}"[h[5] : h[6]] for h in found] == ["Licensed under the MIT license", "Licensed under the Apache License, Version 2.0"]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=700))
def test_block_round_trip(values):
    data = np.array(values, dtype=np.uint32)
    back, at = token_blocks.unpack_stream(token_blocks.pack_stream(data))
    assert np.array_equal(back, data) and at == len(token_blocks.pack_stream(data))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_chunks_give_the_librarys_ids(name):
    encoder = tokens.Encoder(tokens.vocabulary_path(name))
    odd_texts = ["a\xa0\n\nb  c\t\td ", "<|endoftext|> x", "", None, "   ", "don't it's 　 x  y", "É Σας ΟΔΟΣ\x1c\x1dz", "a\x85\x85b 12345 ½²", "x" * 300, "foo, foo. foo!? FOO", text(1, 50)]
    for _ in range(2):
        ids, counts = encoder.batch(pa.array(odd_texts))
        plain = Tokenizer.from_file(tokens.vocabulary_path(name))
        expected = [plain.encode(t, add_special_tokens=False).ids if t else [] for t in odd_texts]
        assert [list(x) for x in np.split(ids, np.cumsum(counts)[:-1])] == expected


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([" ", "  ", "\n", "\n\n", "\t", "ab", "B", "é", ".", "1", "'s", "<|endoftext|>", "\x00", "\u3000", "e\u0301"]), max_size=12).map("".join), max_size=4))
def test_ids_of_any_white_space(texts):
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        encoder = tokens.worker_encoder(tokens.vocabulary_path(name))
        plain = PLAIN.setdefault(name, Tokenizer.from_file(tokens.vocabulary_path(name)))
        ids, counts = encoder.batch(pa.array(texts, pa.string()))
        assert [list(x) for x in np.split(ids, np.cumsum(counts)[:-1])][: len(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def library_ids(name, text):
    plain = PLAIN.setdefault(name, Tokenizer.from_file(tokens.vocabulary_path(name)))
    return plain.encode(text or "", add_special_tokens=False).ids + [0]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_shards(odd):
    rows = sorted(token_blocks.read_shards(token_blocks.write_shards(odd, shard_ids=50)).collect(), key=lambda r: r.start)
    docs = sorted((r.doc_id is not None, r.doc_id or 0, r.text or "", r.text) for r in odd.collect())
    ids = [library_ids("byte_bpe_50k.json", t) for *_, t in docs]
    assert [r.start for r in rows] == list(np.cumsum([0] + [len(x) for x in ids])[:-1])
    assert sorted((r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in rows) == sorted((d, len(x), crc(x)) for (_, d, *_), x in zip(docs, ids))
    assert [r.doc_id or 0 for r in rows] == [d for _, d, *_ in docs]
    assert token_blocks.read_shards(token_blocks.write_shards(empty(odd))).count() == 0


def test_packing(odd):
    rows = packing.pack(odd).collect()
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all([o for o, _ in sorted(v)] == list(np.cumsum([0] + [n for _, n in sorted(v)])[:-1]) and sum(n for _, n in v) <= 2048 for v in by.values())
    expected = []
    for d, t in odd.select("doc_id", "text").collect():
        ids = library_ids("word_bpe_49k.json", t)
        expected += [(d or 0, k // 2048, k, len(ids[k : k + 2048]), crc(ids[k : k + 2048])) for k in range(0, len(ids), 2048)]
    assert sorted((r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(expected)
    assert packing.pack(empty(odd)).count() == 0


def fewest_sequences(lengths, capacity):
    """The optimum, by trying every place for every piece."""
    best = len(lengths)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for k in {r: k for k, r in enumerate(rooms) if r >= lengths[i]}.values():
            rooms[k] -= lengths[i]
            place(i + 1, rooms)
            rooms[k] += lengths[i]
        place(i + 1, [*rooms, capacity - lengths[i]])

    lengths = sorted(lengths, reverse=True)
    place(0, [])
    return best


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=9))
def test_few_pieces_take_the_fewest_sequences(lengths):
    assert packing.plan_sequences(np.bincount(lengths, minlength=21), 20)[1] == fewest_sequences(lengths, 20)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 26), min_size=1, max_size=9), st.integers(5, 60), st.sampled_from([0, 3000]))
def test_fillings_waste_the_least(lengths, room, nodes):
    sums = {sum(c) for n in range(len(lengths) + 1) for c in itertools.combinations(lengths, n)}
    filling = packing.complete_bin(np.bincount(lengths, minlength=room + 1), room, nodes)
    assert sum(s * t for s, t in filling) == max(x for x in sums if x <= room)
    assert all(Counter(lengths)[s] >= t for s, t in filling)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=40))
def test_plans_are_whole_and_near_the_bound(lengths):
    counts = np.bincount(lengths, minlength=21)
    plan, n = packing.plan_sequences(counts, 20)
    assert ((plan["high"] - plan["low"]).groupby(plan["length"]).sum().reindex(range(21), fill_value=0).to_numpy() == counts).all()
    assert -(-sum(lengths) // 20) <= n <= math.ceil(sum(lengths) / 20 * 1.25) + 1


def test_quality_classifier(odd):
    good, bad = [text(i, 120) for i in range(60)], [text(i, 30).replace(" ", "*** ") for i in range(60)]
    slots = pu_quality.WordSlots()
    features = lambda ts: [pu_quality.features(t, slots) for t in ts]
    weights = pu_quality.fit(features(good[:40]), features(good[40:] + bad[:20]), 0.5)
    scores = pu_quality.score_texts(good[40:] + bad[20:], weights, slots)
    assert scores[:20].min() > scores[20:].max()
    ready = pu_quality.fit_calibrated(features(good[:40]), features(good[40:] + bad[:20]), 0.5)
    assert ((pu_quality.score_texts(good + bad, ready, slots) >= 0.3) == np.repeat([True, False], 60)).mean() > 0.95
    rows = pu_quality.score(odd, weights).collect()
    assert len(rows) == 13 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    labels = odd.selectExpr("doc_id", "cast(null as int) as quality")
    assert pu_quality.score(odd, pu_quality.train(odd, labels)[0]).count() == 13


def learned(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 10 != 0


def slow_scores(rows):
    """log10 probabilities of (doc_id, text) rows, token by token and bit by bit, with the mixer's fixed first weights."""
    cm, U = context_mixing, np.uint64
    hash_of = lambda w: int(common.WordStream(pa.array([w])).hashes[0])
    docs = [(d, [*[w.decode() for w in common.words(t)], ""]) for d, t in rows]
    cls = lambda w: (hash_of(w) if w else int(cm.END)) >> 44
    count, follow, mass = Counter(), {1: {}, 2: {}}, Counter()
    for d, ws in docs:
        if learned(d):
            for i, w in enumerate(ws):
                count[w] += 1
                mass[cls(w)] += 1
                for o in (1, 2):
                    follow[o].setdefault(tuple(["^", "^", *ws][i + 2 - o : i + 2]), Counter())[cls(w)] += 1
    total, once = sum(count.values()), sum(c == 1 for c in count.values())
    escape = (once + 1) / (total + 2)
    letter = [Counter(), Counter(), Counter()]
    for w in {w for w in count if w and count[w] == 1}:
        data = w.encode() + b" "
        for back, row in enumerate(cm.letter_rows(np.frombuffer(data, np.uint8), np.array([len(data)]))):
            letter[back].update(zip(row.tolist(), data))

    def spelled(w):
        data, cost = w.encode() + b" ", 0.0
        rows = cm.letter_rows(np.frombuffer(data, np.uint8), np.array([len(data)]))
        for i, c in enumerate(data):
            p = 1 / 256
            for back in range(3):
                r = int(rows[back][i])
                seen = sum(n for (x, _), n in letter[back].items() if x == r)
                p = seen / (seen + 16) * (letter[back][r, c] / seen if seen else 0) + 16 / (seen + 16) * p
            cost -= math.log2(p)
        return cost

    odds = lambda y, n, prior=0.4: math.log((y + prior) / (n + 0.4))
    unit = lambda x: np.clip(np.round(16 * x), -127, 127) / 16
    out = []
    for d, ws in docs:
        own, cost, so_far = int(learned(d)), 0.0, {1: [0, 0], 2: [0, 0]}
        weights = np.tile(np.array(cm.START), (cm.GATES, 1)).astype(np.float32)
        pending = []
        for i, w in enumerate(ws):
            left, n, c = count[w] - own, max(1.0, total - own), cls(w)
            views = {}
            for o in (1, 2):
                f = Counter(follow[o].get(tuple(["^", "^", *ws][i + 2 - o : i + 2]), {}))
                top = sorted(f.items(), key=lambda x: (-x[1], -x[0]))[:2]
                top = top if len(top) < 2 or top[1][1] == top[0][1] else top[:1]
                seen = max(0, sum(f.values()) - own)
                top = [(k, v - own * (k == c)) for k, v in top]
                best = max(top, key=lambda x: x[1], default=(None, 0)) if not (len(top) == 2 and top[1][1] <= top[0][1]) else top[0]
                views[o] = (dict(top), max(seen, best[1]), best)
            missed, asked_two, hit = 0.0, None, False
            for o in (2, 1):
                tops, seen, (name, times) = views[o]
                other, other_seen, _ = views[3 - o]
                if hit or not times or times < seen / 16 or name == asked_two:
                    continue
                asked_two = name if o == 2 else asked_two
                bit = left > 0 and name == c
                agreed = min(other.get(name, 0), other_seen)
                m = min(mass[name], n - 0.5)
                x = unit(np.array([odds(times, seen - times), odds(agreed, other_seen - agreed, 0.2) if other_seen else 0.0, odds(*so_far[o]), odds(m, n - m), 1.0]))
                gate = (((2 - o) * 3 + (2 if seen > 3 else 1 if seen > 1 else 0)) * 2 + (times == seen)) * 3 + ((2 if agreed else 1) if other_seen else 0)
                p = float(np.clip(1 / (1 + math.exp(-float(x @ weights[gate]))), cm.FLOOR, 1 - cm.FLOOR))
                cost -= math.log2(p if bit else 1 - p)
                pending.append((gate, x, bit - p))
                if len(pending) == cm.STEP:
                    for g, y, error in pending:
                        weights[g] += np.float32(cm.RATE * error) * y.astype(np.float32)
                    pending = []
                so_far[o][0 if bit else 1] += 1
                hit = hit or bit
                missed += 0 if bit else mass[name] / n
            if hit:
                cost -= math.log2(left / max(left, mass[c] - own))
                continue
            cost += math.log2(max(cm.FLOOR, 1 - (1 - escape) * missed))
            cost -= math.log2((1 - escape) * left / n) if left > 0 else math.log2(escape)
            cost += spelled(w) if left <= 0 and w else 0
        out.append(-cost * math.log10(2))
    return out


def test_quality_on_held_out_rows(spark):
    docs, labels = (common.table(spark, "/root/testdata/sf0.01", n) for n in ("documents", "labels"))
    weights, prior = pu_quality.train(docs, labels)
    rows = pu_quality.score(docs, weights).join(labels, "doc_id").where("held_out and quality is not null").collect()
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert 0.5 < prior < 1 and len(rows) > 50
    assert np.mean([a > b for a in good for b in bad]) > 0.97
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95


def test_language_on_held_out_rows(spark):
    docs = common.table(spark, "/root/testdata/sf0.01", "documents")
    model = language_id.train(docs.where(~language_id.held_out()))
    rows = language_id.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null and lang_pred <> 'und'").collect()
    assert len(rows) > 100 and np.mean([r.lang_pred == r.lang for r in rows]) > 0.97


@pytest.mark.parametrize("flush", [4 << 20, 1200])
def test_scores_bit_by_bit(spark, monkeypatch, flush):
    monkeypatch.setattr(context_mixing, "fit_weights", lambda bit, *_: np.tile(np.array(context_mixing.START), (context_mixing.GATES, 1)))
    few = "the of and in to a is".split()
    rng = np.random.default_rng(3)
    rows = [(i, " ".join([*rng.choice(few, 30), *text(i % 7, 12).split(), *rng.choice(few, 20)]) + (" " + text(70 + i, 25) if i % 3 else "")) for i in range(30)]
    rows += [(40, " ".join(["the of and in"] * 90)), (41, None), (None, "the of zzz"), (42, "a" * 300), (40, "the of zzz")]
    # Letters are learned from words that a flush has once, so with several flushes only known words can be compared.
    rows = rows if flush > 1200 else [(d, " ".join(few * (3 + i % 4)) + " " + " ".join(rng.choice(few, 9 + i % 3))) for i, (d, _) in enumerate(rows)]
    expected = slow_scores(rows)
    found = context_mixing.score(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), flush).collect()
    assert [r.doc_id for r in found] == [d for d, _ in rows]
    assert np.allclose([r.score for r in found], expected, rtol=1e-4, atol=1e-4)


def test_base_scores_and_model(odd):
    rows = context_mixing.score(odd).collect()
    texts = {(r.doc_id, r.text) for r in odd.collect()}
    counted = Counter()
    for r in odd.collect():
        if learned(r.doc_id):
            counted.update(common.words(r.text) + [b""])
    n, v = sum(counted.values()), len(counted)
    expected = sorted((d if d is not None else -1, round(sum(math.log10((counted[w] + 0.1) / (n + 0.1 * (v + 1))) for w in common.words(t) + [b""]), 6)) for d, t in texts)
    assert sorted({(r.doc_id if r.doc_id is not None else -1, round(r.base_score, 6)) for r in rows}) == expected
    known = {(r.doc_id, r.n_tokens, r.n_known) for r in rows}
    assert known == {(d, len(common.words(t)) + 1, sum(counted[w] > 0 for w in common.words(t) + [b""])) for d, t in texts}
    assert len(rows) == 13 and all(r.score < 0 and r.train_tokens == n for r in rows)
    assert context_mixing.score(empty(odd)).count() == 0
    assert context_mixing.score(odd.where("doc_id = 4")).count() == 1


def test_contexts_are_told_apart_by_sorting(monkeypatch):
    """Distinct words and contexts come from sorts that are there anyway; numpy's unique hashes all values first, which was a sixth of all time."""
    monkeypatch.setattr(np, "unique", lambda *_, **__: pytest.fail("values were hashed"))
    cm, stream = context_mixing, common.WordStream(pa.array(["a b a b c", "b a b", None]))
    tokens = cm.Tokens(stream)
    rows = []
    for flush, learned in enumerate((np.ones(len(tokens.text), bool), tokens.text == 0)):
        keys, counts = cm._counted(tokens.pairs(1, 32)[learned])
        rows.append((0, 1, flush, common.pack_sorted(keys), cm.pack_counts(counts), common.pack_sorted(cm._counted(tokens.pairs(1, 32)[~learned])[0])))
    for flush, answer in enumerate(cm._answer(1, 0, rows)):
        own = (np.ones(len(tokens.text), bool) if flush == 0 else tokens.text == 0).astype(np.int64)
        found = cm.Candidates(tokens.pairs(1, 32), own, [answer[2:7]], 1, 32)
        # After "a" comes "b" in every text, five times in both flushes together.
        after_a = [1, 3, 8]
        assert (found.name[after_a] == tokens.classes()[1]).all() and (found.times[after_a] == 5 - own[after_a]).all()


@pytest.mark.parametrize("n_flushes", [3, 40])
def test_flushes_are_answered_together(monkeypatch, n_flushes):
    """A range is searched and compressed for all its flushes at once, and each flush reads exact counts and names from its ranges' answers."""
    cm, rng, n = context_mixing, np.random.default_rng(n_flushes), 3
    words = [f"w{k}" for k in rng.zipf(1.3, 12_000) % 400]
    flushes, asks = [], [[] for _ in range(n)]
    for f in range(n_flushes):
        tokens = cm.Tokens(common.WordStream(pa.array([" ".join(words[k : k + 20 + f % 3]) for k in range(300 * f, 300 * f + 300, 25)])))
        known, pairs = tokens.text % 4 > 0, tokens.pairs(1, 40)
        flushes.append((known, pairs))
        (keys, counts), ask = cm._counted(pairs[known]), cm._counted(pairs[~known])[0]
        a, b = cm._cuts(keys, n, 40, cm.CLASS_BITS), cm._cuts(ask, n, 40, cm.CLASS_BITS)
        for k in range(n):
            asks[k].append((k, 1, f, common.pack_sorted(keys[a[k] : a[k + 1]]), cm.pack_counts(counts[a[k] : a[k + 1]]), common.pack_sorted(ask[b[k] : b[k + 1]])))
    calls, search = [], np.searchsorted
    with monkeypatch.context() as m:
        m.setattr(np, "searchsorted", lambda *x, **y: calls.append(1) or search(*x, **y))
        m.setattr(cm.zstandard, "compress", lambda *_: pytest.fail("a compressor was made for one message"))
        answers = [list(cm._answer(1, k, rows)) for k, rows in enumerate(asks)]
    assert len(calls) <= 6 * n
    times, after = Counter(), {}
    for known, pairs in flushes:
        times.update(pairs[known].tolist())
    for p, t in times.items():
        after.setdefault(p >> cm.CLASS_BITS, {})[p & ((1 << cm.CLASS_BITS) - 1)] = t
    unmet = 0
    for f, (known, pairs) in enumerate(flushes):
        found = cm.Candidates(pairs, known.astype(np.int64), [a[f][2:7] for a in answers], n, 40)
        here = set(pairs.tolist())
        for i, (p, own) in enumerate(zip(pairs.tolist(), known.astype(int).tolist())):
            left = dict(after.get(p >> cm.CLASS_BITS, {}))
            if own:
                left[p & ((1 << cm.CLASS_BITS) - 1)] -= 1
            assert found.total[i] == sum(left.values()) and found.follows[i] == left.get(p & ((1 << cm.CLASS_BITS) - 1), 0)
            if found.total[i]:
                assert found.times[i] == max(left.values()) == left[int(found.name[i])] and found.asked[i] == (16 * found.times[i] >= found.total[i])
                assert found.kinds[i] == sum(t > 0 for t in left.values()) - found.asked[i]
                unmet += ((p >> cm.CLASS_BITS) << cm.CLASS_BITS | int(found.name[i])) not in here
    assert unmet


def test_contexts_without_training_texts():
    cm, tokens = context_mixing, context_mixing.Tokens(common.WordStream(pa.array(["a b a b c", None])))
    pairs, own = tokens.pairs(1, 40), np.zeros(len(tokens.text), dtype=bool)
    rows = [(0, 1, 0, common.pack_sorted(pairs[:0]), cm.pack_counts(np.zeros(0, np.int64)), common.pack_sorted(cm._counted(pairs)[0]))]
    with np.errstate(all="raise"):
        for masses in (None, np.zeros(1 << cm.CLASS_BITS)):
            found = cm.Candidates(pairs, own, [a[2:7] for a in cm._answer(1, 0, rows, masses)], 1, 40)
            assert not (found.total.any() or found.asked.any() or found.left.any() or found.follows.any() or found.kinds.any()) and (found.name == -1).all()


def test_words_are_hashed_in_little_memory():
    """Running sums over bytes are kept for a small part of a text at a time; the hashes don't depend on the parts."""
    data = " ".join(f"Word{k * k}" for k in range(150_000)) + " " + "x" * 200 + " " + "y" * 70_000
    texts = pa.array([data])
    common.WordStream(texts)
    tracemalloc.start()
    stream = common.WordStream(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 10 * len(data)
    for i in [*range(0, len(stream.hashes), 1009), len(stream.hashes) - 2, len(stream.hashes) - 1]:
        assert stream.hashes[i] == common.WordStream(pa.array([stream.word(i).decode()])).hashes[0]


def test_every_follower_is_known(spark):
    """A context knows how often each class followed it, not the most frequent one alone, exactly and for any count; other followers cost less for it."""
    cm, rng = context_mixing, np.random.default_rng(5)
    words = [f"w{k}" for k in rng.zipf(1.3, 40_000) % 300]
    texts = [" ".join(words[k : k + 400]) for k in range(0, len(words), 400)]
    tokens = cm.Tokens(common.WordStream(pa.array(texts)))
    known, pairs = tokens.text % 10 > 0, tokens.pairs(1, 40)
    keys, counts = cm._counted(pairs[known])
    masses = np.bincount(tokens.classes()[known].astype(np.int64), minlength=1 << cm.CLASS_BITS).astype(float)
    (answer,) = cm._answer(1, 0, [(0, 1, 0, common.pack_sorted(keys), cm.pack_counts(counts), common.pack_sorted(cm._counted(pairs[~known])[0]))], masses)
    found = cm.Candidates(pairs, known.astype(np.int64), [answer[2:7]], 1, 40)
    times, after, seen = Counter(pairs[known].tolist()), {}, Counter((pairs[known] >> np.uint64(cm.CLASS_BITS)).tolist())
    for p in times:
        after.setdefault(p >> cm.CLASS_BITS, set()).add(p & ((1 << cm.CLASS_BITS) - 1))
    assert max(seen.values()) > 1000
    for i in range(0, len(pairs), 7):
        p, own = int(pairs[i]), int(known[i])
        c = p >> cm.CLASS_BITS
        assert found.follows[i] == times[p] - own and found.total[i] == seen[c] - own
        assert found.left[i] == found.total[i] - found.asked[i] * found.times[i]
        assert found.kinds[i] == len(after.get(c, ())) - (own and times[p] == 1) - found.asked[i]
        rest = 1 - sum(masses[k] for k in after.get(c, ())) / masses.sum()
        assert rest <= found.room[i] * (1 + 1e-9) and 1 - rest <= found.held[i] * (1 + 1e-9) and found.room[i] < max(cm.FLOOR, rest) * 1.05 + 1e-4
    # After "a" most often comes "b"; "c" is as rare as "d" elsewhere, but it follows "a".
    rows = [(k, "a b " * 6 + "a c " * 3 + f"z{k % 9} d y{k % 7} " * 30 + "a c") for k in range(1, 90)] + [(1000 + k, "a c") for k in range(60)]
    docs = spark.createDataFrame([r for r in rows if r[0] < 1000 or not learned(r[0])], "doc_id long, text string")
    plain, whole = ({r.doc_id: r.score for r in context_mixing.score(docs, followers=f).where("doc_id >= 1000").collect()} for f in (False, True))
    assert plain and all(whole[k] > plain[k] for k in plain)


def test_parts_of_flushes_change_nothing(spark, monkeypatch):
    docs = spark.createDataFrame([(k, text(k, 60)) for k in range(60)], "doc_id long, text string").coalesce(1)
    scores = []
    for bound in (1 << 40, 0):
        monkeypatch.setattr(context_mixing, "PART_BYTES", bound)
        scores.append({r.doc_id: round(r.score, 6) for r in context_mixing.score(docs, 2000, followers=True).collect()})
    assert scores[0] == scores[1] and len(scores[0]) == 60


def test_mixing_is_a_distribution():
    """The costs of both values of a bit are those of a probability and its complement."""
    rng = np.random.default_rng(0)
    gate, inputs, at = rng.integers(0, context_mixing.GATES, 500), rng.normal(0, 9, (500, 5)).astype(np.float32), np.repeat([0, 1], 250)
    start = np.full((context_mixing.GATES, 5), 0.9)
    bit = rng.integers(0, 2, 500)
    cost = context_mixing.mix(bit, gate, inputs, at, start)
    for i in (0, 63, 200, 499):
        other = bit.copy()
        other[i] = 1 - bit[i]
        assert abs(2 ** -cost[i] + 2 ** -context_mixing.mix(other, gate, inputs, at, start)[i] - 1) < 1e-9


def test_pipeline_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "quality_rules", "near_duplicates", "decontamination", "packing"]
