"""Runs of words, pieces and phrases against brute force, the library, plain counts and odd tables."""

import hashlib
import re
import time
import zlib
from collections import Counter
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from millrace.llm import chat_format, language_id, license_scan, packing, phrases, piece_codec, pu_quality, word_runs
from millrace.llm.tokens import vocabulary_path

MODEL = vocabulary_path("piece_bpe_32k.model")


def plain_runs(w, least=12):
    """Every run, period by period."""
    found = set()
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            s = w[i : j + q]
            if j - i >= q and len(s) >= least and not any(s[d:] == s[:-d] for d in range(1, q)):
                found.add((i, len(s), q))
            i = max(i + 1, j + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("steps, many", [(32, 64), (1, 0), (2, 1)])
def test_runs_are_all_found(monkeypatch, steps, many):
    monkeypatch.setattr(word_runs, "STEPS", steps)
    monkeypatch.setattr(word_runs, "MANY", many)

    @settings(max_examples=150, deadline=None)
    @given(st.lists(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=6), st.integers(1, 6)), max_size=8), max_size=4))
    def check(made):
        texts = [[x for unit, k in t for x in unit * k] for t in made]
        ends = np.cumsum([len(t) for t in texts]).astype(np.int64)
        text, *found = word_runs.find_runs(np.array([x for t in texts for x in t], dtype=np.int64), ends)
        for k, w in enumerate(texts):
            assert [tuple(map(int, r)) for r in zip(*(c[text == k] for c in found))] == plain_runs(w)

    check()


def test_a_text_of_one_word_and_one_of_fibonacci_words():
    same = word_runs.find_runs(np.zeros(20_000, dtype=np.int64), np.array([20_000]))
    assert [c.tolist() for c in same] == [[0], [0], [20_000], [1]]
    a, b = [0], [0, 1]
    while len(b) < 600:
        a, b = b, b + a
    found = word_runs.find_runs(np.array(b), np.array([len(b)]))
    assert list(zip(*(c.tolist() for c in found[1:]))) == plain_runs(b)
    with pytest.raises(ValueError):
        word_runs.find_runs(np.zeros(4), np.array([4]), least=5)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows and ids, columns that clash with inner names."""
    long = " ".join(f"w{i % 7}" for i in range(6000))
    rows = [(1, "a b " * 12, "en"), (1, "a b " * 12, "en"), (20, "one  two\n" * 9, None), (None, None, None), (3, "", "en"), (4, " \t\n", "de"), (5, long, "de"), (None, "x " * 30, "en"), (6, "<s> ▁ \x00 é 你", "en"), (34, "c d e " * 8, "en")]
    return spark.createDataFrame([(*r, 0, "x") for r in rows], "doc_id long, text string, lang string, n int, rank string")


def split(text):
    return [w for w in (text or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]


def expected_runs(doc, text):
    w = split(text)
    n, h = len(w), zlib.crc32(str(doc).encode()) if doc is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_run_digests(spark, odd):
    more = spark.createDataFrame([(i, "p q r s t " * 6 + f"z{i}", None, 0, "") for i in range(60)], odd.schema)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(60))
    docs = odd.where("doc_id IS NULL OR doc_id <> 5").unionByName(more)
    found = word_runs.digests(word_runs.periodic_runs(word_runs.with_planted_runs(docs)))
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    key = lambda r: tuple(map(repr, r))
    assert sorted(map(tuple, found.collect()), key=key) == sorted((expected_runs(r.doc_id, r.text) for r in docs.collect()), key=key)
    long = word_runs.periodic_runs(odd.where("doc_id = 5")).first()
    assert [tuple(r) for r in long.runs] == [(0, 6000, 7)] and long.collapsed == "w0 w1 w2 w3 w4 w5 w6"
    assert word_runs.digests(word_runs.periodic_runs(odd.where("false"))).count() == 0


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


ALPHABET = ["a", "th", "e", " ", "  ", "▁", ",", "<s>", "<0x41>", "<unk>", "\n", "\t", "12", "é", "é", "你", "😀", "\x00", "ɏ", "Ж", "ing", "====", "    ", "한"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(st.sampled_from(ALPHABET), max_size=25).map("".join)), max_size=4))
def test_pieces_are_the_librarys(texts):
    codec, library = piece_codec.worker_codec(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    ids, counts = codec.encode(pa.array(texts, pa.string()))
    cut = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] if texts else []
    assert cut == [library.encode(t or "") for t in texts]
    assert codec.decode(ids, counts).to_pylist() == [library.decode(library.encode(t or "")) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 31_999)), max_size=8), min_size=1, max_size=3))
def test_any_ids_are_decoded_as_the_library_does(rows):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    flat, counts = np.array([i for r in rows for i in r], dtype=np.int32), np.array(list(map(len, rows)), dtype=np.int64)
    assert piece_codec.worker_codec(MODEL).decode(flat, counts).to_pylist() == [library.decode(r) for r in rows]


def test_long_parts_and_small_memories(monkeypatch, library):
    monkeypatch.setattr(piece_codec, "PARTS", 4)
    monkeypatch.setattr(piece_codec, "PAIRS", 3)
    codec = piece_codec.Codec(MODEL)
    texts = ["a" * 5000, "ab" * 3000, " " * 3001, "=" * 2222, "aab" * 1000, "the quick brown fox the"]
    for t in texts * 2:
        assert codec.encode(pa.array([t]))[0].tolist() == library.encode(t)
    # The last part of the search is what is taken back: merging decides, not the longest piece.
    assert codec.merge("▁there") == [library.id_to_piece(i) for i in library.encode("there")]


def test_piece_digests(odd, library):
    rows = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in piece_codec.digests(piece_codec.encode(odd, decoded=True)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert rows == {(r.doc_id, len(i := library.encode(r.text or "")), sha(",".join(map(str, i))), sha(library.decode(i))) for r in odd.collect()}
    assert sorted(map(str, piece_codec.decode(piece_codec.encode(odd)).collect())) == sorted(f"Row(doc_id={r.doc_id}, decoded={(r.text or '').replace('▁', ' ')!r})" for r in odd.collect())
    assert piece_codec.digests(piece_codec.encode(odd.where("false"), decoded=True)).count() == 0


def plain_phrases(rows, least=10, covered=50):
    """lang -> {phrase: (a, l, r, n, score)}, counted in the plain way."""
    out = {}
    for lang in {r[1] or "und" for r in rows}:
        f = Counter()
        for text, of in rows:
            if (of or "und") == lang:
                lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
                for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
                    w = re.findall("[^\x20\x09]+", piece)
                    f.update(tuple(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
        total = sum(c for p, c in f.items() if len(p) == 1)
        good = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        for p, a in good.items():
            if any(len(q) > len(p) and 100 * b >= covered * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in good.items()):
                continue
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            out[lang, " ".join(p)] = (a, f[p[:k]], f[p[k:]], total, score)
    return out


@pytest.mark.parametrize("mined", [1 << 18, 5])
def test_phrases(spark, monkeypatch, mined):
    monkeypatch.setattr(phrases, "MINED", mined)
    monkeypatch.setattr(phrases, "RUN_BYTES", 3000)
    rng = np.random.default_rng(2)
    words = "la lo Mi mi re re' tu é 你 sa".split()
    rows = [("".join(str(w) + str(rng.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", "\x0b"])) for w in rng.choice(words, 120, p=[0.4, 0.2] + [0.05] * 8)), [None, "en", "en", "und"][i % 4]) for i in range(40)]
    rows += [(None, "en"), ("", None), (" .,\n", "fr"), ("so so so so so so so so so so so so so", "fr"), ("so so so so so so so so so so so so so", "fr")]
    docs = spark.createDataFrame([(t, la, 1) for t, la in rows], "text string, lang string, f int")
    found = phrases.collocations(docs).collect()
    assert {(r.lang, r.phrase): (r.a, r.l, r.r, r.n, r.score) for r in found} == plain_phrases(rows)
    for lang in {r.lang for r in found}:
        ranked = sorted((r for r in found if r.lang == lang), key=lambda r: (-r.score, -r.a, r.phrase.encode()))
        assert [r.rank for r in ranked] == list(range(1, len(ranked) + 1))
    top = phrases.collocations(docs, top=3).collect()
    assert {(r.lang, r.rank, r.phrase) for r in top} == {(r.lang, r.rank, r.phrase) for r in found if r.rank <= 3}
    assert phrases.collocations(docs.where("false")).count() == 0


def test_scores_beyond_64_bits(spark):
    a, left, right = 10**12 + 7, 10**12 + 9, 3 * 10**12 + 1
    assert spark.createDataFrame([(a, left, right)], "a long, l long, r long").select(phrases.score_of("a", "l", "r")).first()[0] == 10**6 * a * a // (left * right)


@settings(max_examples=60, deadline=None)
@given(st.integers(2, 7), st.lists(st.integers(1, 9), max_size=9))
def test_pieces_with_a_common_divisor_take_the_fewest_sequences(divisor, lengths):
    from .test_text_operators import fewest_sequences

    lengths = [n * divisor for n in lengths]
    room = 10 * divisor + divisor - 1
    assert packing.plan_sequences(np.bincount(lengths, minlength=room + 1), room)[1] == fewest_sequences(lengths, room)


@pytest.mark.parametrize("n, extra", [(1783, 0), (1156, 0), (1156, 7), (20_000, 7)])
def test_plans_of_many_like_pieces_come_soon(n, extra):
    rng = np.random.default_rng(n)
    lengths = np.concatenate([rng.integers(1, 35, n) * 30, rng.integers(1, 2048, extra)])
    began = time.monotonic()
    plan, sequences = packing.plan_sequences(np.bincount(lengths, minlength=2049))
    assert time.monotonic() - began < 20 and -(-int(lengths.sum()) // 2048) <= sequences <= lengths.sum() / 2048 * 1.02 + 3
    assert (plan["high"] - plan["low"]).sum() == n + extra


def test_records_that_cannot_be_written_have_no_layout():
    known = chat_format.registry()
    deep = '{"messages": ' + "[" * 100_000 + "]" * 100_000 + "}"
    for record in (r'{"prompt":"\ud800","completion":"x"}', r'{"\ud800":"x"}', r'{"messages":[{"role":"\udfff","content":"a"}]}', deep, '{"a":' * 3000 + "1" + "}" * 3000, "1" * 5000):
        assert chat_format.canonical_turns(record, known) == (None, None)
    assert chat_format.canonical_turns(r'{"prompt":"\ud83d\ude00","completion":"x"}', known) == ("prompt", [("user", "😀"), ("assistant", "x")])


def test_stages_without_a_write_between_and_two_at_once(spark):
    rng = np.random.default_rng(4)
    words = "alpha beta gamma delta the and of to in house tree river stone".split()
    texts = [" ".join(rng.choice(words, 80)) for _ in range(30)]
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts + texts[:5])], "doc_id long, text string, lang string, source string")
    here = "/root/testdata/sf0.001"
    kept = corpus_pipeline.near_duplicate_stage(spark, docs, here)
    chained = corpus_pipeline.decontamination_stage(spark, kept, here)
    assert sorted(r.doc_id for r in chained.collect()) == list(range(30))
    with ThreadPoolExecutor(2) as pool:
        both = list(pool.map(lambda d: corpus_pipeline.run(spark, d), [here, here]))
    assert sorted(map(str, both[0].collect())) == sorted(map(str, both[1].collect())) != []


@pytest.fixture(scope="module")
def licences():
    rng = np.random.default_rng(1)
    syllables = "ka lo mi ren tu sa vek pol dur nim the of and to in is not no".split()
    prose = [" ".join("".join(rng.choice(syllables, rng.integers(1, 3))) for _ in range(12)) for _ in range(150)]
    return license_scan.fit(prose), prose


def test_recall_of_planted_notices_by_family(licences):
    model, prose = licences
    rng = np.random.default_rng(2)
    for family, notices in license_scan.TEMPLATES.items():
        asked = hit = 0
        for notice in notices:
            for k in range(4):
                words = re.sub(r"\b([Ll])icense\b", r"\1icence", notice).split() if k == 1 else notice.split()
                if len(words) > 7 and k > 1:
                    words[int(rng.integers(len(words)))] = "xyz"
                text = f"{prose[int(rng.integers(150))]}.\n{' '.join(words)}\n{prose[int(rng.integers(150))]}"
                asked, hit = asked + 1, hit + (family in {h[1] for h in model.scan(text)})
        assert hit >= 0.9 * asked, (family, hit, asked)
    assert not any(model.scan(p) for p in prose)


def test_short_notices_denials_and_other_uses(licences):
    model, _ = licences
    families = lambda t: [h[1] for h in model.scan(t)]
    for t, f in (("License: MIT", "MIT"), ("MIT License\n\nCopyright (c) 2020 X", "MIT"), ("Distributed under the MIT licence.", "MIT"), ("Apache License\nVersion 2.0, January 2004", "Apache-2.0"), ("Zlib License", "Zlib"), ("GNU General Public License v3", "GPL-3.0")):
        assert families(t) == [f]
    for t in ("Not licensed under the MIT license anymore", "no longer covered by the BSD license", "the driving license was lost", "Licensed under the Foo license", "it was distributed under the same license as before"):
        assert families(t) == []
    assert families("This is not. Licensed under the MIT license") == ["MIT"]
    # What the regression doesn't name isn't compared with templates at all.
    silent = license_scan.Classifier(model.grams, model.weights * 0, model.temperature, 0.0)
    assert silent.named(license_scan.tokens("License: MIT")) != set() and not silent.scan("the license of poets")
    model_unknown = license_scan.Classifier(model.grams, np.concatenate([model.weights[:-1] * 0, np.eye(len(license_scan.FAMILIES))[:1] * 99]), 1.0, 0.0)
    assert model_unknown.named(license_scan.tokens("License: MIT")) == set() == set(families.__call__("plain words") or [])
    assert model_unknown.scan("License: MIT") == []


def slow_languages(labelled, texts):
    """(language, score) of each text, counted and scored with dictionaries."""
    cut = lambda t: "".join(chr(language_id._letter(c)) if c.isalpha() else " " for c in t or "").split()
    grams_of = lambda w, n: [f"<{w}>"[i : i + n] for i in range(len(w) + 3 - n)]
    counts = {n: {} for n in range(language_id.LONGEST + 1)}
    for lang, text in labelled:
        for w in cut(text):
            for n in counts:
                for entry in grams_of(w, n) if n else [w]:
                    counts[n].setdefault(entry, Counter())[lang] += 1
    languages = sorted({lang for lang, _ in labelled})
    totals = {n: {lang: 1 + sum(c[lang] for c in counts[n].values()) for lang in languages} for n in counts}
    unseen = {n: language_id.UNSEEN / max(totals[n].values()) for n in counts}
    logs = lambda n, c: [np.log(c[lang] / totals[n][lang] if c[lang] else unseen[n]) for lang in languages]
    out = []
    for text in texts:
        sums, known, any_word = np.zeros(len(languages)), 0, False
        for w in cut(text):
            any_word = True
            for n in (0, *range(language_id.LONGEST, 0, -1)):
                found = [logs(n, counts[n][g]) for g in (grams_of(w, n) if n else [w]) if g in counts[n]]
                if found:
                    sums, known = sums + np.mean(found, axis=0), known + 1
                    break
        chance = np.exp((sums - sums.max()) / np.sqrt(max(known, 1)))
        out.append((languages[int(sums.argmax())], chance.max() / chance.sum()) if any_word else ("und", 0.0))
    return out


def test_languages_by_a_slow_scorer(spark):
    rng = np.random.default_rng(8)
    stems = {"de": "der und nicht strasse haus über grün", "en": "the and not street house over green", "fr": "le et pas rue maison dessus vert"}
    labelled = [(lang, " ".join(str(w) + str(rng.choice(["", "s", "en", "é"])) for w in rng.choice(stems[lang].split(), 25))) for lang in stems for _ in range(6)]
    texts = [" ".join(str(w) + str(rng.choice(["", "x", "ung", "er"])) for w in rng.choice(" ".join(stems.values()).split(), int(rng.integers(1, 9)))) for _ in range(40)] + ["12 !", None, "ωψ", "Haus, HOUSE; maison", "q"]
    expected = slow_languages(labelled, texts)
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    learned = spark.createDataFrame(labelled, "lang string, text string")
    for limits in ((50_000, 4_000), (2, 1)):
        got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(rows, language_id.train(learned, *limits)).collect()}
        for i, (lang, score) in enumerate(expected):
            assert abs(got[i][1] - score) < 1e-6 and (got[i][0] == lang or abs(score - 1 / 3) < 1e-6), (texts[i], got[i], expected[i])


def test_quality_by_a_slow_scorer_and_its_risk():
    rng = np.random.default_rng(5)
    words = "alpha beta gamma delta eps zeta".split()
    good = [" ".join(rng.choice(words, 60)) + "." for _ in range(60)]
    bad = [" ".join(rng.choice(["$$$", "BUY", "now!!!", "alpha"], 40)) for _ in range(60)]
    slots = pu_quality.WordSlots()
    positive, mixed = [pu_quality.features(t, slots) for t in good[:40]], [pu_quality.features(t, slots) for t in good[40:] + bad[:20]]
    weights = pu_quality.fit(positive, mixed, 0.5)

    def slow(text):
        """The margin word by word: style, then each word's weight by the root of its count, over the length of that vector."""
        raw = (text or "").encode()
        total = sum(w * v for w, v in zip(weights, pu_quality.style_of(text or "", raw, raw.split())))
        slot_counts = Counter(slots[w] for w in raw.split())
        norm = sum(slot_counts.values()) ** 0.5
        return total + sum(pu_quality.WORD_WEIGHT * n**0.5 / norm * weights[s] for s, n in slot_counts.items())

    texts = [*good[:5], *bad[:5], "", None, "alpha", "x " * 500]
    assert np.allclose(pu_quality.score_texts(texts, weights, slots), [1 / (1 + np.exp(-np.clip(slow(t), -40, 40))) for t in texts])

    def risk(w):
        p, u = (np.array([float(v @ w[a]) for a, v in some]) for some in (positive, mixed))
        return 0.5 * np.logaddexp(0, -p).mean() + max(0.0, np.logaddexp(0, u).mean() - 0.5 * np.logaddexp(0, p).mean())

    ready = pu_quality.fit_calibrated(positive, mixed, 0.5)
    assert risk(ready) < min(risk(ready * 0), risk(-ready))
