"""The pipeline's stages, one after the other, against plain Python on an odd table, and on an empty one."""

import re

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from millrace.llm import decontaminate, language_id, packing, quality_rules
from tests.llm.test_text_operators import components, crc, library_ids, shingles

EN, DE = "the house of and street not water with green tree".split(), "der und nicht haus strasse wasser mit gruen baum das".split()


def prose(words, seed, n, start=0):
    rng = np.random.default_rng(seed)
    return " ".join([f"{words[k]}{'' if j % 3 else 'en' if words is DE else 'ing'}" for j, k in enumerate(rng.integers(0, len(words), n), start)])


def rows():
    item = prose(EN, 900, 30)
    a, b = prose(EN, 1, 80), prose(DE, 2, 90)
    spoiled = item.split()
    spoiled[7] = "xyzzy"
    return item, [
        (1, a, "en"), (2, a, "en"), (2, a + " end", "en"), (2, b, "de"), (3, b.upper(), "de"), (4, None, "en"), (5, "", None), (6, "12 ! 3", "en"), (None, a, "en"), (None, prose(EN, 3, 70), None), (None, prose(EN, 3, 70), None),
        (7, prose(DE, 4, 60), "en"), (8, "the house", "en"), (9, prose(EN, 5, 60) + " " + item + " " + prose(EN, 6, 40), "en"), (10, prose(EN, 7, 60) + " " + " ".join(spoiled), "en"), (11, " ".join(EN[j % 10] + chr(97 + j // 676 % 26) + chr(97 + j // 26 % 26) + chr(97 + j % 26) for j in range(9000)), "en"),
        (12, "the house of the tree " * 30, "en"), (13, prose(DE, 9, 75), None), (14, prose(DE, 9, 74) + " fremd", "de"),
    ] + [(100 + i, prose(EN if i % 2 else DE, 100 + i, 60), "en" if i % 2 else "de") for i in range(30)]


@pytest.fixture(scope="module")
def setting(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    item, docs = rows()
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    # Names that the stages use inside.
    table = [(d, t, lang, "x", i, i, "s") for i, (d, t, lang) in enumerate(docs)]
    spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long, set_id long, root string").coalesce(2).write.parquet(f"{root}/documents.parquet")
    return root, item, docs


def test_stages_against_plain_python(spark, setting):
    root, item, docs = setting
    table = spark.read.parquet(f"{root}/documents.parquet")
    columns, predictor = table.columns, language_id.Predictor(language_id.train(table, 10**6, 10**6))
    alive = list(range(len(docs)))
    view = lambda i: docs[i][1]

    def right_language(i):
        lang, score, behind = predictor.judge(pa.array([view(i)], pa.string()), [docs[i][2]])[0]
        return lang != "und" and score >= 0.5 and behind < language_id.CONTRADICTED

    def clean(i):
        x, normal = decontaminate, lambda t: decontaminate.normalise(decontaminate._code_points(t), decontaminate._folding())[0]
        wanted, have = normal(item), normal(view(i))
        row = np.zeros(len(have) + 1, dtype=int)
        for n, c in enumerate(wanted, 1):
            new = np.minimum(np.append(n, row[:-1] + (have != c)), row + 1)
            row = np.minimum.accumulate(new - np.arange(len(new))) + np.arange(len(new))
        return row.min() > x.edit_budget(len(wanted))[0]

    def stays(alive):
        root_of = components([(i, shingles(view(i))) for i in alive])
        order = lambda i: (docs[i][0] is None, docs[i][0] or 0, i)
        best = {}
        for i in sorted(alive, key=order, reverse=True):
            best[root_of[i]] = i
        return {i for i in alive if best[root_of[i]] == i}

    expected = {
        "language_id": lambda alive: {i for i in alive if right_language(i)},
        "quality_rules": lambda alive: {i for i in alive if quality_rules.first_reject(quality_rules.TextView(view(i)), list(quality_rules.RULES)) is None},
        "near_duplicates": stays,
        "decontamination": lambda alive: {i for i in alive if clean(i)},
    }
    docs_now = table
    for name, step in corpus_pipeline.STAGES[:-1]:
        found = step(spark, docs_now, root)
        assert found.columns == columns
        found.write.parquet(f"{root}/{name}.parquet")
        docs_now = spark.read.parquet(f"{root}/{name}.parquet")
        got, alive = [r.n_chars for r in docs_now.collect()], sorted(expected[name](alive))
        # Of rows that are equal in id and text, any may be the one that stays.
        same = lambda ids: sorted((docs[i][0] or -1, docs[i][1]) for i in ids)
        assert same(got) == same(alive), name
        alive = got
    assert {docs[i][0] for i in alive} >= {1, 2, 11, 13, 101} and not {3, 4, 5, 6, 7, 8, 9, 10, 12, 14} & {docs[i][0] for i in alive}
    pieces = corpus_pipeline.run(spark, root).collect()
    whole = []
    for i in alive:
        ids = library_ids("word_bpe_49k.json", view(i))
        whole += [(docs[i][0] or -1, k // packing.CAPACITY, len(ids[k : k + 2048]), crc(ids[k : k + 2048])) for k in range(0, len(ids), 2048)]
    assert sorted((r.doc_id or -1, r.piece, r.length, r.ids_crc32) for r in pieces) == sorted(whole)


def test_stages_on_nothing(spark, setting):
    root, *_ = setting
    docs = spark.read.parquet(f"{root}/documents.parquet").where("false")
    for name, step in corpus_pipeline.STAGES:
        found = step(spark, docs, root)
        assert found.count() == 0
        assert found.columns == docs.columns or name == "packing"


def test_stages_are_named():
    assert [re.sub("_stage$", "", f.__name__) for _, f in corpus_pipeline.STAGES] == ["language", "quality", "near_duplicate", "decontamination", "packing"]
