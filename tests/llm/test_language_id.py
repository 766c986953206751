import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from pixelchange.llm import lang_id as li
from tests.llm.helpers import table

SYLLABLES = {"aa": ["ka", "ro", "mi", "tu"], "bb": ["sch", "ein", "ung", "tz"], "cc": ["eau", "que", "oi", "é"]}


def text(lang, seed, n=30):
    r = random.Random(f"{lang}{seed}")
    return " ".join("".join(r.choices(SYLLABLES[lang], k=r.randrange(1, 4))) for _ in range(n)).capitalize() + "."


def documents(n=300):
    langs = sorted(SYLLABLES)
    return [(i, text(langs[i % 3], i), langs[i % 3]) for i in range(n)]


SCHEMA = "doc_id long, text string, lang string"


def test_held_out_accuracy_and_folds(spark):
    docs = documents()
    got = {r["doc_id"]: r for r in li.op6_language_id(table(spark, docs, SCHEMA)).collect()}
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, _, _ in docs)
    held = [i for i, _, _ in docs if got[i]["held_out"]]
    assert len(held) > 50 and all(got[i]["lang_pred"] == docs[i][2] for i in held)
    assert all(0 < r["score"] <= 1 for r in got.values())


def test_held_out_labels_and_own_language_are_never_used(spark):
    docs = documents()
    hidden = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 3 == 1 else x) for i, t, x in docs]
    a = sorted((r["doc_id"], r["lang_pred"], r["score"]) for r in li.op6_language_id(table(spark, docs, SCHEMA)).collect())
    b = sorted((r["doc_id"], r["lang_pred"], r["score"]) for r in li.op6_language_id(table(spark, hidden, SCHEMA)).collect())
    assert a == b


def test_scores_against_a_plain_sum(spark):
    docs = documents(60)
    model = li.train(table(spark, docs, SCHEMA))
    texts = [t for _, t, _ in docs] + ["é", "Ka", "x" * 5000]
    langs, _ = li.score_texts(pa.array(texts), model)
    for t, lang in zip(texts, langs):
        grams, _ = li.gram_buckets(pa.array([t]))
        total = model["prior"] + sum(model["logp"][g].astype(float).sum(axis=0) for g in grams)
        assert lang == model["langs"][int(np.argmax(total))]
    # Texts are scored alike alone and in company.
    alone = [li.score_texts(pa.array([t]), model) for t in texts]
    assert [a[0][0] for a in alone] == langs


def test_counts_are_those_of_the_texts(spark):
    docs = documents(30)
    model = li.train(table(spark, docs, SCHEMA), smoothing=1.0)
    grams, _ = li.gram_buckets(pa.array([t for _, t, x in docs if x == "bb"]))
    counts = sum(np.bincount(g, minlength=1 << li.BITS) for g in grams) + 1.0
    column = model["logp"][:, model["langs"].index("bb")]
    assert np.allclose(column, np.log(counts / counts.sum()), atol=1e-4)


def test_edge_cases(spark):
    docs = documents(90) + [(1000, None, "aa"), (1001, "", "bb"), (1002, "123 !?", None), (None, text("cc", 1), "cc"), (0, documents(1)[0][1], "aa"),
                            (1003, text("bb", 5, 40_000), None)]
    got = [(r["doc_id"], r["held_out"], r["lang_pred"], r["score"]) for r in li.op6_language_id(table(spark, docs, SCHEMA)).collect()]
    by = {g[0]: g for g in got}
    assert len(got) == len(docs)
    assert all(by[i][2:] == ("und", 0.0) for i in (1000, 1001, 1002))
    assert by[None][1:3] == (False, "cc") and by[1003][2] == "bb"
    assert len([g for g in got if g[0] == 0]) == 2 and len({g for g in got if g[0] == 0}) == 1


def test_nothing_to_learn_from(spark):
    docs = [(1, "words here", None), (2, None, None)]
    assert {(r["lang_pred"], r["score"]) for r in li.op6_language_id(table(spark, docs, SCHEMA)).collect()} == {("und", 0.0)}
    assert li.op6_language_id(table(spark, [], SCHEMA)).collect() == []


def test_too_many_languages(spark):
    with pytest.raises(ValueError):
        li.train(table(spark, documents(30), SCHEMA), max_languages=2)


def test_clashing_columns(spark):
    df = table(spark, [(i, t, x, 1.0, "p") for i, t, x in documents(30)], SCHEMA + ", score double, lang_pred string")
    row = li.identify(df, li.train(df)).first()
    assert row["row"]["lang_pred"] == "p" and row["row"]["score"] == 1.0 and row["lang_pred"] == row["row"]["lang"]
