import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pixelchange.llm import decision_list as dl
from tests.llm.helpers import prose, table, words


def plain_counts(text):
    w = words(text)
    triples = Counter(zip(w, w[1:], w[2:]))
    covered = set()
    for i in range(len(w) - 2):
        if triples[tuple(w[i:i + 3])] > 1:
            covered.update((i, i + 1, i + 2))
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
            "n_dup_lines": dup, "n_repeat_words": len(covered)}


TEXTS = ["", " \n\t ", "one", "a a a a a", "a b c a b c x a b", "line\nline\n\nline \nother\n \n ", "é#*$ü%&|<>日本\x0bx\x1cy\x85z",
         "w " * 3000, "\n".join(["same line here"] * 50), " ".join(prose(1, 500))]


def test_counts_against_python():
    r = random.Random(5)
    texts = TEXTS + ["".join(r.choice("ab é\n\t#|") for _ in range(r.randrange(80))) for _ in range(400)]
    got = dl.count_texts(pa.array(texts))
    for name in plain_counts(""):
        assert got[name].tolist() == [plain_counts(t)[name] for t in texts], name


def labelled():
    r = random.Random(2)
    docs, labels = [], []
    for i in range(400):
        good = i % 3 > 0
        w = prose(i, r.randrange(60, 120))
        if not good and i % 2:
            w = [x + r.choice(["###", "***"]) for x in w]
        elif not good:
            w = [x.upper() + "!!" for x in w]
        docs.append((i, " ".join(w)))
        labels.append((i, int(good)))
    return docs, labels


def test_learned_list_separates_and_matches_its_expression(spark):
    docs, labels = labelled()
    known = table(spark, labels, "doc_id long, quality int")
    rules = dl.learn_from(table(spark, docs), known)
    assert rules and all(not r.verdict for r in rules)
    got = {r["doc_id"]: r for r in dl.judge(table(spark, docs), rules).collect()}
    assert all(got[i]["kept"] == (q == 1) for i, q in labels)
    # The conditional expression says what the rules say row by row.
    counts = dl.count_texts(pa.array([t for _, t in docs]))
    x = {n: counts[a].astype(float) if b is None else np.divide(counts[a], counts[b], out=np.zeros(len(docs)), where=counts[b] > 0) for n, a, b in dl.FEATURES}
    fails = np.zeros(len(docs), bool)
    for rule in rules:
        fails |= rule.covers(x)
    assert [got[i]["kept"] for i, _ in docs] == [not f and not got[i]["base_failed"] for (i, _), f in zip(docs, fails)]


def test_noise_makes_no_rules():
    r = np.random.default_rng(0)
    rows = {"a": r.random(600), "b": r.random(600)}
    assert dl.learn(rows, r.random(600) > 0.2, np.arange(600) % 3 == 0) == []


def test_covering_finds_both_kinds_in_order():
    r = np.random.default_rng(1)
    a, b = r.random(900), r.random(900)
    good = ~((a > 0.8) | ((b < 0.2) & (a < 0.5)))
    rules = dl.learn({"a": a, "b": b}, good, np.arange(900) % 3 == 0)
    hit = np.zeros(900, bool)
    for rule in rules:
        hit |= rule.covers({"a": a, "b": b})
    assert len(rules) >= 2 and (hit == ~good).mean() > 0.97


@pytest.mark.parametrize("labels", [[], [(0, 1), (1, None), (None, 0)], [(0, 1), (1, 1)]])
def test_without_labels_only_the_base_rules(spark, labels):
    docs = [(0, " ".join(prose(0, 60))), (1, None), (2, ""), (None, "x"), (0, " ".join(prose(0, 60)))]
    out = dl.op2_quality_rules(table(spark, docs), table(spark, labels, "doc_id long, quality int")).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"], r["base_failed"], r["kept"]) for r in out) == [
        (False, 0, False, True), (False, 0, False, True), (False, 1, True, False), (False, 2, True, False), (True, None, True, False)]


def test_empty_table_and_clashing_columns(spark):
    labels = table(spark, [], "doc_id long, quality int")
    assert dl.op2_quality_rules(table(spark, []), labels).collect() == []
    df = table(spark, [(1, "x", 3, 4)], "doc_id long, text string, n_words int, quality int")
    assert dl.op2_quality_rules(df, table(spark, [(1, 0)], "doc_id long, quality int")).first()["n_words"] == 1
