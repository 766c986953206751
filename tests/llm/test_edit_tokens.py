import random
import time

import public_tokenizers
import pytest

from pixelchange.llm import edit_tokens as et
from tests.llm.helpers import prose, table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def counter():
    return et.Counter(et.read_ranks(RANKS))


def full(counter, text):
    return len(counter.encoding.encode_ordinary(text))


@pytest.mark.parametrize("segment", [1, 2, 5, 32])
def test_edits_against_encoding_again(counter, monkeypatch, segment):
    monkeypatch.setattr(et, "SEGMENT", segment)
    r, letters = random.Random(segment), "ab  'rest'll \n1é.,!日 "
    for _ in range(600):
        text = "".join(r.choice(letters) for _ in range(r.randrange(60)))
        tree = counter.tree(text)
        for _ in range(r.randrange(1, 5)):
            a = r.randint(0, len(text))
            b = min(len(text), a + r.choice([0, 0, 1, 2, 5, 20]))
            by = "".join(r.choice(letters) for _ in range(r.choice([0, 0, 1, 2, 9])))
            text, _ = counter.edit(text, tree, a, b, by)
            assert tree.total() == full(counter, text) and tree.chars[1] == len(text)


def test_only_the_touched_region_is_encoded(counter):
    text = " ".join(prose(1, 20_000))
    tree = counter.tree(text)
    new, anew = counter.edit(text, tree, 50_000, 50_004, "changed")
    assert tree.total() == full(counter, new) and anew < 2000


def test_query_against_encoding_again(spark, counter):
    docs = [(1, "mail me at some.one@example.org or 10.20.30.40, card 4381893557741609."), (2, "line one\nother\nline one\nline one"), (3, ""), (4, None),
            (5, " ".join(prose(2, 30_000)) + " a@b.co"), (2, "line one\nother\nline one\nline one"), (None, "x@y.zz"), (6, "\n\n\n")]
    got = et.op5_token_counts(table(spark, docs), RANKS).collect()
    want = []
    for d, t in docs:
        new = t or ""
        for a, b, by in reversed(et.redactions(new)):
            new = new[:a] + by + new[b:]
        want.append((d is None, d or 0, full(counter, t or ""), full(counter, new), len(et.redactions(t or ""))))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens_before"], r["n_tokens"], r["n_edits"]) for r in got) == sorted(want)
    assert et.op5_token_counts(table(spark, []), RANKS).collect() == []


def test_redactions_say_what_they_mask():
    text = "to a.b@c.de, 1.2.3.4 and 1234567890123456\nx\nx"
    out = text
    for a, b, by in reversed(et.redactions(text)):
        out = out[:a] + by + out[b:]
    assert out == "to <EMAIL>, <IP> and <NUMBER>\nx\n"


def test_stored_trees_take_any_edits(spark, counter):
    """Unordered, overlapping, out of range, null and equal edits have a defined result."""
    text = "some words to be edited here"
    edits = [(20, 26, "kept"), (0, 4, "Any"), (2, 9, None), (100, 120, "!"), (-5, 0, "> "), (20, 20, "+")]
    trees = et.build_trees(table(spark, [(1, text, 0), (2, None, 0), (3, text, 0)], "doc_id long, text string, tokens int"), RANKS)
    rows = trees.selectExpr("*", "CASE WHEN doc_id < 3 THEN array(" + ",".join(
        f"named_struct('start', {a}, 'end', {b}, 'by', {'CAST(NULL AS STRING)' if t is None else repr(t)})" for a, b, t in edits) + ") END AS edits")
    got = {r["doc_id"]: r for r in et.apply_edits(rows, RANKS).collect()}
    for d, body in ((1, text), (2, "")):
        new = body
        for a, b, by in reversed(et.disjoint(edits, len(body))):
            new = new[:a] + by + new[b:]
        assert got[d]["text"] == new and got[d]["n_tokens"] == full(counter, new)
    assert got[3]["text"] == text and got[3]["n_edits"] == 0 and got[3]["n_tokens"] == got[3]["n_tokens_before"]


def test_dense_edits_are_linear(counter):
    """A contact list: a thousand edits in 60 KB, each line masked."""
    r = random.Random(4)
    text = "\n".join(f"Person {i} writes from name{i}.{r.randrange(999)}@mail{i % 7}.example.org today" for i in range(1000))
    todo = et.redactions(text)
    assert len(todo) == 1000
    tree = counter.tree(text)
    began = time.process_time()
    new, anew = counter.edit_all(text, tree, todo)
    assert time.process_time() - began < 0.5
    assert tree.total() == full(counter, new) and anew <= len(new)
    assert max(tree.leaves()[0]) < 40 * et.SEGMENT and sum(tree.leaves()[0]) == len(new)
    # again and again: segments keep their size
    for _ in range(3):
        at = sorted(r.sample(range(len(new)), 200))
        new, _ = counter.edit_all(new, tree, et.disjoint([(a, a + r.randrange(3), r.choice(["", "x", " y ", "\n"])) for a in at], len(new)))
        assert tree.total() == full(counter, new)
        assert max(tree.leaves()[0]) < 40 * et.SEGMENT


def test_many_edits_at_once_equal_encoding_again(counter):
    r = random.Random(8)
    letters = "ab  c\n1'sé.,\t"
    for _ in range(300):
        text = "".join(r.choice(letters) for _ in range(r.randrange(400)))
        tree = counter.tree(text)
        for _ in range(3):
            places = [r.randrange(len(text) + 1) for _ in range(r.randrange(12))]
            todo = et.disjoint([(a, a + r.randrange(6), "".join(r.choice(letters) for _ in range(r.randrange(5)))) for a in places], len(text))
            text, _ = counter.edit_all(text, tree, todo)
            assert tree.total() == full(counter, text)
            assert sum(tree.leaves()[0]) == len(text)
