import hashlib

import pytest
import sentencepiece

import __spark_entry__
import corpus_pipeline
from pixelchange.llm import lang_id
from pixelchange.llm.queries import piece_model
from tests.llm.helpers import links_and_classes, prose, removed_words, table, words, write
from tests.llm.test_language_id import text

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents():
    langs = ["aa", "bb", "cc"]
    docs = [(i, text(langs[i % 3], i, 60), langs[i % 3]) for i in range(60)]
    base = words(text("bb", 500, 150))
    docs += [(100 + i, " ".join(base[:i] + [f"neu{i}"] + base[i + 1:]), "bb") for i in range(4)]
    shared = text("aa", 900, 60)
    docs += [(200 + i, f"{text('aa', 600 + i, 60)}\n{shared}", "aa") for i in range(5)]
    docs += [(300, text("cc", 700, 50) + " " + " ".join(prose(77, 25)), "cc"), (301, "12 34 !!", "aa"), (302, None, "aa"), (303, "", None),
             (305, text("aa", 1, 60), None), (None, text("cc", 800, 40), "cc"), (400, shared, "aa")]
    return [(d, t, x, "s", None if t is None else len(t)) for d, t, x in docs]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    bench = table(spark, [(1, " ".join(prose(77, 25)))], "item_id long, text string")
    return write(spark, str(tmp_path_factory.mktemp("corpus")), documents=table(spark, documents(), SCHEMA), benchmark=bench)


def test_stages_against_brute_force(spark, folder):
    docs, frame, by_stage = documents(), spark.read.parquet(f"{folder}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, folder)
        by_stage.append(frame)
        frame = spark.createDataFrame(frame.collect(), frame.schema)
    assert all(f.columns == ["doc_id", "text", "lang", "source", "n_chars"] for f in by_stage[:-1])

    def key(rows):
        return sorted((d is None, d or 0, t) for d, t in rows)

    def got(i):
        return key([(r["doc_id"], r["text"]) for r in by_stage[i].collect()])

    one = [(d, t) for d, t, *_ in docs if t and any(c.isalpha() for c in t)]
    assert got(0) == key(one)
    two = [(d, t) for (d, t), (c, _) in zip(one, links_and_classes(one)) if d is None or c == d]
    assert got(1) == key(two) and len(two) < len(one)
    three = [(d, t if len(k) == len(words(t)) else " ".join(k)) for (d, t), k in zip(two, removed_words(two)) if k]
    assert got(2) == key(three) and 400 not in [d for d, _ in three] and 200 in [d for d, _ in three]
    four = [(d, t) for d, t in three if d != 300]
    assert got(3) == key(four)
    library = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    want = [(d is None, d or 0, len(library.encode(t)), hashlib.sha256(",".join(map(str, library.encode(t))).encode()).hexdigest()) for d, t in four]
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["ids_sha256"]) for r in by_stage[4].collect()) == sorted(want)


def test_run_is_the_stages_in_order(spark, folder):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language identification", "n-gram Jaccard join", "substring dedup", "benchmark decontamination", "SentencePiece"]
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, folder)
    pick = lambda df: sorted((r["doc_id"] is None, r["doc_id"] or 0, r["ids_sha256"]) for r in df.collect())
    assert pick(corpus_pipeline.run(spark, folder)) == pick(frame)


def test_extra_columns_and_empty_table(spark, folder):
    extra = SCHEMA + ", lang_pred string, score double, row string, n_words int, n_removed int, kept_text string, leaks string, class_id long, tag string, kind int"
    frame = table(spark, [(*d, "p", 0.5, "r", 1, 2, "k", "l", 3, "t", 4) for d in documents()[:30]], extra)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, folder)
        assert frame.columns == [c.split()[0] for c in extra.split(", ")]
    assert frame.count() == 30 and frame.first()["kept_text"] == "k"
    empty = table(spark, [], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, folder)
    assert empty.count() == 0


def test_repeated_rows_leave_one(spark, folder):
    d = documents()[0]
    out = corpus_pipeline.drop_near_duplicates(spark, table(spark, [d, d, (7, *d[1:])], SCHEMA), folder).collect()
    assert [r["doc_id"] for r in out] == [0]


def test_registered():
    names = __spark_entry__.queries()
    assert names["pipeline"] is corpus_pipeline.run and "pipeline" not in __spark_entry__.oracle_sql()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 11)}
    assert lang_id.UNDETERMINED == "und"
