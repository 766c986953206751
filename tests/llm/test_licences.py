from pathlib import Path

from pixelchange.llm import licences as lc
from pyspark.sql import functions as F
from tests.llm.helpers import table


def published(name):
    """A licence file as its publisher wraps it."""
    return (Path(__file__).parent / "published" / f"{name}.txt").read_text()


def found(spark, docs):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, r["license_id"], r["unit"], r["n_found"]) for r in lc.scan(table(spark, docs)).collect())


def test_spellings_case_punctuation_and_copyright_lines(spark):
    shouted = "Copyright (c) 2020 Some One\n(C) 2021 Another\n\n" + lc.MIT.upper().replace("LICENSE", "LICENCE").replace(",", " ,")
    docs = [(1, lc.MIT), (2, shouted), (3, "some text\nlicensed under the apache licence  Version 2.0\nmore"), (4, "Licensed under CC BY-NC 4.0"),
            (5, "This work is licenced under the GNU General Public Licence, v3!"), (6, "Not licensed under the MIT License at all."),
            (7, f"Preface\n\n{lc.ISC.split(chr(10) + chr(10))[0]}\n\nEnd"), (8, "© 2020 X\nReleased under the MIT License.\nReleased under the MIT licence")]
    got = found(spark, docs)
    assert (False, 1, "MIT", "text", 1) in got and (False, 2, "MIT", "text", 1) in got
    assert (False, 3, "Apache-2.0", "part", 1) in got and (False, 4, "CC-BY-NC-4.0", "text", 1) in got
    assert (False, 5, "GPL-3.0", "text", 1) in got and (False, 8, "MIT", "part", 2) in got
    assert not [g for g in got if g[1] in (6, 7)]


def test_edge_cases(spark):
    docs = [(1, None), (2, ""), (3, "\n\n\n"), (4, "word " * 100_000 + "\nReleased under the MIT License."), (5, "Released under the MIT License."),
            (5, "Released under the MIT License."), (None, "Released under the MIT License.")]
    assert found(spark, docs) == [(False, 4, "MIT", "part", 1), (False, 5, "MIT", "text", 2), (True, 0, "MIT", "text", 1)]
    assert found(spark, []) == []
    df = table(spark, [(1, lc.ZLIB, "x", 3)], "doc_id long, text string, license_id string, digest int")
    assert [tuple(r) for r in lc.scan(df).collect()] == [(1, "Zlib", "text", 1)]


def test_known_digests_are_distinct(spark):
    known = lc.known_digests(spark)
    assert known.count() == known.select("digest").distinct().count()
    forms = spark.createDataFrame(lc.KNOWN, "a string, b string").select(F.explode(lc.canonical(F.array("b"))).alias("form"))
    assert forms.where("form = ''").isEmpty()


def test_guards_skip_no_pattern(spark):
    """What a guard asks for is in every text that its pattern changes."""
    texts = [" ".join(x) for x in zip(*[iter(("licence", "sub", "licences", "non", "commercial", "acknowledgement", "favour", "copyright", "owners", "as", "is", "version", "2", "v", "3"))] * 3)]
    texts += ["sub licence non infringement", "as is as is", "copyright owner v 2 version 4", "plain"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    want = F.trim(F.regexp_replace(F.lower(F.regexp_replace(F.lower("t"), lc.COPYRIGHT_LINE, "$1")), lc.NOT_A_WORD, " "))
    for pattern, by, _ in lc.SPELLINGS:
        want = F.regexp_replace(want, pattern, by)
    got = rows.select(lc.canonical(F.array("t"))[0].alias("form"), want.alias("want"))
    assert got.where("form <> want").isEmpty()


def test_plan_has_no_python(spark):
    plan = lc.scan(table(spark, [(1, "x")]))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_entire_unlicense(spark):
    text = published("Unlicense")
    docs = [(1, text), (2, text.replace("http:", "https:")), (3, text.split("In jurisdictions")[0])]
    assert found(spark, docs) == [(False, 1, "Unlicense", "text", 1), (False, 2, "Unlicense", "text", 1)]


def test_published_files(spark):
    texts = {name: published(name) for name in ("MIT", "ISC", "Zlib", "Unlicense")}
    bare = {name: " ".join(line for line in t.splitlines() if not line.startswith("Copyright")) for name, t in texts.items()}
    names = sorted(texts)
    docs = [(i, texts[n]) for i, n in enumerate(names)] + [(10 + i, bare[n]) for i, n in enumerate(names)]
    assert found(spark, docs) == [(False, 10 * k + i, n, "text", 1) for k in (0, 1) for i, n in enumerate(names)]


def test_entire_licences_inside_a_document(spark):
    docs = [(1, "Read me\n\nSome words.\n\n" + published("ISC") + "\n\nmore"), (2, published("MIT") + "\n\n" + published("Zlib")),
            (3, "\n".join([published("MIT")] * 3)), (4, "x" + published("Unlicense").strip() + "x"), (5, f"Text\n{lc.ISC.replace(chr(10), ' ')}\nText")]
    assert found(spark, docs) == [(False, 1, "ISC", "part", 1), (False, 2, "MIT", "part", 1), (False, 2, "Zlib", "part", 1),
                                  (False, 3, "MIT", "part", 3), (False, 5, "ISC", "part", 1)]


def test_copyright_lines(spark):
    gone = ["Copyright (c) 2020 A", "copyright 1999-2004, B Inc.", "© C", "(C) 2021 D", "# Copyright Some One", "Copyright by E",
            "Copyright <YEAR> <HOLDER>", " * Copyright Andreas Noticer, F."]
    kept = ["copyright notice and this permission notice appear in all copies.", "copyright holders and contributors", "copyright law", "(c) You must keep it",
            "copyright", "copyright, patent and trademark", "copyright interest in the"]
    forms = spark.createDataFrame([(x,) for x in gone + kept], "t string").select("t", lc.canonical(F.array("t"))[0].alias("form")).collect()
    assert {r["t"] for r in forms if r["form"] == ""} == set(gone)
    assert all(r["form"] == lc_words(r["t"]) for r in forms if r["t"] in kept)


def lc_words(text):
    return " ".join("".join(c if c.isalnum() else " " for c in text.lower()).split())


def test_published_files_of_longer_licences(spark):
    names = ["Apache-2.0", "BSD-2-Clause", "BSD-3-Clause"]
    docs = [(i, published(n)) for i, n in enumerate(names)] + [(10 + i, f"Read me\n\n{published(n)}\n\nmore") for i, n in enumerate(names)]
    docs += [(20, lc.TEXTS["Apache-2.0"]), (21, lc.TEXTS["GPL-3.0"].replace("https:", "http:")), (22, " ".join(lc.TEXTS["MPL-2.0"].split()))]
    assert found(spark, docs) == ([(False, i, n, "text", 1) for i, n in enumerate(names)] + [(False, 10 + i, n, "part", 1) for i, n in enumerate(names)]
                                  + [(False, 20, "Apache-2.0", "text", 1), (False, 21, "GPL-3.0", "text", 1), (False, 22, "MPL-2.0", "text", 1)])


def test_no_licence_holds_another(spark):
    forms = spark.range(1).select(*[lc.whole_form(x).alias(f"c{i}") for i, (_, x, _) in enumerate(lc.LICENCES)]).first()
    assert not [(i, j) for i, a in enumerate(forms) for j, b in enumerate(forms) if i != j and f" {a} " in f" {b} "]
