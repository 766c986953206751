"""License scan by canonical digests, in DataFrame functions only.

A text is brought to a canonical form (case, punctuation, copyright lines,
equivalent spellings) and its digest is joined with the digests of known
notices and licences.  Whole texts, their paragraphs and their lines are
looked up, each as an entire text, so a notice inside a longer document is
found as well.  Entire licences are looked for at every place of a text,
whatever its paragraphs are; their forms know no line wraps.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Published licence texts and the usual notices (public texts).
# ---------------------------------------------------------------------------

MIT = """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""

UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <http://unlicense.org>"""

# (licence, text without title, titles that stand above it)
LICENCES = [
    ("MIT", MIT.removeprefix("MIT License\n\n"), ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "MIT", "Expat License"]),
    ("ISC", ISC, ["ISC License", "The ISC License", "ISC License (ISC)", "ISC"]),
    ("Zlib", ZLIB, ["zlib License", "The zlib License", "zlib/libpng License", "The zlib/libpng License", "zlib"]),
    ("Unlicense", UNLICENSE, ["The Unlicense", "Unlicense"]),
    ("Unlicense", UNLICENSE.replace("http:", "https:"), ["The Unlicense", "Unlicense"]),
]

# Longer texts as published.  BSD's conditions have numbers or marks; texts with an appendix
# on their use also stand without it; addresses in them have https or http.
TEXTS = {p.stem: p.read_text() for p in sorted((Path(__file__).parent / "licence_texts").glob("*.txt"))}
END = "END OF TERMS AND CONDITIONS"
FILES = []                  # (licence, text that holds one of LICENCES)
for _name, _names in (("BSD-2-Clause", ["BSD 2-Clause License", 'BSD 2-Clause "Simplified" License', "Simplified BSD License"]),
                      ("BSD-3-Clause", ["BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License', "New BSD License", "Modified BSD License"])):
    _titles = [x + y for y in ("", "\n\nAll rights reserved.") for x in ("", *_names, *(f"The {n}" for n in _names))][1:]
    LICENCES += [(_name, TEXTS[_name], _titles), (_name, re.sub(r"(?m)^\d\. ", "* ", TEXTS[_name]), _titles)]
for _name in ("Apache-2.0", "CC0-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0"):
    for _text in dict.fromkeys((TEXTS[_name], TEXTS[_name].replace("https:", "http:"), TEXTS[_name].replace("http:", "https:"))):
        if END in _text:
            FILES.append((_name, _text))
        _body = _text.partition(END)[0] + END if END in _text else _text
        _form = re.sub(r"(?mi)^\W*copyright \(c\).*$", "", _body)       # an address may stand in a copyright line only
        if all(_form != re.sub(r"(?mi)^\W*copyright \(c\).*$", "", x) for _, x, _ in LICENCES):
            LICENCES.append((_name, _body, []))

# (licence, text); several notices may name one licence.
KNOWN = [
    ("MIT", MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", ISC),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("Zlib", ZLIB),
    ("Unlicense", UNLICENSE),
    ("Unlicense", UNLICENSE.replace("http:", "https:")),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under CC BY 4.0."),
]

KNOWN += [(x.removesuffix("-only"), f"SPDX-License-Identifier: {x}") for x in (
    "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "Zlib", "Unlicense", "CC0-1.0", "GPL-2.0-only", "LGPL-2.1-only", "LGPL-3.0-only")]
KNOWN += [(x, f"{verb} under the {name}.") for verb in ("Licensed", "Released")
          for x, name in (("BSD-2-Clause", "BSD 2-Clause License"), ("BSD-3-Clause", "BSD 3-Clause License"), ("MPL-2.0", "Mozilla Public License, Version 2.0"))]
KNOWN += FILES
KNOWN += [(licence, f"{title}\n\n{body}") for licence, body, titles in LICENCES for title in ["", *titles]]


NO_LETTER = r"\x00-\x60\x7b-\x7f"       # of lower case text; all beyond ASCII counts as letters, which keeps patterns small


def other_word(words: list[str]) -> str:
    """Pattern of a run of letters that is none of ``words``, up to the end of the run
    (no engine that the scan runs on has lookaheads in common)."""
    starts = sorted({w[0] for w in words if w})
    follow = [f"{c}{other_word([w[1:] for w in words if w[:1] == c])}" for c in starts]
    rest = [f"[^{NO_LETTER}{''.join(starts)}][^{NO_LETTER}]*"]
    return "(?:" + "|".join(follow + rest + ([] if "" in words else [""])) + ")"


# Words that follow "copyright" at the start of a line of body text.
BODY_WORDS = ["", "a", "act", "and", "any", "as", "assignment", "conditions", "dedication", "disclaimer", "disclaimers", "for", "from",
              "grant", "has", "holder", "holders", "if", "in", "information", "infringement", "interest", "interests", "is", "it", "law", "laws",
              "licence", "licences", "license", "licensed", "licenses", "line", "lines", "management", "may", "must", "notice", "notices",
              "of", "on", "or", "other", "owned", "owner", "owners", "ownership", "permission", "permissions", "protection", "related", "right",
              "rights", "rules", "shall", "statement", "statements", "status", "such", "that", "the", "this", "to", "treaties", "treaty",
              "under", "which", "will", "with", "work", "works", "you"]

# (pattern, replacement, what a match must contain) over lower case text, in order.
# A copyright line has (c), a year or a name (up to eight words, to the end of the line).
COPYRIGHT_LINE = (r"(^|\n)[^\n\p{L}\p{N}]*(?:©|\(c\)[^\n\p{L}\p{N}]*(?:copyright|\d{4}|year|yyyy)|copyright[^\n\p{L}]*(?:\(c\)|©|\d{4}|year|yyyy|by )"
                  r"|copyright:?[ \t]+" + other_word(BODY_WORDS) + r"(?:[\x21-\x60\x7b-\x7f][^ \t\n]*)?(?:[ \t]+[^ \t\n]+){0,7}[ \t\r]*(?m:$))[^\n]*")
COPYRIGHT_MARKS = ["copyright", "(c)", "©"]
NOT_A_WORD = r"[^\p{L}\p{N}]+"
SPELLINGS = [
    (r"\bsub licen", "sublicen", "sub licen"),
    (r"\b(sub)?licen[cs](e|es|ed|ing|or|ee)\b", "$1licens$2", "licen"),
    (r"\bnon (commercial|infringement)\b", "non$1", "non "),
    (r"\backnowledgement\b", "acknowledgment", "acknowledgement"),
    (r"\bfavour\b", "favor", "favour"),
    (r"\bcopyright owner(s?)\b", "copyright holder$1", "copyright owner"),
    (r"\bas is\b", "asis", "as is"),
    (r"\bversion (\d)", "v$1", "version "),
    (r"\bv (\d)", "v$1", "v "),
]


def canonical(texts: Column) -> Column:
    """Canonical forms of an array of texts ('' where nothing is left).

    A pattern is only tried where what it needs is there: looking for a
    fixed string is much cheaper than a pattern on every line.  Each step
    names its text once (a lambda's variable), so the expression stays small."""
    def without_copyright(c):
        marked = F.lit(False)
        for mark in COPYRIGHT_MARKS:
            marked = marked | c.contains(mark)
        return F.when(marked, F.regexp_replace(c, COPYRIGHT_LINE, "$1")).otherwise(c)

    def spell(pattern, by, needs):
        return lambda c: F.when(c.contains(needs), F.regexp_replace(c, pattern, by)).otherwise(c)

    out = F.transform(F.transform(texts, F.lower), without_copyright)
    out = F.transform(out, lambda c: F.trim(F.regexp_replace(c, NOT_A_WORD, " ")))
    for rule in SPELLINGS:
        out = F.transform(out, spell(*rule))
    return out


def known_digests(spark: SparkSession, known=KNOWN) -> DataFrame:
    """``license_id`` and ``digest`` of the catalogue, one row a digest (the first licence wins)."""
    rows = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(known)], "i int, license_id string, body string")
    return (rows.select("i", "license_id", F.md5(canonical(F.array("body"))[0]).alias("digest"))
            .groupBy("digest").agg(F.min_by("license_id", "i").alias("license_id")))


UNITS = "array<struct<unit:string,digest:string,n:bigint,held:boolean>>"


def whole_form(text: str) -> Column:
    """Canonical form of a fixed text, which the planner works out once."""
    out = F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.lit(text)), COPYRIGHT_LINE, "$1"), NOT_A_WORD, " "))
    for pattern, by, _ in SPELLINGS:
        out = F.regexp_replace(out, pattern, by)
    return out


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", known=KNOWN, licences=LICENCES, files=FILES) -> DataFrame:
    """Licences found in each row's whole text.

    One row per ``key``, ``license_id`` and ``unit`` (``text``: the whole text
    is a known one, ``part``: some of its paragraphs or lines are, or it holds
    one of ``licences`` entirely), with the number of such parts.  A licence
    counts once at each place, with or without a title.  A null or empty text has none; equal rows are
    counted together under their key; other columns are ignored."""
    spark = docs.sparkSession
    body = F.col("_text")
    lines = F.filter(F.split(body, r"\n"), lambda x: x != body)
    paragraphs = F.when(F.regexp_like(body, F.lit(r"\n\s*\n")),
                        F.filter(F.split(body, r"\n\s*\n"), lambda x: x.contains("\n") & (x != body))).otherwise(F.array().cast("array<string>"))
    units = (docs.select(F.col(key).alias(key), F.col(text).alias("_text")).where(body.isNotNull())
             .select(key, F.posexplode(canonical(F.concat(F.array(body), lines, paragraphs))).alias("_i", "_form")))

    entire = [F.md5(whole_form(f"{title}\n\n{licence}")) for _, licence, titles in licences for title in ["", *titles]]
    entire += [F.md5(whole_form(file)) for _, file in files]

    def found(unit, digest, n, held):
        return F.struct(F.lit(unit).alias("unit"), digest.alias("digest"), n.cast("long").alias("n"), F.lit(held).alias("held"))

    def places(licence):
        # Forms of several words, each between two spaces of its own: copies side by side are all counted.
        spaced = [F.concat(F.lit(" "), F.replace(x, F.lit(" "), F.lit("  ")), F.lit(" ")) for x in (F.col("_form"), whole_form(licence))]
        n = (F.length(spaced[0]) - F.length(F.replace(*spaced, F.lit("")))) / F.length(spaced[1])
        return F.when(F.col("_form").contains(whole_form(licence)) & spaced[0].contains(spaced[1]),
                      found("part", F.md5(whole_form(licence)), n, True))

    one = found("text", F.md5("_form"), F.lit(1), False)
    parts = F.when(~F.md5("_form").isin(entire), F.filter(F.array(*[places(x) for _, x, _ in licences]), lambda x: x.isNotNull()))
    units = (units.select(key, F.explode(F.when(F.col("_i") == 0, F.concat(F.array(one), F.coalesce(parts, F.array().cast(UNITS))))
                                         .otherwise(F.array(found("part", F.md5("_form"), F.lit(1), False)))).alias("_u")).select(key, "_u.*"))
    # The catalogue is a fixed list of a few rows: its broadcast can't grow with the data.
    names = known_digests(spark, known).withColumn("entire", F.col("digest").isin(entire))
    hits = units.join(F.broadcast(names), "digest").where((F.col("unit") == "text") | F.col("held") | ~F.col("entire"))
    return hits.groupBy(key, "license_id", "unit").agg(F.sum("n").alias("n_found"))


def scan_sql(known=KNOWN) -> str:
    """The scan of ``documents`` as DuckDB SQL."""
    def quoted(s):
        return "'" + s.replace("'", "''") + "'"

    def canon(x):
        out = f"regexp_replace(lower({x}), {quoted(COPYRIGHT_LINE)}, '\\1', 'g')"
        out = f"trim(regexp_replace({out}, {quoted(NOT_A_WORD)}, ' ', 'g'))"
        for pattern, by, _ in SPELLINGS:
            out = f"regexp_replace({out}, {quoted(pattern)}, {quoted(by.replace('$', chr(92)))}, 'g')"
        return out

    rows = ", ".join(f"({i}, {quoted(a)}, {quoted(b)})" for i, (a, b) in enumerate(known))
    return f"""
    WITH known AS (SELECT md5({canon('body')}) AS digest, arg_min(license_id, i) AS license_id
                   FROM (VALUES {rows}) AS k(i, license_id, body) GROUP BY 1),
    units AS (
      SELECT doc_id, 'text' AS unit, text AS body FROM documents WHERE text IS NOT NULL
      UNION ALL
      SELECT doc_id, 'part', p FROM (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS p FROM documents) WHERE p <> text
      UNION ALL
      SELECT doc_id, 'part', p FROM (SELECT doc_id, text, unnest(regexp_split_to_array(text, '\\n\\s*\\n')) AS p FROM documents)
      WHERE p <> text AND contains(p, chr(10)))
    SELECT doc_id, license_id, unit, count(*) AS n_found
    FROM (SELECT doc_id, unit, md5({canon('body')}) AS digest FROM units) JOIN known USING (digest)
    GROUP BY 1, 2, 3"""
