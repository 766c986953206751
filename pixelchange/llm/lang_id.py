"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams of all labelled texts inside the tasks and adds
them up with one Spark aggregate; what reaches the driver is the matrix of
log probabilities, whose size is bounded by languages x buckets (both are
parameters).  Scoring looks the hashed n-grams of a batch of texts up in
the broadcast matrix and adds them up per text with numpy.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixelchange.llm.common import slices, strings

UNDETERMINED = "und"
ORDERS = (1, 2, 3)          # lengths of the n-grams
BITS = 15                   # 2^15 buckets
SMOOTHING = 0.5
MAX_LANGUAGES = 256         # bound of the broadcast matrix: 256 x 2^15 x 4 bytes = 32 MiB
# The score is the softmax of (mean log likelihood of an n-gram) x SHARPNESS.
SHARPNESS = 10.0


def gram_buckets(texts: pa.Array, orders=ORDERS, bits: int = BITS):
    """Buckets of all n-grams as one array per order, and the text offsets in them.

    Texts are lowercased and each comes after so many blanks that no n-gram
    holds characters of two texts."""
    pad = " " * (max(orders) - 1)
    lower = pc.utf8_lower(texts).to_pylist()
    lens = np.fromiter((len(pad) + len(t) for t in lower), np.int64, len(lower))
    offsets = np.concatenate([[0], np.cumsum(lens)])
    chars = np.frombuffer("".join([x for t in lower for x in (pad, t)] + [pad]).encode("utf-32-le"), np.uint32)
    n = int(offsets[-1])
    out, acc = [], np.zeros(n, np.uint32)
    with np.errstate(over="ignore"):
        for k in range(max(orders)):
            acc = (acc ^ chars[k:k + n]) * np.uint32(0x9E3779B1)
            acc ^= acc >> np.uint32(15)
            if k + 1 in orders:
                out.append(((acc * np.uint32(0x85EBCA6B)) >> np.uint32(32 - bits)).astype(np.int32))
    return out, offsets


def _count(batches, orders, bits):
    counts: dict[str, np.ndarray] = {}
    texts_of: dict[str, int] = {}
    for batch in batches:
        for part in slices(batch, "text"):
            langs = part.column(1).to_pylist()
            grams, offsets = gram_buckets(strings(part.column(0)), orders, bits)
            names = sorted(set(langs))
            which = np.repeat(np.array([names.index(x) for x in langs]), np.diff(offsets))
            for i, name in enumerate(names):
                mine = which == i
                row = counts.setdefault(name, np.zeros(1 << bits, np.int64))
                for g in grams:
                    row += np.bincount(g[mine], minlength=1 << bits)
                texts_of[name] = texts_of.get(name, 0) + langs.count(name)
    for name, row in counts.items():
        at = np.flatnonzero(row)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * (len(at) + 1)), pa.array(np.append(at, -1), pa.int32()),
             pa.array(np.append(row[at], texts_of[name]), pa.int64())], names=["lang", "bucket", "n"])


def train(labelled: DataFrame, orders=ORDERS, bits: int = BITS, smoothing: float = SMOOTHING,
          max_languages: int = MAX_LANGUAGES) -> dict:
    """Model from all rows with a text and a language (columns ``text``, ``lang``).

    Empty texts count towards the prior only.  Without rows the model has no
    language, and every text is undetermined.  More than ``max_languages``
    languages raise ValueError (the broadcast would have no bound)."""
    rows = labelled.select("text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    counts = (rows.mapInArrow(lambda it: _count(it, orders, bits), "lang string, bucket int, n long")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    dense = (counts.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("c"))
             .limit(max_languages + 1).toLocalIterator())
    langs, rows_of, prior = [], [], []
    for r in dense:
        if len(langs) == max_languages:
            raise ValueError(f"more than {max_languages} languages")
        row = np.zeros((1 << bits) + 1, np.int64)
        pairs = np.array([(b, n) for b, n in r["c"]], np.int64)
        row[pairs[:, 0]] = pairs[:, 1]          # bucket -1, the number of texts, is the last place
        langs.append(r["lang"])
        rows_of.append(row[:-1])
        prior.append(row[-1])
    order = np.argsort(np.array(langs)) if langs else []
    if not langs:
        return {"langs": [], "logp": np.zeros((1 << bits, 0), np.float32), "prior": np.zeros(0), "orders": orders, "bits": bits}
    c = np.array(rows_of, np.float64)[order] + smoothing
    p = np.array(prior, np.float64)[order]
    return {"langs": [langs[i] for i in order],
            "logp": np.ascontiguousarray(np.log(c / c.sum(axis=1, keepdims=True)).T.astype(np.float32)),
            "prior": np.log(p / p.sum()), "orders": orders, "bits": bits}


def score_texts(texts: pa.Array, model: dict) -> tuple[list[str], np.ndarray]:
    """Language and score of each text of an array (nulls allowed)."""
    n, langs = len(texts), model["langs"]
    letters = pc.match_substring_regex(strings(texts), r"\p{L}").to_numpy(zero_copy_only=False)
    if not langs or not n:
        return [UNDETERMINED] * n, np.zeros(n)
    grams, offsets = gram_buckets(strings(texts), model["orders"], model["bits"])
    total = np.zeros((n, len(langs)))
    for j in range(len(langs)):
        column = np.ascontiguousarray(model["logp"][:, j])
        for g in grams:
            total[:, j] += np.add.reduceat(column[g], offsets[:-1], dtype=np.float64)
    size = (np.diff(offsets) * len(grams))[:, None]
    best = (total + model["prior"]).argmax(axis=1)
    z = total / size * SHARPNESS
    z = np.exp(z - z.max(axis=1, keepdims=True))
    score = (z / z.sum(axis=1, keepdims=True))[np.arange(n), best]
    return [langs[b] if ok else UNDETERMINED for b, ok in zip(best, letters)], np.where(letters, score, 0.0)


def identify(docs: DataFrame, model: dict, keep: list[str] | None = None) -> DataFrame:
    """Struct ``row`` of the columns ``keep`` (default all) of each row, with
    ``lang_pred`` and ``score``.

    A null, empty or letterless text is ``und`` with score 0; ties go to the
    language first in alphabetical order; equal rows give equal rows."""
    keep = docs.columns if keep is None else keep
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col("text").alias("_text"))
    if "text" in keep:           # then the row has it already
        rows = rows.select("row")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            if "text" in keep:
                batch = pa.RecordBatch.from_arrays([batch.column(0), pc.struct_field(batch.column(0), "text")], names=["row", "_text"])
            for part in slices(batch, "_text"):
                lang, score = score_texts(part.column(1), shared.value)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                                 names=["row", "lang_pred", "score"])

    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, lang_pred string, score double")


def held_out():
    """True for documents that training must not see; false for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1).select("text", "lang")


def op6_language_id(docs: DataFrame) -> DataFrame:
    """Language of every document by a model of the documents that are not held out."""
    model = train(training_rows(docs))
    named = identify(docs.select("doc_id", held_out().alias("held_out"), "text"), model, ["doc_id", "held_out"])
    return named.select("row.doc_id", "row.held_out", "lang_pred", "score")
