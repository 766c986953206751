"""Quality rules: decision lists learned by sequential covering.

Each text is reduced to a few counts by one numpy pass inside the tasks.
From labelled counts the learner grows a conjunction of thresholds on one
part of the rows (FOIL gain), prunes it on the other, keeps it if it is
precise enough there, removes the rows it covers and goes on.  The list
becomes one ordered conditional Spark expression over the counts.

The learner works on a sample of labelled rows of at most ``SAMPLE_ROWS``
(a parameter); counting and judging cover every row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pixelchange.llm.common import per_text, slices, split_words, strings, utf8_bytes, word_codes

SAMPLE_ROWS = 20_000        # labelled rows that the learner sees at most
SYMBOLS = b"#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_distinct_words", "n_upper", "n_letters"]


def _distinct_per_text(text_of: np.ndarray, code: np.ndarray, n: int) -> np.ndarray:
    """Number of distinct codes of each text."""
    if not len(code):
        return np.zeros(n, np.int64)
    order = np.lexsort((code, text_of))
    t, c = text_of[order], code[order]
    new = np.concatenate([[True], (t[1:] != t[:-1]) | (c[1:] != c[:-1])])
    return np.bincount(t[new], minlength=n)


def _repeated_words(codes: np.ndarray, offsets: np.ndarray, size: int = 3) -> np.ndarray:
    """Words of each text inside windows of ``size`` words found twice or more in it."""
    n, lens = len(codes), np.diff(offsets)
    text_of = np.repeat(np.arange(len(lens)), lens)
    if n < size:
        return np.zeros(len(lens), np.int64)
    window = np.zeros(n - size + 1, np.int64)
    for j in range(size):        # the code of the window so far and of the next word, coded anew
        pair = window * (int(codes.max()) + 1) + codes[j:j + n - size + 1]
        window = pair if j < 1 else np.unique(pair, return_inverse=True)[1]
    whole = text_of[:n - size + 1] == text_of[size - 1:]
    at = np.flatnonzero(whole)
    order = at[np.lexsort((window[at], text_of[at]))]
    t, w = text_of[order], window[order]
    same = (t[1:] == t[:-1]) & (w[1:] == w[:-1])
    twice = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]
    covered = np.zeros(n, bool)
    for j in range(size):
        covered[twice + j] = True
    return per_text(covered, offsets)


def count_texts(texts: pa.Array) -> dict[str, np.ndarray]:
    """All ``COUNTS`` of each text of an array without nulls."""
    n = len(texts)
    words, offsets = split_words(texts)
    codes, _ = word_codes(words)
    data, at = utf8_bytes(texts)
    lut = np.zeros((4, 256), bool)
    lut[0] = True
    lut[0, [0x20, *range(0x09, 0x0E), *range(0x80, 0xC0)]] = False      # starts of characters of words
    lut[1, list(SYMBOLS)] = True
    lut[2, ord("A"):ord("Z") + 1] = True
    lut[3, [*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0xC0, 256)]] = True
    by_byte = [per_text(row[data], at) for row in lut]
    lists = pc.split_pattern(texts, "\n")
    line, distinct = word_codes(lists.flatten())
    line_at = lists.offsets.to_numpy().astype(np.int64)
    full = pc.match_substring_regex(distinct, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False)[line] if len(line) else np.zeros(0, bool)
    line_text = np.repeat(np.arange(n), np.diff(line_at))
    n_lines = np.bincount(line_text[full], minlength=n)
    return {"n_words": np.diff(offsets), "word_chars": by_byte[0], "n_symbols": by_byte[1],
            "n_dup_lines": n_lines - _distinct_per_text(line_text[full], line[full], n),
            "n_repeat_words": _repeated_words(codes, offsets), "n_lines": n_lines,
            "n_distinct_words": _distinct_per_text(np.repeat(np.arange(n), np.diff(offsets)), codes, n),
            "n_upper": by_byte[2], "n_letters": by_byte[3]}


def text_counts(docs: DataFrame, key: list[str]) -> DataFrame:
    """``key`` columns and the counts of each row's whole ``text`` (null: no words)."""
    kept = docs.select(*key, F.col("text").alias("_text"))

    def run(batches):
        for batch in batches:
            for part in slices(batch, "_text"):
                counts = count_texts(strings(part.column(len(key))))
                yield pa.RecordBatch.from_arrays([*part.columns[:len(key)], *(pa.array(counts[c], pa.int64()) for c in COUNTS)],
                                                 names=[*key, *COUNTS])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:len(key)]] + [f"{c} long" for c in COUNTS])
    return kept.mapInArrow(run, schema)


# Features as (name, numerator, denominator); a denominator of 0 gives 0.
FEATURES = [("words", "n_words", None), ("word_length", "word_chars", "n_words"), ("symbols", "n_symbols", "n_words"),
            ("dup_lines", "n_dup_lines", "n_lines"), ("repeats", "n_repeat_words", "n_words"),
            ("variety", "n_distinct_words", "n_words"), ("upper", "n_upper", "n_letters"), ("letters", "n_letters", "word_chars")]


def feature_columns() -> dict[str, Column]:
    return {name: F.col(a).cast("double") if b is None else F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
            for name, a, b in FEATURES}


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool                 # feature >= threshold, or feature < threshold
    threshold: float

    def holds(self, rows: dict[str, np.ndarray]) -> np.ndarray:
        x = rows[self.feature]
        return x >= self.threshold if self.above else x < self.threshold


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    verdict: bool

    def covers(self, rows: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(rows.values()))), bool)
        for c in self.conditions:
            out &= c.holds(rows)
        return out


def _best_condition(x: dict, bad: np.ndarray, cuts: int):
    """Threshold with the most FOIL gain for the bad rows."""
    p0, n0 = bad.sum(), (~bad).sum()
    before = np.log2(p0 / (p0 + n0))
    best = (1e-9, None)
    for name, values in x.items():
        order = np.argsort(values, kind="stable")
        v, b = values[order], bad[order]
        at = np.flatnonzero(np.diff(v) > 0) + 1
        if len(at) > cuts:
            at = at[np.linspace(0, len(at) - 1, cuts).astype(int)]
        below = np.concatenate([[0], np.cumsum(b)])[at]
        for above, p, n in ((False, below, at - below), (True, p0 - below, len(v) - at - (p0 - below))):
            gain = np.where(p > 0, p * (np.log2(np.maximum(p, 1) / np.maximum(p + n, 1)) - before), 0.0)
            if len(gain) and gain.max() > best[0]:
                i = int(gain.argmax())
                best = (float(gain[i]), Condition(name, above, float((v[at[i]] + v[at[i] - 1]) / 2)))
    return best[1]


def learn(rows: dict[str, np.ndarray], good: np.ndarray, fold: np.ndarray, min_precision: float = 0.8,
          min_covered: int = 5, max_conditions: int = 4, cuts: int = 256) -> list[Rule]:
    """Ordered rules that give a verdict of False; what no rule covers is kept.

    ``fold`` is True for rows that prune.  Learning stops with the first
    rule that isn't precise enough on them, or when no bad row is left."""
    rules: list[Rule] = []
    left = np.ones(len(good), bool)
    while True:
        grow, prune = left & ~fold, left & fold
        if (~good[grow]).sum() < min_covered or (~good[prune]).sum() == 0:
            return rules
        x, bad, conditions = {k: v[grow] for k, v in rows.items()}, ~good[grow], []
        while len(conditions) < max_conditions and bad.any() and not bad.all():
            c = _best_condition(x, bad, cuts)
            if c is None:
                break
            conditions.append(c)
            hit = c.holds(x)
            x, bad = {k: v[hit] for k, v in x.items()}, bad[hit]
        xp, bp = {k: v[prune] for k, v in rows.items()}, ~good[prune]

        def worth(cs):
            hit = Rule(tuple(cs), False).covers(xp)
            p, n = int(bp[hit].sum()), int((~bp[hit]).sum())
            return (p - n) / (p + n) if p + n else -1.0

        while len(conditions) > 1 and worth(conditions[:-1]) >= worth(conditions):
            conditions.pop()
        rule = Rule(tuple(conditions), False)
        hit = rule.covers(rows)
        sure = prune & hit
        if not conditions or sure.sum() == 0 or (~good[sure]).mean() < min_precision or (hit & left & ~good).sum() < min_covered:
            return rules
        rules.append(rule)
        left &= ~hit


def verdict(rules: list[Rule]) -> Column:
    """The list as one conditional expression over the counts."""
    features, out = feature_columns(), None
    for r in rules:
        test = F.lit(True)
        for c in r.conditions:
            test = test & (features[c.feature] >= c.threshold if c.above else features[c.feature] < c.threshold)
        out = F.when(test, F.lit(r.verdict)) if out is None else out.when(test, F.lit(r.verdict))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def learn_from(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, **how) -> list[Rule]:
    """Rules from labelled documents (``doc_id``, ``quality`` 0 or 1).

    The sample is the labelled ids with the least hashes; rows that fail the
    base rules, and labels or ids that are null, teach nothing.  Without
    labels of both kinds the list is empty."""
    ids = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    # At most sample_rows ids of two numbers each: small enough to broadcast.
    known = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    frame = (text_counts(known, ["doc_id", "quality"]).where(~base_failed())
             .select("doc_id", "quality", *(c.alias(n) for n, c in feature_columns().items()),
                     (F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(3)) == 0).alias("fold"))
             .orderBy(*["doc_id", "quality", *feature_columns()]).limit(sample_rows).toPandas())
    if frame.empty or frame.quality.nunique() < 2:
        return []
    return learn({n: frame[n].to_numpy(float) for n in feature_columns()}, frame.quality.to_numpy() > 0, frame.fold.to_numpy(bool), **how)


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """Counts and verdict of every row; null or empty texts fail the base rules,
    equal rows get equal verdicts, other columns are ignored."""
    return text_counts(docs, ["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), (~base_failed() & verdict(rules)).alias("kept"))


def op2_quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judge(docs, learn_from(docs, labels))
