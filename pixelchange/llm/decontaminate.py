"""Benchmark decontamination: rare n-gram seeds and Smith-Waterman alignment.

Test items are read in blocks of bounded size.  A first pass counts each
pair of adjacent words of a block's items in the whole corpus (added up in
the tasks; only one number a pair leaves them).  An alignment of score T has
at least T - 1 of its item's pairs, as a run of r matches has r - 1 and each
step from one run to the next costs 1.  So all pairs of an item but the T - 2
most common ones become seeds: whatever the edits are, a passage that the
alignment accepts has one.  The second pass joins the documents' pairs with
the broadcast seeds and aligns each item with all that an accepted passage
around a seed can reach; many alignments run at once in numpy.  No document
is shuffled.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pixelchange.llm.common import slices, split_words, strings, text_hashes, window_hashes

SEED = 2                    # words of an n-gram; the bound above is one for pairs
SPAN = 5                    # n-grams of which one at least is a seed
MIN_WORDS = 3               # of an item
MIN_SHARE = 0.5             # of an item's words, as alignment score
MIN_SCORE = 13              # or so many words in all, for long items
BLOCK_BYTES = 8 << 20       # of item texts that are broadcast at once
FILTER_BITS = 20
CELLS = 1 << 20             # of alignments that a task works on at once
STRETCH = 8                 # item lengths that are aligned in one piece


def plain_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text, without case and punctuation, and their offsets.

    Only the distinct stretches between blanks are folded; each gives some words."""
    raw, at = split_words(texts)
    coded = raw.dictionary_encode()
    words, begin = split_words(pc.replace_substring_regex(pc.utf8_lower(coded.dictionary), r"[^\p{L}\p{N}]+", " "))
    own, code = text_hashes(words), coded.indices.to_numpy()
    ends = np.concatenate([[0], np.cumsum(np.diff(begin)[code])])
    return own[np.arange(ends[-1]) + np.repeat(begin[code] - ends[:-1], np.diff(ends))], ends[at]


def least_score(size: np.ndarray, min_share: float, min_score: int) -> np.ndarray:
    """Score at which an alignment with an item of ``size`` words is a leak (2 at least)."""
    return np.maximum(2, np.minimum(np.ceil(min_share * size), min_score)).astype(np.int64)


class Items:
    """Index of a block of test items."""

    def __init__(self, rows: list[tuple]):
        self.ids = [r[0] for r in rows]
        self.words, self.at = plain_words(pa.array([r[1] for r in rows], pa.string()))
        n = np.diff(self.at)
        of = np.repeat(np.arange(len(n)), n)
        grams = window_hashes(self.words, SEED)
        ok = np.flatnonzero((of[:len(grams)] == of[SEED - 1:]) & (n[of[:len(grams)]] >= MIN_WORDS)) if len(grams) else np.zeros(0, np.int64)
        self.gram, self.item, self.place = grams[ok], of[ok], ok - self.at[of[ok]]
        self.use(np.ones(len(ok), bool))

    def use(self, chosen: np.ndarray) -> None:
        """Look for the chosen n-grams only."""
        gram, item, place = self.gram[chosen], self.item[chosen], self.place[chosen]
        order = np.argsort(gram, kind="stable")
        self.keys, first = np.unique(gram[order], return_index=True)
        self.first = np.append(first, len(gram))
        self.hit_item, self.hit_place = item[order], place[order]
        self.seen = np.zeros(1 << FILTER_BITS, bool)
        self.seen[(self.keys & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)] = True

    def find(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of n-grams that are looked for, and which they are."""
        at = np.flatnonzero(self.seen[(grams & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)])
        if not len(at) or not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        k = np.minimum(np.searchsorted(self.keys, grams[at]), len(self.keys) - 1)
        same = self.keys[k] == grams[at]
        return at[same], k[same]

    def choose(self, counts: np.ndarray, min_share: float = MIN_SHARE, min_score: int = MIN_SCORE) -> np.ndarray:
        """All n-grams of an item but the most common ones, of which an accepted alignment
        has others too, and the rarest one of each stretch of SPAN (the first of equals)."""
        chosen = np.zeros(len(self.gram), bool)
        cost = counts[np.searchsorted(self.keys, self.gram)] if len(self.keys) else np.zeros(0, np.int64)
        cuts = np.flatnonzero(np.concatenate([[True], self.item[1:] != self.item[:-1]])) if len(self.item) else np.zeros(0, np.int64)
        for a, b in zip(cuts, np.append(cuts[1:], len(self.item))):
            spare = int(least_score(np.array(b - a + SEED - 1), min_share, min_score)) - 2
            chosen[a + np.argsort(cost[a:b], kind="stable")[:b - a - spare]] = True
            for x in range(a, max(a + 1, b - SPAN + 1)):
                chosen[x + int(np.argmin(cost[x:min(x + SPAN, b)]))] = True
        return chosen


def _document_grams(texts: pa.Array):
    words, at = plain_words(texts)
    of = np.repeat(np.arange(len(at) - 1), np.diff(at))
    grams = window_hashes(words, SEED)
    ok = np.flatnonzero(of[:len(grams)] == of[SEED - 1:]) if len(grams) else np.zeros(0, np.int64)
    return words, at, of, grams[ok], ok


def _count(batches, items: Items):
    total = np.zeros(len(items.keys), np.int64)
    for batch in batches:
        for part in slices(batch, "_text"):
            grams = _document_grams(strings(part.column(0)))[3]
            total += np.bincount(items.find(grams)[1], minlength=len(total))
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["k", "n"])


def align(a: list[np.ndarray], b: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment score of each pair of word sequences (match 1, else -1)
    and where in the second it ends (one past)."""
    n, height, width = len(a), max(map(len, a)), max(map(len, b))
    rows = np.zeros((n, height), np.uint64)
    text = np.zeros((n, width), np.uint64)
    in_a, in_b = np.zeros((n, height), bool), np.zeros((n, width), bool)
    for i, (x, y) in enumerate(zip(a, b)):
        rows[i, :len(x)], in_a[i, :len(x)] = x, True
        text[i, :len(y)], in_b[i, :len(y)] = y, True
    slope = np.arange(width, dtype=np.int32)
    above = np.zeros((n, width + 1), np.int32)
    best, end = np.zeros(n, np.int32), np.zeros(n, np.int64)
    for r in range(height):
        score = np.where((text == rows[:, r:r + 1]) & in_b & in_a[:, r:r + 1], 1, -1)
        here = np.maximum(np.maximum(above[:, :-1] + score, above[:, 1:] - 1), 0)
        here = np.maximum.accumulate(here + slope, axis=1) - slope      # gaps along the row
        above[:, 1:] = here
        at = here.argmax(axis=1)
        top = here[np.arange(n), at]
        more = top > best
        best[more], end[more] = top[more], at[more] + 1
    return best, end


def _windows(texts: pa.Array, items: Items, least: np.ndarray):
    """Words of a slice of documents, where each begins, and the pieces to align:
    (document, item, first word, one past the last)."""
    words, at, of, grams, place = _document_grams(texts)
    hit, key = items.find(grams)
    n = items.first[key + 1] - items.first[key]
    cell = np.repeat(items.first[key] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    item, in_item = items.hit_item[cell], items.hit_place[cell]
    spot = np.repeat(place[hit], n)
    doc, start = of[spot], spot - in_item          # start: where the item would begin
    order = np.lexsort((start, item, doc))
    doc, item, start = doc[order], item[order], start[order]
    size = np.diff(items.at)[item]
    slack = np.maximum(8, size - least[item])      # no accepted alignment has more words put in
    low, high = np.maximum(start - slack, at[doc]), np.minimum(start + size + slack, at[doc + 1])
    first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (low[1:] > high[:-1])])[:len(doc)])
    last = np.append(first[1:], len(doc))[:len(first)] - 1
    doc, item, size, low, high = doc[first], item[first], size[first], low[first], high[last]
    # Pieces overlap by two item lengths; an accepted alignment is shorter than that.
    n = 1 + np.maximum(0, -((high - low - STRETCH * size) // -((STRETCH - 2) * size)))
    piece = np.repeat(np.arange(len(low)), n)
    low = low[piece] + (np.arange(len(piece)) - np.repeat(np.cumsum(n) - n, n)) * (STRETCH - 2) * size[piece]
    return words, at, doc[piece], item[piece], low, np.minimum(low + STRETCH * size[piece], high[piece])


def _passages(texts: pa.Array, items: Items, min_share: float, min_score: int):
    """Leaks in a slice of documents: (text number, item number, score, first word, one past the last).

    Of passages of one document that overlap and copy one item, the best stays."""
    least = least_score(np.diff(items.at), min_share, min_score)
    words, at, doc, item, low, high = _windows(texts, items, least)
    found = []
    while len(low):
        order, rest, x = np.argsort(high - low, kind="stable"), [], 0
        while x < len(order):
            y = x + 1
            while y < len(order) and (y + 1 - x) * (high - low)[order[y]] <= CELLS:
                y += 1
            group = order[x:y]
            a = [items.words[items.at[i]:items.at[i + 1]] for i in item[group]]
            b = [words[p:q] for p, q in zip(low[group], high[group])]
            score, end = align(a, b)
            good = np.flatnonzero(score >= least[item[group]])
            if len(good):
                # Read backwards from its end, the same alignment shows where it begins.
                back, length = align([a[g][::-1] for g in good], [b[g][:end[g]][::-1] for g in good])
                for g, s in zip(good, length):
                    c = group[g]
                    stop = int(low[c] + end[g])
                    found.append((int(doc[c]), int(item[c]), -int(score[g]), stop - int(s), stop))
                    # Left and right of it there may be others.
                    rest += [(doc[c], item[c], p, q) for p, q in ((low[c], stop - s), (stop, high[c])) if q - p >= least[item[c]]]
            x = y
        doc, item, low, high = np.array(rest, np.int64).reshape(-1, 4).T
    out, taken = [], {}
    for d, i, s, a, b in sorted(found):
        spans = taken.setdefault((d, i), [])
        k = bisect.bisect_left(spans, (a, b))
        if (k == 0 or spans[k - 1][1] <= a) and (k == len(spans) or spans[k][0] >= b):
            spans.insert(k, (a, b))
            out.append((d, i, -s / float(items.at[i + 1] - items.at[i]), int(a - at[d]), int(b - at[d])))
    return sorted(out)


LEAKS = "array<struct<item_id:bigint,score:double,first_word:int,end_word:int>>"


def _blocks(benchmark: DataFrame, text: str, block_bytes: int):
    """Items in blocks; only one block is on the driver at a time."""
    rows, size = [], 0
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col(text).alias("body")).where("body IS NOT NULL")
    for r in items.toLocalIterator():
        rows.append((r["item_id"], r["body"]))
        size += len(r["body"].encode())
        if size >= block_bytes:
            yield rows
            rows, size = [], 0
    if rows:
        yield rows


def find_leaks(docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None, text: str = "text",
               min_share: float = MIN_SHARE, min_score: int = MIN_SCORE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Each row of ``docs`` (struct ``row`` of the columns ``keep``, default all) with ``leaks``.

    A leak is a passage that aligns with an item: its score as a share of
    the item's words, and its place among the document's words (without
    punctuation).  A leak has a score of ``min_share`` or ``min_score`` words,
    and of 2 at least.  Null and empty texts have none; items that are null or
    have fewer than ``MIN_WORDS`` words are ignored; without items nothing leaks."""
    keep = docs.columns if keep is None else keep
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{text}`").alias("_text"),
                       F.lit(None).cast(LEAKS).alias("leaks"))
    kind = rows.schema["row"].dataType.simpleString()
    schema = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("first_word", pa.int32()), ("end_word", pa.int32())]))
    bodies = rows.select("_text")                  # counts are taken of the documents as they came
    for block in _blocks(benchmark, text, block_bytes):
        items = Items(block)
        counts = np.zeros(len(items.keys), np.int64)
        for r in (bodies.mapInArrow(lambda it, i=items: _count(it, i), "k long, n long")
                  .groupBy("k").agg(F.sum("n").alias("n")).toLocalIterator()):       # one number an n-gram of the block
            counts[r["k"]] = r["n"]
        items.use(items.choose(counts, min_share, min_score))
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches, shared=shared):
            found_in = shared.value
            for batch in batches:
                for part in slices(batch, "_text"):
                    leaks = [x or [] for x in part.column(2).to_pylist()]
                    for doc, item, score, a, b in _passages(strings(part.column(1)), found_in, min_share, min_score):
                        leaks[doc].append({"item_id": found_in.ids[item], "score": score, "first_word": a, "end_word": b})
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(leaks, schema)], names=["row", "_text", "leaks"])

        rows = rows.mapInArrow(run, f"row {kind}, _text string, leaks {LEAKS}")
    return rows.select("row", F.coalesce("leaks", F.array().cast(LEAKS)).alias("leaks"))


def leaked() -> Column:
    return F.size("leaks") > 0


def op4_decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each passage of a document that copies a test item."""
    return (find_leaks(docs, benchmark, ["doc_id"]).select("row.doc_id", F.explode("leaks").alias("leak"))
            .select("doc_id", "leak.item_id", "leak.score", "leak.first_word", "leak.end_word"))
