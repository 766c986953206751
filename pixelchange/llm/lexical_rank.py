"""Ranked lexical search by dense blocked matrix products (op13).

Every document is scored for every item: the sum of w(term) * impact(term, document)
over the item's terms.  Items are taken in tiles that share a compact vocabulary;
a tile of documents becomes a dense matrix of impacts over that vocabulary, and one
BLAS product in float64 scores all pairs of the two tiles.  All factors are whole
numbers; vocabulary tiles are cut so that no partial sum reaches 2^53, so the
products are exact, and sums of vocabulary tiles are kept as 64-bit integers.  Of
each tile only the ``k`` best documents of an item go on, ties by ascending doc_id.

Passes: the documents are tokenised once into a sparse table (term numbers and
frequencies of the vocabulary only), written to the shared folder; statistics and
scores are taken from it.  A task keeps k rows an item; these are reduced in two
steps, so no item's rows meet in one task unreduced.  Items whose texts together
exceed ``BLOCK_BYTES`` are worked in blocks of about that size, each with a table of
its own; the driver holds one block's vocabulary, never documents.

Defined results: an item is an item_id; the terms of all rows with that id count once
each (a null id is an id).  Each documents row is a document of its own: repeated rows
repeat in the result under ranks that follow each other; a null doc_id comes after all
others among equal scores.  Null or empty texts have no term.  Other columns are
ignored.  Empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pixelchange.llm.common import materialise, slices, split_words, strings, utf8_bytes

TOP = 10
# Item text of one block (bounds the vocabulary that tasks and driver hold).
BLOCK_BYTES = 4 << 20
# Items, terms and documents of a dense tile.
ITEMS, TERMS, DOCS = 32, 4096, 1024
EXACT = 2 ** 53
# A null id, after all others.
NO_ID = np.iinfo(np.int64).max
HIT_SCHEMA = "doc_id long, n long, terms binary, tfs binary"

# Bytes of terms: digits, letters (lower-cased) and all bytes of other characters; the rest separates.
BYTES = np.full(256, 0x20, np.uint8)
BYTES[0x30:0x3A] = np.arange(0x30, 0x3A)
BYTES[0x41:0x5B] = np.arange(0x61, 0x7B)
BYTES[0x61:0x7B] = np.arange(0x61, 0x7B)
BYTES[0x80:] = np.arange(0x80, 0x100)


def split_terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Terms of all texts, one after another, and the offsets of each text's terms."""
    data, at = utf8_bytes(texts)
    plain = pa.Array.from_buffers(pa.string(), len(texts), [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(BYTES[data])])
    return split_words(plain)


def item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item_id, text) -> (item_id, term), once for each row and term."""
    for batch in batches:
        for part in slices(batch, "text"):
            words, at = split_terms(strings(part.column(1)))
            owner = part.column(0).take(pa.array(np.repeat(np.arange(part.num_rows), np.diff(at))))
            pairs = pa.table([owner, words], names=["item_id", "term"]).group_by(["item_id", "term"]).aggregate([])
            yield from pairs.combine_chunks().to_batches()


def count_hits(vocabulary):
    """(doc_id, text) -> sparse rows: number of terms, and those of the vocabulary."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        size = len(known)
        for batch in batches:
            for part in slices(batch, "text"):
                words, at = split_terms(strings(part.column(1)))
                coded = words.dictionary_encode()
                term = pc.index_in(coded.dictionary, value_set=known).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
                term = term[coded.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0, np.int64)
                doc = np.repeat(np.arange(part.num_rows), np.diff(at))
                pair, tf = np.unique((doc * size + term)[term >= 0], return_counts=True)
                ends = np.searchsorted(pair, np.arange(part.num_rows + 1) * size) * 4
                packed = [pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(x.astype(np.int32))])
                          for x in (pair % max(size, 1), tf)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(at).astype(np.int64)), *packed], names=["doc_id", "n", "terms", "tfs"])
    return work


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Packed 32-bit numbers of all rows, and the rows' offsets."""
    data, at = utf8_bytes(column)
    return np.frombuffer(data.tobytes(), np.int32).astype(np.int64), at // 4


def statistics(size: int):
    """Sparse rows -> (term, documents that hold it); -1: documents with a term, -2: all terms."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, docs, terms = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            n = batch.column(1).to_numpy()
            docs, terms = docs + int((n > 0).sum()), terms + int(n.sum())
            held += np.bincount(flat(batch.column(2))[0], minlength=size)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-1, -2], at])), pa.array(np.concatenate([[docs, terms], held[at]]))], names=["term", "count"])
    return work


def best(row: np.ndarray, score: np.ndarray, ident: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` best entries of each row: highest score, then least id."""
    order = np.lexsort((ident, -score, row))
    first = np.searchsorted(row[order], row[order])
    return order[np.arange(len(order)) - first < k]


def scorer(tiles, docs: int, terms: int, size: int, k: int = TOP):
    """Sparse rows -> (item number, doc_id, score) of each task's best documents.
    ``tiles``: for each tile its item numbers, vocabulary and (item, term, weight)."""
    def score_tile(tile, lookup, doc, term, impact, count):
        items, vocabulary, (item, at, weight) = tile
        lookup[vocabulary] = np.arange(len(vocabulary))
        column = lookup[term]
        lookup[vocabulary] = -1
        here = column >= 0
        column, doc, impact = column[here], doc[here], impact[here]
        total = np.zeros((len(items), count), np.int64)
        # impacts are below 10^6: a vocabulary tile's sum stays below 2^53
        width = max(1, min(TERMS, EXACT // (10 ** 6 * max(1, int(weight.max())))))
        for a in range(0, len(vocabulary), width):
            w = np.zeros((len(items), min(width, len(vocabulary) - a)))
            mine = (at >= a) & (at < a + width)
            w[item[mine], at[mine] - a] = weight[mine]
            inside = (column >= a) & (column < a + width)
            d = np.zeros((w.shape[1], count))
            d[column[inside] - a, doc[inside]] = impact[inside]
            total += (w @ d).astype(np.int64)
        return total

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = sum(len(t[0]) for t in tiles.value)
        kept = (np.zeros(0, np.int64),) * 3
        least = np.ones(count, np.int64)          # scores below this can't be among the best
        lookup = np.full(size, -1, np.int64)

        def flush(found):
            nonlocal kept
            row, score, ident = (np.concatenate([a, *b]) for a, b in zip(kept, zip(*found)))
            at = best(row, score, ident, k)
            kept = row[at], score[at], ident[at]
            full = np.bincount(kept[0], minlength=count) == k
            low = np.full(count, NO_ID)
            np.minimum.at(low, kept[0], kept[1])
            least[full] = low[full]

        for batch in batches:
            ids = batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            n = batch.column(1).to_numpy(zero_copy_only=False)
            for a in range(0, batch.num_rows, DOCS):
                part = batch.slice(a, DOCS)
                term, at = flat(part.column(2))
                tf = flat(part.column(3))[0]
                doc = np.repeat(np.arange(part.num_rows), np.diff(at))
                length = 10 + (90 * n[a:a + DOCS] * docs) // max(terms, 1)
                impact = (10 ** 9 * tf) // (1000 * tf + 8 * length[doc])
                found = []
                for tile in tiles.value:
                    total = score_tile(tile, lookup, doc, term, impact, part.num_rows)
                    items, cut = tile[0], least[tile[0]]
                    if part.num_rows > k:
                        cut = np.maximum(cut, np.partition(total, -k, axis=1)[:, -k])
                    i, d = np.nonzero(total >= cut[:, None])
                    if len(i):
                        found.append((items[i], total[i, d], ids[a + d]))
                if found:
                    flush(found)
        if len(kept[0]):
            ident = pa.array(kept[2], mask=kept[2] == NO_ID)
            yield pa.RecordBatch.from_arrays([pa.array(kept[0]), ident, pa.array(kept[1])], names=["item", "doc_id", "score"])
    return work


def tiled(item: np.ndarray, term: np.ndarray, weight: np.ndarray, count: int):
    """Tiles of ``ITEMS`` items with their compact vocabulary."""
    out = []
    for a in range(0, count, ITEMS):
        mine = (item >= a) & (item < a + ITEMS)
        if mine.any():
            vocabulary, at = np.unique(term[mine], return_inverse=True)
            out.append((np.arange(a, min(a + ITEMS, count)), vocabulary, (item[mine] - a, at, weight[mine])))
    return out


def search_block(docs: DataFrame, pairs: list, schema, k: int) -> DataFrame:
    """Best documents of the items of one block; ``pairs``: (item_id, term) rows."""
    spark, sc = docs.sparkSession, docs.sparkSession.sparkContext
    words, term = np.unique(np.array([p["term"] for p in pairs], object), return_inverse=True)
    ids = {i: n for n, i in enumerate(dict.fromkeys(p["item_id"] for p in pairs))}
    item = np.array([ids[p["item_id"]] for p in pairs], np.int64)
    size = len(words)
    hits = materialise(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                       .mapInArrow(count_hits(sc.broadcast(pa.array(words, pa.string()))), HIT_SCHEMA), "lexical-hits")
    counts = {r["term"]: r["count"] for r in
              hits.mapInArrow(statistics(size), "term long, count long").groupBy("term").agg(F.sum("count").alias("count")).collect()}
    n_docs, n_terms = counts.get(-1, 0), counts.get(-2, 0)
    held = np.array([counts.get(t, 0) for t in range(size)], np.float64)
    weight = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * held + 1))).astype(np.int64)
    tiles = sc.broadcast(tiled(item, term, weight[term], len(ids)))
    found = hits.mapInArrow(scorer(tiles, n_docs, n_terms, size, k), "item long, doc_id long, score long")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    # k rows a task and item: first the best of some tasks, then of all
    some = found.withColumn("share", F.spark_partition_id() % 64)
    for keys in (["item", "share"], ["item"]):
        some = (some.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
                .where(F.col("rank") <= k))
    named = spark.createDataFrame([(n, i) for i, n in ids.items()], f"item long, item_id {schema}")
    return some.join(F.broadcast(named), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score of the ``k`` best documents of each item."""
    kind = items.schema["item_id"].dataType.simpleString()
    pairs = (items.select("item_id", "text").mapInArrow(item_terms, f"item_id {kind}, term string").distinct())
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block_bytes)
    out = None
    if blocks > 1:
        pairs = materialise(pairs.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks))), "lexical-items")
    for b in range(blocks):
        rows = (pairs.where(F.col("block") == b) if blocks > 1 else pairs).select("item_id", "term").collect()
        if rows:
            found = search_block(docs, rows, kind, k)
            out = found if out is None else out.unionByName(found)
    if out is None:
        return items.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return out


def op13_lexical_rank(docs: DataFrame, items: DataFrame) -> DataFrame:
    return search(docs, items)


def search_sql() -> str:
    """DuckDB SQL for the query's rows."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    terms = f"unnest(regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '{pattern}'))"
    return f"""
    WITH docs AS (SELECT row_number() OVER () AS row, doc_id, text FROM documents),
    words AS (SELECT row, doc_id, {terms} AS term FROM docs),
    lengths AS (SELECT row, doc_id, count(*) AS n FROM words GROUP BY ALL),
    totals AS (SELECT count(*) AS docs, coalesce(sum(n), 0)::BIGINT AS terms FROM lengths),
    wanted AS (SELECT DISTINCT item_id, {terms} AS term FROM benchmark),
    hits AS (SELECT row, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
    weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
                FROM hits, totals GROUP BY term, docs),
    impacts AS (SELECT row, doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms)) AS impact
                FROM hits JOIN lengths USING (row), totals),
    scores AS (SELECT item_id, row, doc_id, sum(w * impact)::BIGINT AS score
               FROM wanted JOIN weights USING (term) JOIN impacts USING (term) GROUP BY ALL),
    ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank,
                      doc_id, score FROM scores WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {TOP}"""
