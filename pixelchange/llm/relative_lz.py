"""Removal of repeated passages by relative Lempel-Ziv parsing.

Each document is parsed against all documents with smaller ids: a factor is
a stretch of words that is found there, of at least ``WINDOW`` words;
everything else is literal.

The reference index is cut into blocks.  A block is a run of consecutive
windows that share their minimizer (the least of the hashed ``SEED``-grams
inside a window); equal windows have equal minimizers, so a block need only
be held against the blocks filed under the same seed.  Tasks file blocks by
seed, merge those that meet inside a task, and send only the first document
of each window on.  Matched windows go back to their documents as runs with
the document that they come from; there they are put together to factors.
A factor ends where its source ends; the windows across such a boundary
belong to blocks of their own and are looked up like all others.

What a task holds is bounded by the bucket size, not by how often a passage
occurs: repeats inside a task are merged before the shuffle, and seeds that
very many different windows share (found on a hash sample, which steers
placement only, never results) are filed by window instead.
"""

from __future__ import annotations

import math
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixelchange.llm.common import mix, slices, split_words, strings, window_hashes, word_hashes

WINDOW = 13
SEED = 6
SLICE = 8 << 20             # text bytes that are merged before the shuffle
BUCKET_BYTES = 8 << 20      # text bytes whose blocks meet in one task
SAMPLE = 64                 # one document in so many sizes the buckets and finds hot seeds
HOT_SHARE = 4096            # a seed with this part of all blocks is hot: at most so many are

RUN = np.dtype([("doc", "<i8"), ("tag", "<i8"), ("ref", "<i8"), ("start", "<u4"), ("n", "<u4")])
LOW48 = np.uint64((1 << 48) - 1)
LOW40 = np.uint64((1 << 40) - 1)


def seeded_windows(texts: pa.Array, window: int, seed: int):
    """Windows of all texts: text number, first word, 64-bit hash, and the hash
    and place of the seed."""
    words, at = split_words(texts)
    h = word_hashes(words)
    n = len(h) - window + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),)
    text_of = np.repeat(np.arange(len(at) - 1), np.diff(at))
    seeds, whole = window_hashes(h, seed, 1), window_hashes(h, window, 2)
    least, place = seeds[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, window - seed + 1):
        here = seeds[j:j + n]
        less = here < least
        least = np.where(less, here, least)
        place[less] = j
    ok = np.flatnonzero(text_of[:n] == text_of[window - 1:])
    of = text_of[ok]
    return of, ok - at[of], whole[ok], least[ok], ok + place[ok]


def _runs(of: np.ndarray, start: np.ndarray, *same: np.ndarray) -> np.ndarray:
    """First places of runs: consecutive windows of one text that agree in ``same``."""
    new = np.concatenate([[True], (of[1:] != of[:-1]) | (start[1:] != start[:-1] + 1)]) if len(of) else np.zeros(0, bool)
    for x in same:
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def _first_document(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Least document of all that have the same key."""
    if not len(key):
        return doc
    order = np.argsort(key, kind="stable")
    k = key[order]
    starts = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    out = np.empty(len(key), doc.dtype)
    out[order] = np.repeat(np.minimum.reduceat(doc[order], starts), np.diff(np.append(starts, len(k))))
    return out


def _pack(docs, tags, of, seed, start, size, prints, r_of, r_start, r_n, r_ref) -> bytes:
    used, index = np.unique(np.concatenate([of, r_of]), return_inverse=True)
    index = index.astype("<u4")
    return b"".join([
        struct.pack("<4I", len(used), len(of), len(prints), len(r_of)),
        docs[used].astype("<i8").tobytes(), tags[used].astype("<u4").tobytes(),
        index.tobytes(), (seed & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes(), (seed >> np.uint64(32)).astype("<u2").tobytes(),
        start.astype("<u4").tobytes(), size.astype("<u1").tobytes(),
        (prints & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes(), (prints >> np.uint64(32)).astype("<u1").tobytes(),
        r_start.astype("<u4").tobytes(), r_n.astype("<u4").tobytes(), r_ref.astype("<i8").tobytes()])


def _unpack(raw: bytes):
    n_docs, n, n_prints, n_runs = struct.unpack_from("<4I", raw)
    at = 16

    def take(kind, count):
        nonlocal at
        out = np.frombuffer(raw, kind, count, at)
        at += out.nbytes
        return out

    docs, tags, index = take("<i8", n_docs), take("<u4", n_docs), take("<u4", n + n_runs)
    seed = take("<u4", n).astype(np.uint64) | (take("<u2", n).astype(np.uint64) << np.uint64(32))
    start, size = take("<u4", n), take("<u1", n)
    prints = take("<u4", n_prints).astype(np.uint64) | (take("<u1", n_prints).astype(np.uint64) << np.uint64(32))
    runs = take("<u4", n_runs), take("<u4", n_runs), take("<i8", n_runs)
    return docs, tags, index[:n], seed, start, size, prints, index[n:], *runs


def _file_blocks(batches, window, seed_words, buckets, hot):
    """Blocks of all documents, packed for each bucket."""
    hot_seeds = np.array(sorted(hot), np.uint64)
    for batch in batches:
        for part in slices(batch, "_text", SLICE):
            doc, tag = part.column(0).to_numpy(zero_copy_only=False), part.column(1).to_numpy(zero_copy_only=False)
            of, start, whole, seed, place = seeded_windows(strings(part.column(2)), window, seed_words)
            if not len(of):
                continue
            first = _first_document(whole, doc[of])
            known = doc[of] > first         # found in a smaller document of this slice
            k_of, k_start, k_ref = of[known], start[known], first[known]
            k_at = _runs(k_of, k_start, k_ref)
            k_n = np.diff(np.append(k_at, len(k_of)))
            of, start, whole, seed, place = (x[~known] for x in (of, start, whole, seed, place))
            short = seed & LOW48
            by_window = np.isin(short, hot_seeds) if len(hot_seeds) else np.zeros(len(short), bool)
            alone = np.where(by_window, np.arange(len(of)), -1)
            at = _runs(of, start, place, alone)
            size = np.diff(np.append(at, len(of)))
            placed = np.where(by_window, mix(whole), seed)[at]
            bucket = ((placed >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
            prints = (mix(whole ^ np.uint64(0x5851F42D4C957F2D)) & LOW40)
            k_bucket = (mix(doc[k_of[k_at]].astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
            order, k_order = np.argsort(bucket, kind="stable"), np.argsort(k_bucket, kind="stable")
            b_sorted, k_sorted = bucket[order], k_bucket[k_order]
            names, rows = np.unique(np.concatenate([b_sorted, k_sorted])), []
            for b in names:
                own = order[np.searchsorted(b_sorted, b):np.searchsorted(b_sorted, b, "right")]
                k_own = k_at[k_order[np.searchsorted(k_sorted, b):np.searchsorted(k_sorted, b, "right")]]
                k_size = k_n[np.searchsorted(k_at, k_own)]
                total = size[own]
                cells = np.repeat(at[own] - np.concatenate([[0], np.cumsum(total)[:-1]]) if len(own) else at[own], total) + np.arange(total.sum())
                rows.append(_pack(doc, tag, of[at[own]], short[at[own]], start[at[own]], total, prints[cells],
                                  k_of[k_own], k_start[k_own], k_size, k_ref[k_own]))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(rows, pa.binary())], names=["bucket", "blocks"])


def _match_blocks(table: pa.Table, homes: int) -> pa.Table:
    """Windows of a bucket that a smaller document has, as runs, packed for the
    ``homes`` parts that documents are dealt to."""
    parts = [_unpack(raw.as_py()) for raw in table.column("blocks")]
    doc = np.concatenate([p[0][p[2]] for p in parts])
    tag = np.concatenate([p[1][p[2]] for p in parts]).astype(np.int64)
    size = np.concatenate([p[5] for p in parts]).astype(np.int64)
    seed, start0, prints = (np.concatenate([p[i] for p in parts]) for i in (3, 4, 6))
    first = np.concatenate([[0], np.cumsum(size)[:-1]]) if len(size) else size
    with np.errstate(over="ignore"):
        key = mix(mix(np.repeat(seed, size)) ^ (prints * np.uint64(0x9E3779B97F4A7C15)))
    block = np.repeat(np.arange(len(size)), size)
    ref = _first_document(key, doc[block])
    hit = np.flatnonzero(doc[block] > ref)
    block, ref = block[hit], ref[hit]
    start = start0[block].astype(np.int64) + hit - first[block]
    d = np.concatenate([doc[block]] + [p[0][p[7]] for p in parts])
    t = np.concatenate([tag[block]] + [p[1][p[7]].astype(np.int64) for p in parts])
    s = np.concatenate([start] + [p[8].astype(np.int64) for p in parts])
    n = np.concatenate([np.ones(len(hit), np.int64)] + [p[9].astype(np.int64) for p in parts])
    r = np.concatenate([ref] + [p[10] for p in parts])
    home = d % homes
    order = np.lexsort((s, t, d, home))
    d, t, s, n, r, home = (x[order] for x in (d, t, s, n, r, home))
    if not len(d):
        return pa.table({"home": pa.array([], pa.int64()), "runs": pa.array([], pa.binary())})
    at = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (t[1:] != t[:-1]) | (r[1:] != r[:-1]) | (s[1:] != s[:-1] + n[:-1])]))
    runs = np.zeros(len(at), RUN)
    runs["doc"], runs["tag"], runs["ref"], runs["start"], runs["n"] = d[at], t[at], r[at], s[at], np.add.reduceat(n, at)
    home = home[at]
    cut = np.flatnonzero(np.concatenate([[True], home[1:] != home[:-1]]))
    packed = [runs[a:b].tobytes() for a, b in zip(cut, np.append(cut[1:], len(home)))]
    return pa.table({"home": pa.array(home[cut], pa.int64()), "runs": pa.array(packed, pa.binary())})


def factors(runs: np.ndarray, window: int = WINDOW) -> list[tuple[int, int, int]]:
    """Greedy parse: (first word, one past the last, source) of each factor, by place.

    A factor goes on while the next window comes from the same source."""
    out: list[list[int]] = []
    for start, n, ref in np.sort(runs, order=["start"])[["start", "n", "ref"]].tolist():
        if out and out[-1][2] == ref and start <= out[-1][1] - window + 1:
            out[-1][1] = max(out[-1][1], start + n + window - 1)
        else:
            out.append([start, start + n + window - 1, ref])
    return [tuple(x) for x in out]


def _runs_by_document(raw: list[bytes]) -> dict:
    """(doc, tag) -> runs, of all that came to a home."""
    if not raw:
        return {}
    runs = np.frombuffer(b"".join(raw), RUN)
    order = np.lexsort((runs["start"], runs["tag"], runs["doc"]))
    runs = runs[order]
    cut = np.flatnonzero(np.concatenate([[True], (runs["doc"][1:] != runs["doc"][:-1]) | (runs["tag"][1:] != runs["tag"][:-1])]))
    return {(int(runs["doc"][a]), int(runs["tag"][a])): runs[a:b] for a, b in zip(cut, np.append(cut[1:], len(runs)))}


def _apply_runs(batches, window):
    """Text rows with their repeated words taken out.  Rows come by home, its runs
    before its texts; a home has so many texts as a bucket has, and less runs."""
    home, raw, runs_of = None, [], None
    for batch in batches:
        homes, kinds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        cuts = np.flatnonzero(np.concatenate([[True], (homes[1:] != homes[:-1]) | (kinds[1:] != kinds[:-1])]))
        for a, b in zip(cuts, np.append(cuts[1:], len(homes))):
            if homes[a] != home:
                home, raw, runs_of = homes[a], [], None
            part = batch.slice(a, b - a)
            if kinds[a] == 0:
                raw.extend(part.column(4).to_pylist())
                continue
            if runs_of is None:
                runs_of, raw = _runs_by_document(raw), []
            yield from _apply_slice(part, runs_of, window)


def _apply_slice(batch, runs_of, window):
    keys = list(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()))
    bodies = pa.RecordBatch.from_arrays([batch.column(5), pc.struct_field(batch.column(5), "text")], names=["row", "text"])
    at = 0
    for part in slices(bodies, "text"):
        texts = strings(part.column(1))
        words, offsets = split_words(texts)
        edge = np.zeros(len(words) + 1, np.int32)
        count = []
        for j in range(part.num_rows):
            found = runs_of.get(keys[at + j])
            parse = [] if found is None else factors(found, window)
            count.append(len(parse))
            for a, b, _ in parse:
                edge[offsets[j] + a] += 1
                edge[offsets[j] + b] -= 1
        at += part.num_rows
        keep = np.cumsum(edge[:-1]) == 0
        left = np.concatenate([[0], np.cumsum(keep)])[offsets]
        kept = pc.binary_join(pa.ListArray.from_arrays(pa.array(left, pa.int32()), words.filter(pa.array(keep))), " ")
        n = np.diff(offsets)
        yield pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(n, pa.int64()), pa.array(n - np.diff(left), pa.int64()), pa.array(count, pa.int64()), kept.cast(pa.string())],
            names=["row", "n_words", "n_removed", "n_factors", "kept_text"])


def _plan(rows: DataFrame, window: int, seed: int) -> tuple[int, list[int]]:
    """Number of buckets and hot seeds, from a hash sample of the documents."""
    sample = rows.where(F.pmod(F.xxhash64("doc_id", "tag"), F.lit(SAMPLE)) == 0)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "_text", SLICE):
                of, start, _, seeds, place = seeded_windows(strings(part.column(2)), window, seed)
                found, n = np.unique((seeds & LOW48)[_runs(of, start, place)], return_counts=True)
                size = int(np.sum(pc.binary_length(strings(part.column(2))).to_numpy(zero_copy_only=False)))
                yield pa.RecordBatch.from_arrays([pa.array(np.append(found.astype(np.int64), -1), pa.int64()), pa.array(np.append(n, size), pa.int64())],
                                                 names=["seed", "n"])

    counts = sample.mapInArrow(run, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n"))
    total = counts.agg(F.sum(F.when(F.col("seed") < 0, F.col("n"))).alias("b"), F.sum(F.when(F.col("seed") >= 0, F.col("n"))).alias("k")).first()
    least = max(64, (total["k"] or 0) // HOT_SHARE)
    hot = [r["seed"] for r in counts.where((F.col("seed") >= 0) & (F.col("n") >= least)).orderBy(F.desc("n"), "seed").limit(HOT_SHARE).toLocalIterator()]
    return max(1, math.ceil(SAMPLE * (total["b"] or 0) / BUCKET_BYTES)), hot


def remove_repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """Each row of ``docs`` (as struct ``row``) with ``n_words``, ``n_removed``,
    ``n_factors`` and ``kept_text`` (kept words joined by blanks).

    Words are ``[^\\x20\\x09-\\x0D]+``.  A null or empty text has none, a text
    of fewer than ``window`` words keeps all.  A row without id is neither
    source nor copy.  Rows of one id don't copy each other; equal rows get
    equal results."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64("text").bitwiseAND(F.lit(0xFFFFFFFF)).alias("tag"),
                       F.col("text").alias("_text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    usable = rows.where("doc_id IS NOT NULL AND _text IS NOT NULL").select("doc_id", "tag", "_text")
    buckets, hot = _plan(usable, window, seed)
    filed = usable.mapInArrow(lambda it: _file_blocks(it, window, seed, buckets, hot), "bucket long, blocks binary")
    homes = max(64, 4 * buckets) + 1
    runs = filed.groupBy("bucket").applyInArrow(lambda t: _match_blocks(t, homes), "home long, runs binary")
    kind = rows.schema["row"].dataType
    # rows without id meet nothing; their texts spread them
    texts = rows.select(F.pmod(F.coalesce("doc_id", "tag", F.lit(0)), F.lit(homes)).cast("long").alias("home"), "doc_id", "tag", "row")
    none = lambda t: F.lit(None).cast(t)
    both = (runs.select("home", F.lit(0).alias("kind"), none("long").alias("doc_id"), none("long").alias("tag"), "runs", none(kind).alias("row"))
            .unionByName(texts.select("home", F.lit(1).alias("kind"), "doc_id", "tag", none("binary").alias("runs"), "row")))
    together = both.repartition("home").sortWithinPartitions("home", "kind")
    return together.mapInArrow(lambda it: _apply_runs(it, window),
                               f"row {kind.simpleString()}, n_words long, n_removed long, n_factors long, kept_text string")


def op3_substring_dedup(docs: DataFrame) -> DataFrame:
    out = remove_repeats(docs.select("doc_id", "text"))
    return out.select("row.doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def removal_sql(window: int = WINDOW) -> str:
    """The removal as DuckDB SQL, by joining all windows."""
    return f"""
    WITH w AS (SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
    g AS (SELECT doc_id, i, array_to_string(ws[i:i + {window - 1}], ' ') AS win
          FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {window - 2})) AS i FROM w)),
    f AS (SELECT win, min(doc_id) AS first FROM g GROUP BY 1),
    c AS (SELECT DISTINCT doc_id, unnest(range(i, i + {window})) AS p FROM g JOIN f USING (win) WHERE doc_id > first),
    k AS (SELECT doc_id, len(ws) AS n_words, word, p FROM (SELECT doc_id, ws, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w)),
    s AS (SELECT k.doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY k.p) AS kept
          FROM k LEFT JOIN c ON k.doc_id = c.doc_id AND k.p = c.p WHERE c.p IS NULL GROUP BY 1)
    SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n_kept, 0))::BIGINT AS n_removed,
           sha256(coalesce(kept, '')) AS kept_sha256
    FROM w LEFT JOIN s ON w.doc_id = s.doc_id"""
