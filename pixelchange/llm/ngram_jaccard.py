"""N-gram Jaccard join by chosen paths.

Documents with the same set of word shingles are one class.  A class is
sketched by ``COORDINATES`` minhash values; a sampled shared token of the
join is one of them with its place.  A run starts with all classes in one
bucket; a bucket that is larger than ``LEAF`` is split: the hash of its path
chooses coordinates (1 / similarity of them on average, one at least), and
the values there name the buckets below.  Whether two classes meet further
down depends on their similarity only, so the runs, repeated, find a pair
at the threshold with a known chance: their number follows from the target ``RECALL``.

Small buckets are compared by brute force: the sketches rule out what is far
from the threshold, then the whole shingle sets decide.  A pair that meets
in several buckets counts in the one of least number.  No pair leaves a
task: a bucket returns, for each class, its number of links and the least
class that it hangs together with, so a group of n near copies makes n rows
a bucket, not n squared.  A bucket of near copies that splitting does not make
smaller is split no further and stands once for all runs and paths that find it; it is
compared in blocks of ``BLOCK`` by ``BLOCK``.  Its rows are dealt once a block, its
comparisons (all pairs of different texts, of which none may be lost) grow with
the square of the group.

Sketches and texts are the wide columns, and few classes meet any other: before a join
that brings them, a bit map of the keys that are asked for (``_likely``) keeps the rest
from the shuffle.  Sketches are stored by byte, the low bytes of all coordinates first:
these alone rule out pairs.  The join that follows is the one that decides.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixelchange.llm.common import materialise, mix, slices, split_words, strings, window_hashes, word_hashes

SHINGLE = 5
TENTHS = 8                  # similarity of a link, in tenths: exact in integers
COORDINATES = 64
LEAF = 64
DEPTH = 4
RECALL = 0.99               # least chance that a pair at the threshold meets in some run
BLOCK = 1024
KEPT = 0.5                  # a bucket with this share of the one above it is dense
MARGIN = 0.25               # four standard errors of a sketch's estimate
PAIRS = 200_000             # pairs that a task compares at once
KEY_BITS = 16               # bits a key of ``_likely``: a row in sixteen of the others passes
MOST_BITS = 1 << 25         # bits of all keys (4 MiB); beyond, more of the others pass
MAP_BITS = 1 << 15          # bits of a row of them: what ``bitmap_construct_agg`` makes


def runs_for(recall: float, similarity: float = TENTHS / 10) -> int:
    """Runs after which a pair of that similarity has met with the chance ``recall``.

    Each level of a run chooses each coordinate with the chance 1 / (similarity
    COORDINATES), one at least, and the pair goes on where the chosen values agree;
    ``lost`` is the chance that it meets in no bucket of the last level."""
    p = 10 / TENTHS / COORDINATES
    lost = 0.0
    for _ in range(DEPTH + 1):
        parted = 1 - similarity * (1 - lost)          # one chosen coordinate leads nowhere
        none = (1 - p) ** COORDINATES
        lost = (1 - p + p * parted) ** COORDINATES - none + none * parted
    return max(1, math.ceil(math.log(1 - recall) / math.log(lost)))


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each text, sorted, and their offsets.

    A text of fewer than ``size`` words has one shingle of all its words."""
    words, at = split_words(texts)
    h, n = word_hashes(words), np.diff(at)
    text_of = np.repeat(np.arange(len(n)), n)
    grams = window_hashes(h, size)
    whole = np.flatnonzero(text_of[:len(grams)] == text_of[size - 1:]) if len(grams) else np.zeros(0, np.int64)
    few = np.flatnonzero((n > 0) & (n < size))
    extra = np.array([window_hashes(h[at[i]:at[i + 1]], int(n[i]), int(n[i]) + 100)[0] for i in few], np.uint64)
    of, value = np.concatenate([text_of[whole], few]), np.concatenate([grams[whole], extra])
    order = np.lexsort((value, of))
    of, value = of[order], value[order]
    new = np.concatenate([[True], (of[1:] != of[:-1]) | (value[1:] != value[:-1])]) if len(of) else np.zeros(0, bool)
    of, value = of[new], value[new]
    return value, np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(n)))])


def _salt(i) -> np.uint64:
    return np.uint64((0x9E3779B97F4A7C15 * (2 * int(i) + 1)) & 0xFFFFFFFFFFFFFFFF)


def sketches(value: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Minhash values (32 bits) of each set, one row a set; empty sets have zeros."""
    full = np.flatnonzero(np.diff(at))
    out = np.zeros((len(at) - 1, COORDINATES), np.uint32)
    if len(full):
        starts = at[full]
        with np.errstate(over="ignore"):
            for i in range(COORDINATES):
                x = (value ^ _salt(i)) * _salt(i + 1000)
                x ^= x >> np.uint64(32)
                x = (x * _salt(i + 2000)) >> np.uint64(32)
                out[full, i] = np.minimum.reduceat(x.astype(np.uint32), starts)
    return out


def _names(value: np.ndarray, at: np.ndarray) -> list:
    """Name of each set's class, a hash of the set; None for empty sets."""
    return [int(np.uint64(xxhash.xxh3_64_intdigest(value[a:b].tobytes())).astype(np.int64)) if b > a else None for a, b in zip(at, at[1:])]


def _sign(batches):
    for batch in batches:
        for part in slices(batch, "_text"):
            value, at = shingle_sets(strings(part.column(1)))
            rows = sketches(value, at)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(_names(value, at), pa.int64()), pa.array([r.tobytes() for r in _planes(rows)], pa.binary())],
                names=["doc_id", "rep", "sketch"])


def _planes(sketch: np.ndarray) -> np.ndarray:
    """Sketches by byte: the low bytes of all coordinates, then the next ones."""
    return np.ascontiguousarray(sketch).view(np.uint8).reshape(len(sketch), COORDINATES, 4).transpose(0, 2, 1).reshape(len(sketch), -1)


def _matrix(column, kind, width) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _sketches_of(column) -> np.ndarray:
    planes = _matrix(column, np.uint8, 4 * COORDINATES).reshape(-1, 4, COORDINATES)
    return np.ascontiguousarray(planes.transpose(0, 2, 1)).view(np.uint32).reshape(-1, COORDINATES)


def _children(path: np.ndarray, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets below each row's path: row number and new path."""
    with np.errstate(over="ignore"):
        draw = np.stack([mix(path ^ _salt(i)) for i in range(COORDINATES)], axis=1)
        chosen = draw < np.uint64(2 ** 64 // COORDINATES * 10 // TENTHS)
        chosen[np.arange(len(path)), draw.argmin(axis=1)] = True
        row, i = np.nonzero(chosen)
        new = mix(draw[row, i] ^ mix(sketch[row, i].astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)))
    return row, new


def _roots(batches):
    runs = runs_for(RECALL)
    for batch in batches:
        sketch = _sketches_of(batch.column(1))
        for run in range(runs):
            row, path = _children(np.full(len(sketch), mix(np.array([run + 1], np.uint64))[0]), sketch)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(path.view(np.int64))], names=["rep", "path"])


def _split(batches):
    for batch in batches:
        row, path = _children(batch.column(1).to_numpy().view(np.uint64), _sketches_of(batch.column(2)))
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(path.view(np.int64)), batch.column(3).take(pa.array(row))],
                                         names=["rep", "path", "above"])


def _likely(rows: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Rows whose ``column`` is among the ``keys`` (one column, not null, no rows twice), and
    few others: those whose hash has a bit of the keys' map, which is broadcast."""
    bits = min(MOST_BITS, max(MAP_BITS, 1 << (KEY_BITS * keys.count()).bit_length()))
    place = lambda c: F.pmod(F.xxhash64(c, F.lit(11)), F.lit(bits))
    part, bit = F.floor(F.col("_at") / MAP_BITS), F.col("_at") % MAP_BITS
    maps = (keys.select(place(F.col(keys.columns[0])).alias("_at")).groupBy(part.alias("_part"))
            .agg(F.bitmap_construct_agg(bit).alias("_map")))
    byte = F.conv(F.hex(F.expr(f"substring(_map, cast(_at % {MAP_BITS} div 8 as int) + 1, 1)")), 16, 10).cast("int")
    return (rows.withColumn("_at", place(F.col(column))).withColumn("_part", part).join(F.broadcast(maps), "_part")
            .where(byte.bitwiseAND(F.expr("shiftleft(1, cast(_at % 8 as int))")) > 0).select(*rows.columns))


def leaves(classes: DataFrame) -> DataFrame:
    """Buckets to compare, of all runs: ``rep``, ``path``, ``size`` (2 at least).

    Most are small.  A large bucket that keeps most of the bucket above it is
    dense: its classes are near copies of each other, which no further splitting
    parts.  All runs find such a group, on many paths; it is named by its least
    class instead, so that it is one bucket."""
    level = classes.select("rep", "sketch").mapInArrow(_roots, "rep long, path long").withColumn("above", F.lit(None).cast("long"))
    small, dense = [], []
    for depth in range(DEPTH + 1):
        level = materialise(level, "join-level")
        counts = (level.groupBy("path").agg(F.count(F.lit(1)).alias("size"), F.min("rep").alias("least"), F.first("above").alias("above"))
                  .where("size > 1")
                  .select("path", "size", "least", F.coalesce(F.col("size") >= KEPT * F.col("above"), F.lit(False)).alias("kept")))
        sized = materialise(level.drop("above").join(counts, "path"), "join-buckets")
        large = (F.col("size") > LEAF) & F.lit(depth < DEPTH)
        small.append(sized.where((F.col("size") <= LEAF) | (~large & ~F.col("kept"))).select("rep", "path"))
        dense.append(sized.where((F.col("size") > LEAF) & F.col("kept")).select("rep", F.col("least").alias("path")))
        split = sized.where(large & ~F.col("kept"))
        if depth == DEPTH or split.isEmpty():
            break
        drawn = _likely(classes.select("rep", "sketch"), "rep", split.select("rep").distinct())
        level = (split.select("rep", "path", "size").join(drawn, "rep")
                 .select("rep", "path", "sketch", "size").mapInArrow(_split, "rep long, path long, above long"))
    out = small[0]
    for more in small[1:] + dense:
        out = out.unionByName(more)
    out = out.dropDuplicates(["rep", "path"])
    return out.join(out.groupBy("path").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "path")


def _blocks(rows: DataFrame) -> DataFrame:
    """Rows dealt to comparisons: ``a``, ``b`` (blocks of the bucket) and ``side``.

    A bucket of at most BLOCK classes is one comparison; a larger one is cut
    into blocks by a hash, each of which meets each."""
    n = F.ceil(F.col("size") / F.lit(float(BLOCK))).cast("int")
    own = F.pmod(F.xxhash64("rep", F.lit(7)), F.col("_n")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("_other")
    return (rows.withColumn("_n", n).withColumn("_own", own).select("*", other)
            .withColumn("a", F.least("_own", "_other")).withColumn("b", F.greatest("_own", "_other"))
            .withColumn("side", F.when(F.col("_own") == F.col("_other"), F.lit(0)).when(F.col("_own") < F.col("_other"), F.lit(1)).otherwise(F.lit(2)))
            .drop("_n", "_own", "_other"))


def _buckets(batches):
    """Tables of whole buckets out of batches sorted by path, a, b."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table]).combine_chunks()
        if not table.num_rows:
            continue
        key = [table.column(c).to_numpy() for c in ("path", "a", "b")]
        new = np.flatnonzero(np.concatenate([[True], np.any([k[1:] != k[:-1] for k in key], axis=0)]))
        for x, y in zip(new, new[1:]):
            yield table.slice(x, y - x)
        held = table.slice(new[-1])
    if held is not None and held.num_rows:
        yield held


def _pairs(side: np.ndarray, cross: bool):
    """Pairs of a comparison, some at a time: across two blocks, or i < j in one."""
    first, second = np.flatnonzero(side < 2), np.flatnonzero(side == 2)
    if not cross and len(side) <= 600:
        yield np.triu_indices(len(side), 1)
    elif not cross:
        for x in range(len(side) - 1):
            yield np.full(len(side) - x - 1, x), np.arange(x + 1, len(side))
    elif len(second):
        step = max(1, PAIRS // len(second))
        for x in range(0, len(first), step):
            block = first[x:x + step]
            yield np.repeat(block, len(second)), np.tile(second, len(block))


def _met_before(paths: list, here: int) -> np.ndarray | None:
    """For each class bits of the buckets of lesser number that it shares with others."""
    n = len(paths)
    flat = np.concatenate(paths)
    of = np.repeat(np.arange(n), [len(p) for p in paths])
    less = flat < here
    flat, of = flat[less], of[less]
    _, name, count = np.unique(flat, return_inverse=True, return_counts=True) if len(flat) else (None, np.zeros(0, np.int64), np.zeros(0, np.int64))
    shared = count > 1
    if not shared.any():
        return None
    number = np.cumsum(shared) - 1
    use = shared[name]
    bit, of = number[name[use]], of[use]
    out = np.zeros((n, int(shared.sum() + 63) // 64), np.uint64)
    np.bitwise_or.at(out, (of, bit // 64), np.uint64(1) << (bit % 64).astype(np.uint64))
    return out


def _first_meeting(met, i, j) -> np.ndarray:
    return np.ones(len(i), bool) if met is None else ~(met[i] & met[j]).any(axis=1)


def _plausible(batches):
    """Classes of each bucket that may have a link which counts here."""
    least = (TENTHS / 10 - MARGIN) * COORDINATES
    for t in _buckets(batches):
        n = t.num_rows
        if n < 2:
            continue
        sketch = _matrix(t.column("low"), np.uint8, COORDINATES)
        met = _met_before([np.asarray(p.values) for p in t.column("paths")], t.column("path")[0].as_py())
        wanted = np.zeros(n, bool)
        for i, j in _pairs(t.column("side").to_numpy(), t.column("a")[0] != t.column("b")[0]):
            near = (sketch[i] == sketch[j]).sum(axis=1) >= least
            i, j = i[near], j[near]
            ok = _first_meeting(met, i, j)
            wanted[i[ok]] = True
            wanted[j[ok]] = True
        if wanted.any():
            yield t.filter(pa.array(wanted)).select(["rep", "path", "a", "b", "side", "first_doc", "n_docs", "paths"]).combine_chunks().to_batches()[0]


def _shared_counts(values: np.ndarray, at: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of some sets with others, as a matrix."""
    n = len(at) - 1
    of = np.repeat(np.arange(n), np.diff(at))
    _, name, count = np.unique(values, return_inverse=True, return_counts=True)
    use = count[name] > 1
    code = np.cumsum(count > 1)[name[use]] - 1
    of = of[use]
    total, width = int((count > 1).sum()), 8192
    out = np.zeros((len(rows), len(columns)), np.float32)
    order = np.argsort(code, kind="stable")
    code, of = code[order], of[order]
    for a in range(0, total, width):
        lo, hi = np.searchsorted(code, [a, a + width])
        part = np.zeros((n, min(width, total - a)), np.float32)
        part[of[lo:hi], code[lo:hi] - a] = 1
        out += part[rows] @ part[columns].T
    return out


def _compare(batches):
    """Links of each class of a bucket and the least class that it hangs together with."""
    for t in _buckets(batches):
        values, at = shingle_sets(strings(t.column("text")))
        # An id may have several rows: of the class's own text one is taken.
        seen, own = set(), []
        for k, (name, rep) in enumerate(zip(_names(values, at), t.column("rep").to_pylist())):
            if name == rep and rep not in seen:
                seen.add(rep)
                own.append(k)
        n = len(own)
        if n < 2:
            continue
        own = np.array(own)
        if n < t.num_rows:
            t = t.take(pa.array(own)).combine_chunks()
            values = np.concatenate([values[at[k]:at[k + 1]] for k in own])
            at = np.concatenate([[0], np.cumsum(np.diff(at)[own])])
        rep, docs = t.column("rep").to_numpy(), t.column("n_docs").to_numpy()
        size, side = np.diff(at), t.column("side").to_numpy()
        cross = t.column("a")[0] != t.column("b")[0]
        rows, columns = (np.flatnonzero(side < 2), np.flatnonzero(side == 2)) if cross else (np.arange(n), np.arange(n))
        order = np.argsort(rep, kind="stable")
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n)
        met = _met_before([np.asarray(p.values) for p in t.column("paths")], t.column("path")[0].as_py())
        links, found = np.zeros(n), [(np.zeros(0, np.int64),) * 2]
        for x in range(0, len(rows), 512):
            block = rows[x:x + 512]
            both = _shared_counts(values, at, block, columns).astype(np.int64)
            i, j = np.nonzero(10 * both >= TENTHS * (size[block][:, None] + size[columns][None, :] - both))
            i, j = block[i], columns[j]
            if not cross:
                i, j = i[i < j], j[i < j]
            ok = _first_meeting(met, i, j)
            links += np.bincount(i[ok], docs[j[ok]], n) + np.bincount(j[ok], docs[i[ok]], n)
            found.append((i, j))
        i, j = (np.concatenate(x) for x in zip(*found))
        label = rank.copy()
        while True:        # least label over links until nothing moves
            before = label.copy()
            low = np.minimum(label[i], label[j])
            np.minimum.at(label, i, low)
            np.minimum.at(label, j, low)
            label = np.minimum(label, label[order[label]])
            if (label == before).all():
                break
        hit = (links > 0) | (label != rank)
        if hit.any():
            yield pa.RecordBatch.from_arrays([pa.array(rep[hit]), pa.array(rep[order[label]][hit]), pa.array(links[hit].astype(np.int64))],
                                             names=["rep", "root", "links"])


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node`` and the least node (``label``) of its component, for undirected
    edges ``a``, ``b``; labels spread to neighbours and jump along labels."""
    both = materialise(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), name)
    labels = materialise(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")), name)
    while True:
        near = (both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("m")))
        step = (labels.join(near, labels.node == near.a).select("node", F.col("label").alias("old"), F.least("label", "m").alias("label")))
        # Roots that are nodes themselves pass on where they point.
        up = step.select(F.col("node").alias("_root"), F.col("label").alias("_up"))
        step = materialise(step.join(up, step.label == up._root, "left")
                           .select("node", "old", F.least("label", F.coalesce("_up", "label")).alias("label")), name)
        labels = step.select("node", "label")
        if step.where("label <> old").isEmpty():
            return labels


def wanted_texts(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``first_doc`` and ``text`` of the documents to compare, and few others."""
    bodies = texts.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("first_doc"), F.col("_text").alias("text"))
    return _likely(bodies, "first_doc", wanted.select("first_doc").distinct())


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``class_id`` and ``n_links`` of each row.

    Linked are rows whose sets of five-word shingles have a Jaccard similarity
    of 0.8 or more; ``n_links`` counts the other rows that a row is linked
    with, ``class_id`` is the least doc_id that it hangs together with over
    links.  Words are ``[^\\x20\\x09-\\x0D]+``.  Null and wordless texts and rows
    without id are linked to nothing and are their own class.  Repeated rows
    are copies of each other."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("_text"))
    signed = materialise(texts.mapInArrow(_sign, "doc_id long, rep long, sketch binary"), "join-sketches")
    classes = materialise(signed.where("doc_id IS NOT NULL AND rep IS NOT NULL").groupBy("rep").agg(
        F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("n_docs"), F.first("sketch").alias("sketch")), "join-classes")
    small = materialise(leaves(classes), "join-leaves")
    paths = materialise(small.groupBy("rep").agg(F.sort_array(F.collect_list("path")).alias("paths")), "join-paths")     # a few a run
    low = classes.select("rep", "first_doc", "n_docs", F.substring("sketch", 1, COORDINATES).alias("low"))
    facts = paths.join(_likely(low, "rep", paths.select("rep")), "rep")
    dealt = _blocks(small).join(facts, "rep").select("rep", "path", "a", "b", "side", "first_doc", "n_docs", "paths", "low")
    order = ["path", "a", "b"]
    wanted = materialise(dealt.repartition(*order).sortWithinPartitions(*order).mapInArrow(
        _plausible, "rep long, path long, a int, b int, side int, first_doc long, n_docs long, paths array<long>"), "join-plausible")
    brought = wanted.join(wanted_texts(texts, wanted), "first_doc").select(*wanted.columns, "text")
    found = materialise(brought.repartition(*order).sortWithinPartitions(*order).mapInArrow(_compare, "rep long, root long, links long"), "join-links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    labels = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")), "join-components").withColumnRenamed("node", "rep")
    grouped = (classes.select("rep", "first_doc", "n_docs").join(labels, "rep", "left").join(links, "rep", "left")
               .select("rep", "first_doc", F.coalesce("label", "rep").alias("label"), (F.coalesce("links", F.lit(0)) + F.col("n_docs") - 1).alias("_links")))
    least = grouped.groupBy("label").agg(F.min("first_doc").alias("_class"))
    out = grouped.join(least, "label").select("rep", "_class", "_links")
    return (signed.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("rep")).alias("rep")).join(out, "rep", "left")
            .select("doc_id", F.coalesce("_class", "doc_id").alias("class_id"), F.coalesce("_links", F.lit(0)).cast("long").alias("n_links")))


def op1_ngram_jaccard(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs)


def links_sql() -> str:
    """DuckDB SQL over all pairs that share a shingle; components by reachability."""
    return rf"""
    WITH RECURSIVE docs AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    grams AS (SELECT DISTINCT row, unnest([array_to_string(w[i:i + {SHINGLE - 1}], ' ') FOR i IN range(1, greatest(len(w) - {SHINGLE - 1}, 1) + 1)]) AS gram
              FROM docs WHERE len(w) > 0 AND doc_id IS NOT NULL),
    sizes AS (SELECT row, count(*) AS n FROM grams GROUP BY row),
    shared AS MATERIALIZED (SELECT a.row AS a, b.row AS b, count(*) AS common FROM grams a JOIN grams b ON a.gram = b.gram AND a.row <> b.row GROUP BY ALL),
    links AS MATERIALIZED (SELECT a, b FROM shared JOIN sizes x ON x.row = a JOIN sizes y ON y.row = b WHERE 10 * common >= {TENTHS} * (x.n + y.n - common)),
    reach(a, b) AS (SELECT row, row FROM docs UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
    least AS (SELECT r.a AS row, min(d.doc_id) AS class_id FROM reach r JOIN docs d ON d.row = r.b GROUP BY r.a),
    counts AS (SELECT a AS row, count(*) AS n_links FROM links GROUP BY a)
    SELECT doc_id, class_id, coalesce(n_links, 0) AS n_links FROM docs JOIN least USING (row) LEFT JOIN counts USING (row)"""
