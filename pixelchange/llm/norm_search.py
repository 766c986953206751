"""Exact top-k search by inner product: norm-bucketed retrieval (op11).

Candidates are ordered by length (Euclidean norm), longest first, and cut into
buckets.  A query with k-th best score ``theta`` so far needs from a bucket whose
longest vector has length ``l`` a cosine of at least theta / (|q| l): its local
threshold.  Above 1 the bucket is skipped.  Else the bucket's candidates are pruned

* by LENGTH: only the leading candidates with |c| >= theta / |q| can do; these are
  multiplied in blocks, or
* by COORDinate: a unit vector that has the threshold's cosine with the query has each
  coordinate in a known range around the query's; candidates outside of the ranges of
  the query's largest coordinates are left out, found in sorted coordinate lists.

Which of the two serves a query is chosen per bucket: the candidates that either would
leave are counted, and the bucket's cosine threshold is put where the sum of the costs
is least; queries above it go by coordinate.  Whatever is left is verified by exact
products, and theta rises from bucket to bucket.

Spark deals the work: candidates are range partitioned by length into parts, queries
(in slabs of bounded bytes) go to each part that the seeds' thresholds leave them, and a
task holds one slab and streams one part past it, bucket by bucket.  So neither side
is ever whole in a task or the driver; no pair of rows is a row of a plan.  A task
returns k rows a query, which are ranked by query.  Products are exact: they are taken
in float64 while |q||c| stays below 2^53, else in 64-bit integers.

Defined results: vectors that are null or hold null or non-finite components take no
part, neither do pairs of different dimensions.  All rows with the query's vec_id are
its own and no candidates; of several vectors of one id the least one (by bytes) asks.
Other repeated rows repeat in the result.  A null vec_id is a candidate (last among
equal scores), never a query.  A component whose whole-number value leaves 32 bits, or a
product that leaves 64 bits, raises OverflowError.  Empty tables give an empty result.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pixelchange.llm.common import materialise

TOP, SCALE = 5, 256
QUERY_STEP = 50
# Candidates of a bucket; queries of one product.
BUCKET, ROWS = 2048, 512
# Bytes of a part's candidates and of a slab's queries.
PART_BYTES, SLAB_BYTES = 64 << 20, 8 << 20
# Longest vectors that give the first thresholds.
SEEDS = 1024
# Coordinates looked at, the least local threshold at which they are, and the cost of a
# candidate found that way against one in a block product.
FOCUS, COORD_FROM, COORD_COST = 4, 0.6, 24.0
EXACT = 2.0 ** 53
NO_ID = np.iinfo(np.int64).max
SLACK = 1e-9
VECTOR_SCHEMA = "vec_id long, dim int, norm double, v binary"


def quantise(scale: int):
    """(vec_id, embedding) -> whole-number vectors with their length."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(1)
            size = rows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            x = rows.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
            at = np.concatenate([[0], np.cumsum(size)])
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
            good = rows.is_valid().to_numpy(zero_copy_only=False) & (bad[at[1:]] == bad[at[:-1]])
            whole = np.floor(scale * np.where(np.isfinite(x), x, 0))
            if len(whole) and np.abs(whole).max() >= 2 ** 31:
                raise OverflowError("a component leaves 32 bits")
            # a running total would round: each row's squares are summed on their own
            norm = np.array([np.sqrt(w @ w) for w in np.split(whole, at[1:-1])]) if len(rows) else np.zeros(0)
            ints = whole.astype("<i4")
            packed = pa.Array.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(at * 4), pa.py_buffer(ints)]).cast(pa.binary())
            out = pa.RecordBatch.from_arrays([batch.column(0), pa.array(size.astype(np.int32)), pa.array(norm), packed], names=["vec_id", "dim", "norm", "v"])
            yield out.filter(pa.array(good))
    return work


def matrix(column, dim: int) -> np.ndarray:
    """Packed vectors of one dimension as rows of float64."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(len(column), dim).astype(np.float64)


def products(q: np.ndarray, c: np.ndarray, bound: float) -> np.ndarray:
    """All inner products, exact; ``bound``: largest |q| times largest |c|."""
    if bound < EXACT:
        return (q @ c.T).astype(np.int64)
    if bound >= 2.0 ** 63:
        raise OverflowError("a product leaves 64 bits")
    return q.astype(np.int64) @ c.T.astype(np.int64)


def best(row: np.ndarray, score: np.ndarray, ident: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` best entries of each row: highest score, then least id."""
    order = np.lexsort((ident, -score, row))
    first = np.searchsorted(row[order], row[order])
    return order[np.arange(len(order)) - first < k]


class Slab:
    """Queries of one dimension and their best candidates so far."""

    def __init__(self, ids, vectors, norms, theta, k):
        self.ids, self.v, self.norm, self.k = ids, vectors, norms, k
        self.theta = theta                      # float, -inf: none yet
        self.kept = (np.zeros(0, np.int64),) * 3
        self.unit = vectors / np.where(norms > 0, norms, 1)[:, None]
        self.focus = np.argsort(-np.abs(self.unit), axis=1)[:, :FOCUS]

    def add(self, row, score, ident) -> None:
        row, score, ident = (np.concatenate([a, b]) for a, b in zip(self.kept, (row, score, ident)))
        at = best(row, score, ident, self.k)
        self.kept = row[at], score[at], ident[at]
        full = np.flatnonzero(np.bincount(self.kept[0], minlength=len(self.ids)) == self.k)
        low = np.full(len(self.ids), np.inf)
        np.minimum.at(low, self.kept[0], self.kept[1].astype(np.float64))
        self.theta[full] = np.maximum(self.theta[full], low[full])

    def bucket(self, ids, c, norms) -> dict[str, int]:
        """Search one bucket (longest first); returns how many pairs each way left."""
        longest = norms[0]
        reach = self.norm * longest
        alive = np.flatnonzero(self.theta <= reach * (1 + SLACK))
        if not len(alive):
            return {"length": 0, "coord": 0}
        with np.errstate(divide="ignore", invalid="ignore"):
            local = np.where(reach[alive] > 0, self.theta[alive] / reach[alive], -np.inf)
            need = np.where(self.norm[alive] > 0, self.theta[alive] / self.norm[alive], -np.inf) * (1 - SLACK)
        prefix = np.searchsorted(-norms, -need, side="right")
        by_coord = np.zeros(len(alive), bool)
        ranges: dict[int, tuple] = {}
        steep = np.flatnonzero(local >= COORD_FROM)
        if len(steep) and longest > 0:
            unit = c / np.where(norms > 0, norms, 1)[:, None]
            order = {int(f): np.argsort(unit[:, f], kind="stable") for f in np.unique(self.focus[alive[steep]])}
            left = np.empty(len(steep))
            for n, i in enumerate(steep):
                ranges[i] = self.narrowest(alive[i], min(local[i], 1.0), unit, order)
                left[n] = ranges[i][2] - ranges[i][1]
            # the bucket's threshold: queries from it on go by coordinate
            falling = np.argsort(-local[steep], kind="stable")
            gain = np.cumsum(prefix[steep][falling] - COORD_COST * left[falling])
            if gain.max() > 0:
                by_coord[steep[falling[:int(gain.argmax()) + 1]]] = True
        counts = {"length": int(prefix[~by_coord].sum()), "coord": 0}
        for i in np.flatnonzero(by_coord):
            q = alive[i]
            f, a, b, low, high = ranges[i]
            at = order[f][a:b]
            at = at[at < prefix[i]]
            x = unit[np.ix_(at, self.focus[q])]
            at = at[((x >= low) & (x <= high)).all(axis=1)]
            counts["coord"] += len(at)
            self.verify(np.array([q]), at, ids, c, longest)
        rest = np.flatnonzero(~by_coord)
        rest = rest[np.argsort(-prefix[rest], kind="stable")]
        for a in range(0, len(rest), ROWS):
            some = rest[a:a + ROWS]
            self.verify(alive[some], np.arange(prefix[some[0]]), ids, c, longest)
        return counts

    def narrowest(self, q: int, t: float, unit: np.ndarray, order: dict):
        """Of the query's focus coordinates the one whose range leaves fewest candidates:
        (coordinate, from, to in its sorted list, lower and upper ends of all ranges)."""
        x = np.clip(self.unit[q, self.focus[q]], -1, 1)
        wide = np.sqrt(max(0.0, 1 - t * t) * (1 - x * x))
        low = np.where(x <= -t, -1.0, x * t - wide) - SLACK
        high = np.where(x >= t, 1.0, x * t + wide) + SLACK
        found = None
        for f, lo, hi in zip(self.focus[q], low, high):
            ranked = unit[order[int(f)], f]
            a, b = int(np.searchsorted(ranked, lo)), int(np.searchsorted(ranked, hi, side="right"))
            if found is None or b - a < found[2] - found[1]:
                found = (int(f), a, b)
        return (*found, low, high)

    def verify(self, rows, at, ids, c, longest) -> None:
        """Exact products of some queries with some candidates of a bucket."""
        if not len(at):
            return
        score = products(self.v[rows], c[at], float(self.norm[rows].max()) * float(longest))
        who = ids[at]
        real = score.astype(np.float64)
        real[self.ids[rows][:, None] == who[None, :]] = -np.inf
        cut = self.theta[rows]
        if len(at) > self.k:
            cut = np.maximum(cut, np.partition(real, -self.k, axis=1)[:, -self.k])
        r, j = np.nonzero((real >= cut[:, None]) & (real > -np.inf))
        if len(r):
            self.add(rows[r], score[r, j], who[j])


def seed(vectors: dict, k: int):
    """Queries -> queries with the threshold that the longest vectors give."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            theta = np.full(batch.num_rows, -np.inf)
            for dim in np.unique(dims):
                if int(dim) not in vectors:
                    continue
                at = np.flatnonzero(dims == dim)
                part = batch.take(pa.array(at))
                ids, c, norms = vectors[int(dim)]
                norm = part.column(2).to_numpy()
                slab = Slab(part.column(0).to_numpy(), matrix(part.column(3), int(dim)), norm, np.full(len(at), -np.inf), k)
                slab.bucket(ids, c, norms)
                theta[at] = slab.theta
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(theta)], names=[*batch.schema.names, "theta"])
    return work


def retrieve(k: int):
    """Rows sorted by (slab, part): queries, then candidates from the longest on -> the
    best candidates of each query in that part."""
    names = ["query_id", "vec_id", "score"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, waiting, slabs, pending = None, [], None, []

        def open_slabs():
            rows = pa.Table.from_batches(waiting)
            dims = rows["dim"].to_numpy()
            made = {}
            for dim in np.unique(dims):
                part = rows.take(pa.array(np.flatnonzero(dims == dim)))
                made[int(dim)] = Slab(part["vec_id"].to_numpy(), matrix(part["v"], int(dim)), part["norm"].to_numpy(), part["theta"].to_numpy().copy(), k)
            return made

        def search(rows: pa.RecordBatch):
            dims = rows.column(rows.schema.get_field_index("dim")).to_numpy()
            for dim in np.unique(dims):
                if int(dim) in slabs:
                    part = rows.take(pa.array(np.flatnonzero(dims == dim)))
                    get = lambda n: part.column(part.schema.get_field_index(n))  # noqa: E731, B023
                    slabs[int(dim)].bucket(get("vec_id").fill_null(NO_ID).to_numpy(zero_copy_only=False), matrix(get("v"), int(dim)), get("norm").to_numpy())

        def results():
            for slab in (slabs or {}).values():
                row, score, ident = slab.kept
                if len(row):
                    yield pa.RecordBatch.from_arrays([pa.array(slab.ids[row]), pa.array(ident, mask=ident == NO_ID), pa.array(score)], names=names)

        def flush(least: int):
            nonlocal pending
            rows = pa.Table.from_batches(pending).combine_chunks().to_batches() if pending else []
            pending = []
            for r in rows:
                for a in range(0, r.num_rows, BUCKET):
                    part = r.slice(a, BUCKET)
                    if part.num_rows < least:
                        pending = [part]
                    else:
                        search(part)

        for batch in batches:
            get = lambda n: batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False)  # noqa: E731, B023
            key = np.stack([get("slab"), get("part"), get("candidate").astype(np.int64)])
            at = np.concatenate([[0], np.flatnonzero((np.diff(key) != 0).any(axis=0)) + 1, [batch.num_rows]]) if batch.num_rows else []
            for a, b in zip(at, at[1:]):
                here, rows = tuple(key[:2, a]), batch.slice(a, b - a)
                if here != cell:
                    if slabs:
                        flush(1)
                        yield from results()
                    cell, waiting, slabs, pending = here, [], None, []
                if not key[2, a]:
                    waiting.append(rows)
                elif waiting:
                    slabs = slabs or open_slabs()
                    pending.append(rows)
                    if sum(x.num_rows for x in pending) >= BUCKET:
                        flush(BUCKET)
        if slabs:
            flush(1)
            yield from results()
    return work


def search(embeddings: DataFrame, asks, k: int = TOP, scale: int = SCALE, column: str = "embedding",
           part_bytes: int = PART_BYTES, slab_bytes: int = SLAB_BYTES) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` best candidates of each query; ``asks``
    is the condition on vec_id that makes a row a query."""
    spark = embeddings.sparkSession
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).alias("embedding"))
    size = rows.agg(F.sum(F.when(F.col("embedding").isNotNull(), F.size("embedding")))).first()[0] or 0
    parts = max(-(-4 * size // part_bytes), spark.sparkContext.defaultParallelism)
    vectors = materialise(
        rows.mapInArrow(quantise(scale), VECTOR_SCHEMA)
        .repartitionByRange(parts, "dim", F.desc("norm"), "vec_id")
        .withColumn("part", F.spark_partition_id()), "norm-vectors")
    seeds = {}
    for r in vectors.orderBy(F.desc("norm"), "vec_id").limit(SEEDS).collect():
        seeds.setdefault(r["dim"], []).append(r)
    seeds = {d: (np.array([NO_ID if r["vec_id"] is None else r["vec_id"] for r in rs], np.int64),
                 np.frombuffer(b"".join(r["v"] for r in rs), "<i4").reshape(len(rs), d).astype(np.float64),
                 np.array([r["norm"] for r in rs])) for d, rs in seeds.items()}
    queries = (vectors.where(asks(F.col("vec_id"))).groupBy("vec_id").agg(F.min(F.struct("v", "dim", "norm")).alias("q"))
               .select("vec_id", "q.dim", "q.norm", "q.v").mapInArrow(seed(seeds, k), VECTOR_SCHEMA + ", theta double"))
    asked = vectors.where(asks(F.col("vec_id"))).agg(F.sum(F.octet_length("v"))).first()[0] or 0
    slabs = max(1, -(-asked // slab_bytes))
    need = F.when(F.col("norm") > 0, F.col("theta") / F.col("norm")).otherwise(F.lit(float("-inf")))
    queries = materialise(queries.withColumn("need", need).repartitionByRange(slabs, "need", "vec_id")
                          .withColumn("slab", F.spark_partition_id()), "norm-queries")
    lengths = vectors.groupBy("part").agg(F.max("norm").alias("longest"), F.min("dim").alias("from"), F.max("dim").alias("to"))
    sent = (queries.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).join(lengths, "part")
            .where((F.col("need") <= F.col("longest") * (1 + SLACK)) & F.col("dim").between(F.col("from"), F.col("to")))
            .select("slab", "part", F.lit(False).alias("candidate"), "vec_id", "dim", "norm", "v", "theta"))
    stored = vectors.withColumn("slab", F.explode(F.sequence(F.lit(0), F.lit(slabs - 1))) if slabs > 1 else F.lit(0))
    stored = stored.select("slab", "part", F.lit(True).alias("candidate"), "vec_id", "dim", "norm", "v", F.lit(None).cast("double").alias("theta"))
    found = (sent.unionByName(stored).repartition(2 * parts * slabs, "slab", "part")
             .sortWithinPartitions("slab", "part", "candidate", F.desc("norm"), "vec_id")
             .mapInArrow(retrieve(k), "query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def op11_norm_search(embeddings: DataFrame) -> DataFrame:
    return search(embeddings, lambda vec_id: vec_id % QUERY_STEP == 0)


def search_sql() -> str:
    """DuckDB SQL for the query's rows."""
    return f"""
    WITH whole AS (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v FROM embeddings
                   WHERE embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    asking AS (SELECT vec_id AS query_id, min(v) AS q FROM whole WHERE vec_id % {QUERY_STEP} = 0 GROUP BY vec_id),
    scored AS (SELECT query_id, vec_id, list_inner_product(q, v)::BIGINT AS score
               FROM asking, whole WHERE vec_id IS DISTINCT FROM query_id AND len(q) = len(v)),
    ranked AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id NULLS LAST)::INTEGER AS rank,
                      vec_id, score FROM scored)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {TOP}"""
