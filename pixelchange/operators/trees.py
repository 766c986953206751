"""A random forest as Spark jobs, for the classifier's pipeline (M2-M4).

Training keeps a byte a feature of each row.  A level of all trees is one job:
tasks count the classes by bin of the features drawn for each node, the counts
of a tree are summed over the tasks and give each node its best split, and the
driver gets the splits alone.  Every row is in the sample of every tree as often
as a Poisson draw of mean 1 from the row's key says, so a row's part in a tree
doesn't depend on how rows are dealt to tasks.

Functions for tasks are closures only, so that they are shipped by value.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasInputCols, HasLabelCol, HasRawPredictionCol, HasSeed
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import functions as F

# Rows whose arrays a task works on together (they fit a cache), and rows after which it
# gives away its counts and starts anew.
CHUNK_ROWS = 16_384
TASK_ROWS = 65_536
# Points by which a chunk describes a feature with more distinct values.
SKETCH_POINTS = 1_024
# Most values of a categorical feature: all ways to divide them are tried.
MOST_CATEGORIES = 10


# ---------------------------------------------------------------------------
# Functions of the tasks
# ---------------------------------------------------------------------------

def _matrix(width):
    """Array column of an Arrow batch -> matrix of doubles, null as NaN."""
    def matrix(col):
        values = col.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
        return values.reshape(-1, width)

    return matrix


def _gather(parse, rows):
    """Batches -> tuples of arrays of ``rows`` rows, the last one of fewer."""
    def gather(batches):
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(parse(batch))
                size += len(held[-1][0])
            while size >= rows:
                arrays = [np.concatenate(a) for a in zip(*held)]
                yield [a[:rows] for a in arrays]
                held, size = [[a[rows:] for a in arrays]], size - rows
        if size:
            yield [np.concatenate(a) for a in zip(*held)]

    return gather


def _sketch(width, skip):
    """Rows -> (feature, values, weights) of each chunk: the distinct values or, of more
    than ``SKETCH_POINTS``, points evenly spaced in rank.  Not finite values are left out."""
    matrix, points = _matrix(width), SKETCH_POINTS
    gather = _gather(lambda b: (matrix(b.column(0)),), TASK_ROWS)

    def run(batches):
        for (x,) in gather(batches):
            out = []
            for f in range(width):
                if f in skip:
                    continue
                v = np.sort(x[np.isfinite(x[:, f]), f])
                value, weight = np.unique(v, return_counts=True)
                if len(value) > points:
                    value = v[((np.arange(points) + 0.5) * len(v) / points).astype(np.int64)]
                    weight = np.full(points, len(v) / points)
                out.append((f, value.tobytes(), weight.astype(np.float64).tobytes()))
            if out:
                types = (pa.int32(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["feature", "value", "weight"])

    return run


def _thresholds(bins):
    """Sketches of whole features -> (feature, thresholds): between all values if there are
    at most ``bins``, else at the quantiles."""
    def between(value, weight):
        value, at = np.unique(value, return_inverse=True)
        if len(value) > bins:
            ranks = np.cumsum(np.bincount(at, weights=weight))
            cut = np.searchsorted(ranks, ranks[-1] * np.arange(1, bins) / bins)
            cut = np.unique(cut[cut < len(value) - 1])
        else:
            cut = np.arange(len(value) - 1)
        return value[cut] + (value[cut + 1] - value[cut]) / 2

    def run(batches):
        held = {}
        for batch in batches:
            for row in batch.to_pylist():
                held.setdefault(row["feature"], []).append((np.frombuffer(row["value"]), np.frombuffer(row["weight"])))
        for f, parts in held.items():
            t = between(*(np.concatenate(p) for p in zip(*parts)))
            yield pa.RecordBatch.from_arrays([pa.array([f], pa.int32()), pa.array([t.tolist()], pa.list_(pa.float64()))],
                                             names=["feature", "thresholds"])

    return run


def _binner(thresholds, bins):
    """Matrix of values -> matrix of bins: the number of thresholds below the value (NaN is
    above all), or the category itself."""
    def binner(x):
        out = np.empty(x.shape, np.uint8)
        for f, t in enumerate(thresholds):
            out[:, f] = np.clip(x[:, f], 0, bins - 1) if t is None else np.searchsorted(t, x[:, f])
        return out

    return binner


def _blocks(thresholds, bins):
    """Rows (values, class, key) -> blocks of bins, classes and keys as bytes."""
    matrix, binner = _matrix(len(thresholds)), _binner(thresholds, bins)
    gather = _gather(lambda b: (binner(matrix(b.column(0))), b.column(1).to_numpy(), b.column(2).to_numpy()), CHUNK_ROWS)

    def run(batches):
        for x, y, key in gather(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([a.tobytes()], pa.binary()) for a in (x, y.astype(np.int32), key.astype(np.int64))], names=["x", "y", "key"])

    return run


def _drawn(seed):
    """(keys, tree) -> how often each row is in the tree's sample."""
    terms, total, below = [], 0.0, math.exp(-1)
    for k in range(1, 13):
        total += below
        terms.append(np.uint32(min(round(total * 2.0 ** 32), 2 ** 32 - 1)))
        below /= k
    step, a, b = 0x9E3779B97F4A7C15, np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
    s30, s27, s32 = np.uint64(30), np.uint64(27), np.uint64(32)

    def drawn(key, tree):
        z = key + np.uint64((step * (tree + 1) + seed * 0xD1342543DE82EF95) % 2 ** 64)
        z ^= z >> s30
        z *= a
        z ^= z >> s27
        z *= b
        u = (z >> s32).astype(np.uint32)
        n = np.zeros(len(key), np.uint8)
        for t in terms:
            n += u >= t
        return n

    return drawn


def _descend(levels, bins):
    """(bins of all rows, where the wanted ones begin, tree) -> their nodes of the next level."""
    def descend(x, base, tree):
        node = np.zeros(len(base), np.int64)
        for feature, left in levels:
            code = x[base + feature[tree][node]]
            node = 2 * node + 1 - left[tree].ravel()[node * bins + code]
        return node

    return descend


def _count(levels, chosen, is_open, bins, classes, seed):
    """Blocks -> (tree, counts by node, chosen feature, bin and class) of the open nodes."""
    descend, drawn = _descend(levels, bins), _drawn(seed)
    trees, nodes, k = chosen.shape
    cells, chunk = nodes * k * bins * classes, CHUNK_ROWS
    slot = np.arange(k) * (bins * classes)

    def parse(batch):
        y, key = (np.concatenate([np.frombuffer(v.as_buffer(), d) for v in batch.column(c)])
                  for c, d in ((1, np.int32), (2, np.uint64)))
        x = np.concatenate([np.frombuffer(v.as_buffer(), np.uint8) for v in batch.column(0)])
        return x.reshape(len(y), -1), y, key

    gather = _gather(parse, TASK_ROWS)

    def add(total, x, width, y, key, tree):
        n = drawn(key, tree)
        row = np.flatnonzero(n)
        base = row * width
        node = descend(x, base, tree)
        if not is_open[tree].all():
            keep = is_open[tree][node]
            row, base, node = row[keep], base[keep], node[keep]
        code = x[base[:, None] + chosen[tree][node]].astype(np.int64)
        code *= classes
        code += slot
        code += (node * (k * bins * classes) + y[row])[:, None]
        total += np.bincount(code.ravel(), weights=np.repeat(n[row].astype(np.float64), k), minlength=cells)

    def run(batches):
        for x, y, key in gather(batches):
            width, parts = x.shape[1], range(0, len(y), chunk)
            parts = [(x[i:i + chunk].ravel(), width, y[i:i + chunk].astype(np.int64), key[i:i + chunk]) for i in parts]
            for tree in range(trees):
                if not is_open[tree].any():
                    continue
                total = np.zeros(cells)
                for part in parts:
                    add(total, *part, tree)
                yield pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), pa.array([total.astype(np.int32).tobytes()], pa.binary())],
                                                 names=["tree", "counts"])

    return run


def _divisions(arity):
    """All ways to divide categories in two, as rows of 0 and 1 (the last one is never left)."""
    return (np.arange(1, 2 ** (arity - 1))[:, None] >> np.arange(arity)) & 1


def _best(chosen, is_open, arity, cuts, bins, classes):
    """Counts -> (tree, feature, bins to the left, counts of the node and of its left side) by
    the Gini gain; feature -1 where no division gains.  Counts of a tree are added as they
    come: a task holds one set for each of its trees."""
    trees, nodes, k = chosen.shape
    shape = (nodes, k, bins, classes)
    ways = {a: _divisions(a) for a in set(arity) if a > 1}
    arity, cuts = np.array(arity), np.array(cuts)

    def score(left, total):
        """Sum of the squared counts over each side's size; without two sides -inf."""
        right = total - left
        nl, nr = left.sum(-1), right.sum(-1)
        with np.errstate(divide="ignore", invalid="ignore"):
            s = (left * left).sum(-1) / nl + (right * right).sum(-1) / nr
        return np.where((nl > 0) & (nr > 0), s, -np.inf)

    def best(tree, c):
        total = c[:, 0].sum(axis=1)
        feature = chosen[tree]
        at_cut = score(np.cumsum(c, axis=2), total[:, None, None])
        at_cut[np.arange(bins) >= cuts[feature][..., None]] = -np.inf
        cut = at_cut.argmax(-1)
        top = np.take_along_axis(at_cut, cut[..., None], -1)[..., 0]
        goes = np.arange(bins) <= cut[..., None]
        for a, w in ways.items():
            i, j = np.nonzero(arity[feature] == a)
            if len(i):
                s = score(np.einsum("wb,mbc->mwc", w, c[i, j, :a]), total[i][:, None])
                m = s.argmax(-1)
                top[i, j] = s[np.arange(len(i)), m]
                goes[i, j] = False
                goes[i, j, :a] = w[m] == 1
        n, j = np.arange(nodes), top.argmax(-1)
        size = total.sum(-1)
        none = (total * total).sum(-1) / np.maximum(size, 1)
        gains = is_open[tree] & (top[n, j] - none > 1e-9 * np.maximum(size, 1))
        left = goes[n, j] & gains[:, None]
        return np.where(gains, feature[n, j], -1), left, total, (c[n, j] * left[..., None]).sum(1)

    def run(batches):
        held = {}
        for batch in batches:
            for tree, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts = np.frombuffer(counts.as_buffer(), np.int32)
                held[tree] = held[tree] + counts if tree in held else counts.astype(np.int64)
        for tree, counts in held.items():
            feature, left, total, on_left = best(tree, counts.reshape(shape).astype(np.float64))
            out = [feature.astype(np.int64), left, total, on_left]
            yield pa.RecordBatch.from_arrays([pa.array([tree], pa.int32())] + [pa.array([a.tobytes()], pa.binary()) for a in out],
                                             names=["tree", "feature", "bins_left", "total", "on_left"])

    return run


def _votes(levels, votes, thresholds, bins):
    """Array column -> the trees' votes of each row, summed by class."""
    width, (trees, _, classes) = len(thresholds), votes.shape
    matrix, binner, descend, chunk = _matrix(width), _binner(thresholds, bins), _descend(levels, bins), CHUNK_ROWS

    def run(col: pa.Array) -> pa.Array:
        x = matrix(col)
        out = np.zeros((len(x), classes))
        for i in range(0, len(x), chunk):
            codes = binner(x[i:i + chunk])
            base = np.arange(len(codes)) * width
            codes = codes.ravel()
            for tree in range(trees):
                out[i:i + chunk] += votes[tree][descend(codes, base, tree)]
        offsets = pa.array(np.arange(len(x) + 1) * classes, pa.int32())
        return pa.ListArray.from_arrays(offsets, pa.array(out.ravel()))

    return run


# ---------------------------------------------------------------------------
# Estimator and model
# ---------------------------------------------------------------------------

class _ForestParams(HasFeaturesCol, HasLabelCol, HasInputCols, HasSeed, HasRawPredictionCol):
    numTrees = Param(Params._dummy(), "numTrees", "number of trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "levels of splits", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "most bins of a feature (at most 256)", TypeConverters.toInt)


class Forest(Estimator, _ForestParams):
    """Random forest by classes of an indexed label: Gini gain, the square root of the
    features (rounded up) drawn for each node, bins between quantiles of all rows, nominal
    features divided in any two sets.  ``inputCols`` is the rows' key."""

    def __init__(self, labelCol="label", featuresCol="features", inputCols=(), numTrees=20, maxDepth=5, maxBins=32, seed=0):
        super().__init__()
        self._set(labelCol=labelCol, featuresCol=featuresCol, inputCols=list(inputCols), numTrees=numTrees,
                  maxDepth=maxDepth, maxBins=maxBins, seed=seed)

    def _fit(self, df):
        trees, depth, bins, seed = (self.getOrDefault(p) for p in ("numTrees", "maxDepth", "maxBins", "seed"))
        label, features = self.getLabelCol(), self.getFeaturesCol()
        classes = len(df.schema[label].metadata["ml_attr"]["vals"])
        attrs = df.schema[features].metadata["ml_attr"]
        width = attrs["num_attrs"]
        arity = [0] * width
        for kind in ("nominal", "binary"):
            for a in attrs.get("attrs", {}).get(kind, []):
                arity[a["idx"]] = len(a["vals"])
        if max(arity) > min(MOST_CATEGORIES, bins):
            raise ValueError(f"a feature of {max(arity)} categories; at most {min(MOST_CATEGORIES, bins)} can be divided")

        cores = df.sparkSession.sparkContext.defaultParallelism
        rows = df.select(vector_to_array(features).alias("x"), F.col(label).cast("int").alias("y"),
                         F.xxhash64(*self.getInputCols()).alias("key"))
        nominal = {f for f, a in enumerate(arity) if a}
        sketch = (rows.select("x").mapInArrow(_sketch(width, nominal), "feature int, value binary, weight binary")
                  .repartition(cores, "feature").mapInArrow(_thresholds(bins), "feature int, thresholds array<double>"))
        thresholds = [None if a else np.zeros(0) for a in arity]
        for r in sketch.collect():
            thresholds[r.feature] = np.array(r.thresholds, np.float64)
        cuts = [0 if t is None else len(t) for t in thresholds]

        parts = max(cores, -(-rows.count() // TASK_ROWS))
        blocks = (rows.mapInArrow(_blocks(thresholds, bins), "x binary, y binary, key binary")
                  .repartition(parts).persist(StorageLevel.MEMORY_AND_DISK))
        try:
            levels, leaves = self._grow(blocks, trees, depth, bins, seed, classes, width, arity, cuts, cores)
        finally:
            blocks.unpersist()
        size = leaves.sum(-1, keepdims=True)
        model = ForestModel(levels, leaves / np.where(size > 0, size, 1), thresholds)
        return self._copyValues(model)

    @staticmethod
    def _grow(blocks, trees, depth, bins, seed, classes, width, arity, cuts, cores):
        """Splits of each level and the classes' counts in the last level's nodes.  A node
        that isn't split passes its rows on to the left."""
        draw, k = np.random.default_rng(seed), math.ceil(math.sqrt(width))
        levels, is_open = [], np.ones((trees, 1), bool)
        leaves = np.zeros((trees, 1, classes))
        for level in range(depth):
            nodes = 2 ** level
            chosen = np.argsort(draw.random((trees, nodes, width)), axis=-1)[..., :k]
            feature = np.zeros((trees, nodes), np.int64)
            left = np.ones((trees, nodes, bins), np.uint8)
            on_left = leaves.copy()
            found = (blocks.mapInArrow(_count(levels, chosen, is_open, bins, classes, seed), "tree int, counts binary")
                     .repartition(cores, "tree")
                     .mapInArrow(_best(chosen, is_open, arity, cuts, bins, classes),
                                 "tree int, feature binary, bins_left binary, total binary, on_left binary")
                     .collect()) if is_open.any() else []
            for r in found:
                f = np.frombuffer(r.feature, np.int64)
                if level == 0:
                    leaves[r.tree] = on_left[r.tree] = np.frombuffer(r.total).reshape(nodes, classes)
                s = f >= 0
                feature[r.tree, s] = f[s]
                left[r.tree, s] = np.frombuffer(r.bins_left, np.uint8).reshape(nodes, bins)[s]
                on_left[r.tree, s] = np.frombuffer(r.on_left).reshape(nodes, classes)[s]
                is_open[r.tree] = s
            split = np.repeat(is_open, 2, axis=1)
            # sides of a split; below a leaf both sides keep the leaf's counts
            leaves = np.stack([on_left, np.where(is_open[..., None], leaves - on_left, leaves)], 2).reshape(trees, 2 * nodes, classes)
            is_open = split & ((leaves > 0).sum(-1) > 1)
            levels.append((feature, left))
        return levels, leaves


class ForestModel(Model, _ForestParams, MLWritable, MLReadable):
    """Trees of equal depth: by level the nodes' features and the bins that go left, the
    classes' shares in the last level's nodes, and the features' thresholds."""

    def __init__(self, levels=(), votes=None, thresholds=()):
        super().__init__()
        self.levels, self.votes, self.thresholds = list(levels), votes, list(thresholds)

    def _transform(self, df):
        run = F.arrow_udf(_votes(self.levels, self.votes, self.thresholds, self.getOrDefault("maxBins")), "array<double>")
        return df.withColumn(self.getRawPredictionCol(), array_to_vector(run(vector_to_array(self.getFeaturesCol()))))

    def write(self):
        return _ForestWriter(self)

    @classmethod
    def read(cls):
        return _ForestReader()


class _ForestWriter(MLWriter):
    def __init__(self, model):
        super().__init__()
        self.model = model

    def saveImpl(self, path):
        m, spark = self.model, self.sparkSession
        DefaultParamsWriter.saveMetadata(m, path, spark)
        trees = [(t, np.concatenate([f[t] for f, _ in m.levels]).tolist(),
                  bytearray(np.concatenate([left[t].ravel() for _, left in m.levels]).tobytes()), m.votes[t].ravel().tolist())
                 for t in range(len(m.votes))]
        spark.createDataFrame(trees, "tree int, feature array<int>, bins_left binary, votes array<double>").coalesce(1).write.parquet(f"{path}/trees")
        spark.createDataFrame([(f, None if t is None else t.tolist()) for f, t in enumerate(m.thresholds)],
                              "feature int, thresholds array<double>").coalesce(1).write.parquet(f"{path}/thresholds")


class _ForestReader(MLReader):
    def load(self, path):
        spark = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        trees = spark.read.parquet(f"{path}/trees").orderBy("tree").collect()
        thresholds = [None if r.thresholds is None else np.array(r.thresholds, np.float64)
                      for r in spark.read.parquet(f"{path}/thresholds").orderBy("feature").collect()]
        model = ForestModel(thresholds=thresholds)
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        depth, bins = model.getOrDefault("maxDepth"), model.getOrDefault("maxBins")
        feature = np.array([r.feature for r in trees], np.int64)
        left = np.stack([np.frombuffer(r.bins_left, np.uint8).reshape(-1, bins) for r in trees])
        at = [slice(2 ** d - 1, 2 ** (d + 1) - 1) for d in range(depth)]
        model.levels = [(np.ascontiguousarray(feature[:, s]), np.ascontiguousarray(left[:, s])) for s in at]
        model.votes = np.array([r.votes for r in trees]).reshape(len(trees), 2 ** depth, -1)
        return model
