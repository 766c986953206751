"""The forest's jobs: samples, counts, splits, layout."""

import itertools
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from pixelchange.operators import features as FT
from pixelchange.operators import forest as RF
from pixelchange.operators import trees


def _rows(spark, n, unknown=np.nan):
    """Classes by three features of 33, one of them nominal, and some noise; one is never known."""
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(n, 33)), 3)
    x[:, 4] = rng.integers(0, 5, n)
    x[:, 7] = unknown
    y = (x[:, 0] > 0).astype(int) + 2 * np.isin(x[:, 4], (1, 3)) + (x[:, 9] > 1)
    y = np.where(rng.random(n) < 0.05, rng.integers(0, 4, n), y)
    rows = [(0, 0, 30 * i, 0, "2000-01-01", "2001-01-01", int(y[i]), x[i].tolist()) for i in range(n)]
    df = spark.createDataFrame(rows, "cx int, cy int, px int, py int, sday string, eday string, label int, f array<double>")
    return df.withColumn("features", array_to_vector("f")).drop("f")


def _votes(model, fdf):
    return {r.px: list(r.rfrawp) for r in RF.dedensify(RF.classify(model, fdf)).collect()}


def test_votes_do_not_depend_on_the_layout(spark):
    fdf = _rows(spark, 300).persist()
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    try:
        for n in ("3", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            found.append(_votes(RF.fit(fdf, num_trees=5), fdf))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    assert found[0] == found[1]


def test_as_good_as_spark_ml(spark):
    fdf = _rows(spark, 2000, unknown=0.0).persist()      # Spark ML refuses an unknown value
    train, other = fdf.where("px % 90 > 0").persist(), fdf.where("px % 90 = 0").persist()
    model = RF.fit(train, num_trees=60)
    own = _votes(model, other)
    theirs = RF.Pipeline(stages=[*RF.stages()[:2], RandomForestClassifier(
        labelCol="class", featuresCol="inputs", numTrees=60, seed=1)]).fit(train)
    ml = {r.px: list(r.v) for r in theirs.transform(other).select("px", vector_to_array("rawPrediction").alias("v")).collect()}
    label = {r.px: r.label for r in other.collect()}

    def right(votes, names):
        return np.mean([int(names[int(np.argmax(v[:-1]))]) == label[p] for p, v in votes.items()])

    assert right(own, RF.labels(model)) > right(ml, RF.labels(theirs)) - 0.05
    # the same kind of trees: the votes of the classes are close on average
    assert RF.labels(model) == RF.labels(theirs)
    assert np.abs(np.array([own[p] for p in label]) - np.array([ml[p] for p in label])).mean() < 4


def test_stored_model_votes_the_same(spark, tmp_root):
    fdf = _rows(spark, 200).persist()
    model = RF.fit(fdf, num_trees=4)
    again = RF.load_model(RF.save_model(model, f"{tmp_root}/model"))
    assert _votes(again, fdf) == _votes(model, fdf) and RF.labels(again) == RF.labels(model)


def test_unseen_values_and_classes(spark):
    fdf = _rows(spark, 200)
    model = RF.fit(fdf, num_trees=4)
    values = F.transform(vector_to_array("features"), lambda v, i: F.when(i == 4, F.lit(99.0)).when(i == 0, F.lit(math.inf)).otherwise(v))
    odd = _votes(model, fdf.withColumn("features", array_to_vector(values)))
    assert len(odd) == 200 and all(abs(sum(v) - 4) < 1e-5 and v[-1] == 0 for v in odd.values())


def test_too_many_categories_are_refused(spark):
    df = spark.createDataFrame([(i, float(i % 12), "a") for i in range(60)], "id int, v double, label string")
    df = df.select("id", array_to_vector(F.array("v")).alias("features"), "label")
    df = StringIndexer(inputCol="label", outputCol="class", handleInvalid="keep").fit(df).transform(df)
    df = VectorIndexer(inputCol="features", outputCol="inputs", maxCategories=20).fit(df).transform(df)
    with pytest.raises(ValueError):
        trees.Forest(labelCol="class", featuresCol="inputs", inputCols=["id"], numTrees=2).fit(df)


def test_samples_are_poisson():
    key = np.random.default_rng(0).integers(0, 2 ** 63, 200_000).astype(np.uint64)
    drawn = trees._drawn(42)
    a, b = drawn(key, 0).astype(float), drawn(key, 1).astype(float)
    for k in range(5):
        assert abs((a == k).mean() - math.exp(-1) / math.factorial(k)) < 0.005
    assert abs(a.mean() - 1) < 0.01 and abs(np.corrcoef(a, b)[0, 1]) < 0.01


def test_counts_of_whole_blocks():
    """Several blocks of a task, a closed node: the counts are those of plain loops."""
    rng = np.random.default_rng(1)
    n, width, bins, classes = 500, 7, 4, 3
    x = rng.integers(0, bins, (n, width)).astype(np.uint8)
    y, key = rng.integers(0, classes, n).astype(np.int32), rng.integers(0, 2 ** 62, n)
    levels = [(np.array([[2], [5]]), (np.arange(bins) < 2).astype(np.uint8)[None, None].repeat(2, 0))]
    chosen, is_open = rng.integers(0, width, (2, 2, 3)), np.array([[True, True], [False, True]])
    cut = [slice(0, 130), slice(130, 131), slice(131, 500)]
    blocks = [pa.RecordBatch.from_arrays([pa.array([a[c].tobytes()], pa.binary()) for a in (x, y, key)], names=["x", "y", "key"]) for c in cut]
    total = {}
    for b in trees._count(levels, chosen, is_open, bins, classes, 9)(iter(blocks)):
        total[b.column(0)[0].as_py()] = np.frombuffer(b.column(1)[0].as_py(), np.int32).reshape(2, 3, bins, classes)
    drawn = trees._drawn(9)
    for t in range(2):
        want = np.zeros((2, 3, bins, classes), int)
        for i, w in enumerate(drawn(key.astype(np.uint64), t)):
            node = 0 if x[i, levels[0][0][t, 0]] < 2 else 1
            for j in range(3):
                if is_open[t, node]:
                    want[node, j, x[i, chosen[t, node, j]], y[i]] += w
        assert (total[t] == want).all()


def test_best_split_of_all():
    rng = np.random.default_rng(5)
    bins, classes, arity, cuts = 6, 3, [0, 4, 0], [5, 0, 3]
    counts = rng.integers(0, 9, (1, 3, bins, classes))
    counts[0, 1, 4:], counts[0, 2, 4:] = 0, 0
    for j in (1, 2):                               # every feature holds the same rows
        counts[0, j, 0] += counts[0].sum((1)).max(0) - counts[0, j].sum(0)
    counts[0, 0, 0] += counts[0, 1].sum(0) - counts[0, 0].sum(0)
    total = counts[0, 0].sum(0)

    def score(f, lefts):
        l = counts[0, f, list(lefts)].sum(0)
        r = total - l
        return sum((s * s).sum() / s.sum() for s in (l, r)) if l.sum() and r.sum() else -1

    ways = [(score(f, range(c + 1)), f) for f in (0, 2) for c in range(cuts[f])]
    ways += [(score(1, s), 1) for k in (1, 2, 3) for s in itertools.combinations(range(4), k)]
    batch = pa.RecordBatch.from_arrays([pa.array([0, 0], pa.int32()), pa.array(
        [c.astype(np.int32).tobytes() for c in (counts // 2, counts - counts // 2)], pa.binary())], names=["tree", "counts"])
    best = trees._best(np.array([[[0, 1, 2]]]), np.array([[True]]), arity, cuts, bins, classes)
    out, = best(iter([batch]))
    f = int(np.frombuffer(out.column(1)[0].as_py(), np.int64)[0])
    left = np.flatnonzero(np.frombuffer(out.column(2)[0].as_py(), np.uint8))
    assert math.isclose(score(f, left), max(w for w, _ in ways))
    assert (np.frombuffer(out.column(4)[0].as_py()) == counts[0, f, left].sum(0)).all()


def test_thresholds_are_quantiles():
    rng = np.random.default_rng(2)
    x = np.stack([rng.normal(size=100_000), rng.integers(0, 3, 100_000).astype(float)], 1)
    x[::7, 0] = np.nan
    batches = [pa.RecordBatch.from_arrays([pa.array(list(x[i:i + 5000]), pa.list_(pa.float64()))], names=["x"]) for i in range(0, len(x), 5000)]
    sketch = list(trees._sketch(2, set())(iter(batches)))
    cut = {b.column(0)[0].as_py(): b.column(1)[0].as_py() for b in trees._thresholds(32)(iter(sketch))}
    assert cut[1] == [0.5, 1.5]
    known = x[~np.isnan(x[:, 0]), 0]
    assert np.abs(np.searchsorted(np.sort(known), cut[0]) / len(known) - np.arange(1, 32) / 32).max() < 0.002


def test_fit_keeps_the_features_frame_contract(spark):
    fdf = _rows(spark, 50)
    out = RF.classify(RF.fit(fdf, num_trees=2), fdf)
    assert out.columns == [*FT.FEATURE_KEYS, "rfrawp"] and out.schema["rfrawp"].dataType.typeName() == "vectorudt"


def test_models_stored_by_spark_ml_still_load(spark, tmp_root):
    fdf = _rows(spark, 100, unknown=0.0).persist()
    old = RF.Pipeline(stages=[*RF.stages()[:2], RandomForestClassifier(labelCol="class", featuresCol="inputs", numTrees=3)]).fit(fdf)
    again = RF.load_model(RF.save_model(old, f"{tmp_root}/model"))
    assert _votes(again, fdf) == _votes(old, fdf)
