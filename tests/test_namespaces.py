"""Catalogue namespaces and joins of bucketed tables."""

import uuid

import pytest
from pyspark.sql import functions as F

from pixelchange.operators import segments as SG
from pixelchange.plans import catalogue as C
from pixelchange.sources import namespaces as N
from pixelchange.sources import standins
from pixelchange.sources import tables as T

from .conftest import SF_SMALL


@pytest.fixture()
def name(spark, tmp_root):
    return N.create(spark, "n" + uuid.uuid4().hex, f"{tmp_root}/it's here")


def test_namespaces_keep_tables_apart(spark, name, tmp_root):
    other = N.create(spark, name + "_b", f"{tmp_root}/b")
    assert N.create(spark, name) == name and N.tables(spark, name) == [] == N.tables(spark, "none_" + name)
    rows = spark.createDataFrame([(1, 2, 3, 4, [0])], "cx int, cy int, px int, py int, mask array<tinyint>")
    N.save(rows, name, "pixel", 2)
    N.save(rows.limit(0), other, "pixel", 2)
    assert N.read(spark, name, "pixel").collect() == rows.collect() and N.read(spark, other, "pixel").count() == 0
    N.save(rows.withColumn("py", F.lit(5)), name, "pixel", 4)
    assert [r.py for r in N.read(spark, name, "pixel").collect()] == [5] and N.tables(spark, name) == ["pixel"]


def test_publish_takes_the_newest_rows(spark, name, tmp_root):
    rows = lambda m: spark.createDataFrame([(300, -300, 330, -330, [m])], "cx int, cy int, px int, py int, mask array<tinyint>")
    T.write_pixel(rows(0), tmp_root)
    T.write_pixel(rows(1), tmp_root)
    got = N.publish(spark, tmp_root, name, "pixel", 2)
    assert got.columns == ["cx", "cy", "px", "py", "mask"] and [r.mask for r in got.collect()] == [[1]]
    ids = spark.createDataFrame([(0, 0)], "cx int, cy int")
    assert N.publish(spark, tmp_root, name, "pixel", 2, ids).count() == 0


def test_features_and_predictions_join_without_a_shuffle(spark, name):
    segs = N.save(C._spans(spark, SF_SMALL).withColumn("rfrawp", F.lit(None).cast("array<float>")), name, "segment", 4)
    aux = N.save(standins.aux_layers(spark, SF_SMALL), name, "aux", 4)
    preds = N.save(segs.select(*C.FT.FEATURE_KEYS, F.array(F.length("sday").cast("float"), F.lit(2.0).cast("float")).alias("rfrawp")), name, "prediction", 4, C.D.PIXEL)
    out = C._in_place(segs, aux, preds)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    plain = C.FT.join_features(aux, SG.join_predictions(segs, preds))
    assert "Exchange" in plain._jdf.queryExecution().executedPlan().toString()
    key = C.FT.FEATURE_KEYS
    a, b = out.select(*key, "r0").cache(), plain.select(*key, F.col("rfrawp")[0].cast("double").alias("r0"))
    assert a.count() == segs.count() > 0 and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_bucket_count():
    assert [N.buckets_for(n, 1024) for n in (0, 1, 2**18, 2**18 + 1, 3 * 2**18)] == [1, 1, 1, 2, 4]
