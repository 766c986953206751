import math

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from pixelchange import schemas
from pixelchange.config import FEATURE_COLUMNS
from pixelchange.operators import features as FT
from pixelchange.operators import forest as RF
from pixelchange.operators import segments as SG


def _frames(spark, n=40):
    seg = schemas.segment_schema()
    rows = []
    for i in range(n):
        vals = {f.name: None for f in seg.fields}
        vals.update(cx=0, cy=0, px=30 * i, py=0, sday="2000-01-01", eday="2001-01-01", bday="2001-01-01")
        for f in seg.fields[9:-1]:
            vals[f.name] = [float(i), 9.0] if f.name.endswith("coef") else float(i % 7)
        rows.append(tuple(vals[f.name] for f in seg.fields))
    ccd = spark.createDataFrame(rows, seg)
    aux = spark.createDataFrame([(0, 0, 30 * i, 0, [1], [1.5 * i], [i % 4 + 1], [i], [0.5], [2.0], [1])
                                 for i in range(n)], schemas.series_schema("aux"))
    return aux, ccd


def test_densify_first_elements_and_nulls(spark):
    aux, ccd = _frames(spark, 3)
    f = FT.features(aux, ccd)
    assert f.columns == ["cx", "cy", "px", "py", "sday", "eday", "label", "features"]
    v = f.orderBy("px").select(vector_to_array("features").alias("v")).collect()[1].v
    assert len(v) == len(FEATURE_COLUMNS) == 33
    assert v[FEATURE_COLUMNS.index("blcoef")] == 1.0            # first element only
    assert v[FEATURE_COLUMNS.index("dem")] == 1.5
    nulls = ccd.withColumn("blmag", F.lit(None).cast("float")).withColumn("grcoef", F.array().cast("array<float>"))
    w = FT.features(aux, nulls).select(vector_to_array("features").alias("v")).first().v
    assert math.isnan(w[0]) and math.isnan(w[FEATURE_COLUMNS.index("grcoef")])


def test_filter_labels_and_period(spark):
    aux = spark.createDataFrame([(0, 0, 0, 0, [1], None, [0], None, None, None, None),
                                 (0, 0, 30, 0, [1], None, [9], None, None, None, None),
                                 (0, 0, 60, 0, [1], None, [3], None, None, None, None),
                                 (0, 0, 90, 0, [1], None, [], None, None, None, None)],
                                schemas.series_schema("aux"))
    assert [r.px for r in FT.filter_labels(aux).collect()] == [60]
    segs = spark.createDataFrame([("1999-01-01", "2000-01-01"), ("2001-01-01", "2003-01-01"),
                                  ("0001-01-01", "0001-01-01")], "sday string, eday string")
    import datetime
    lo, hi = datetime.date(1998, 1, 1).toordinal(), datetime.date(2002, 1, 1).toordinal()
    assert SG.filter_period(segs, lo, hi).count() == 1
    assert SG.filter_detected(segs).count() == 2


def test_train_classify_votes(spark):
    aux, ccd = _frames(spark)
    fdf = FT.features(aux, ccd)
    model = RF.fit(fdf, num_trees=7)
    out = RF.dedensify(RF.classify(model, fdf))
    rows = out.collect()
    assert len(rows) == 40
    labels = RF.labels(model)
    assert all(len(r.rfrawp) == len(labels) + 1 for r in rows)
    assert all(abs(sum(r.rfrawp) - 7) < 1e-4 for r in rows)
    again = RF.dedensify(RF.classify(RF.fit(fdf, num_trees=7), fdf)).orderBy("px").collect()
    assert [r.rfrawp for r in again] == [r.rfrawp for r in sorted(rows, key=lambda r: r.px)]


def test_empty_training_gives_none(spark):
    aux, ccd = _frames(spark, 2)
    assert RF.fit(FT.features(aux, ccd.limit(0))) is None


def test_join_predictions_replaces_rfrawp(spark):
    aux, ccd = _frames(spark, 2)
    preds = ccd.select(*FT.FEATURE_KEYS, F.array(F.lit(1.0).cast("float")).alias("rfrawp"))
    j = SG.join_predictions(ccd, preds)
    assert j.columns.count("rfrawp") == 1
    assert j.select("rfrawp").first()[0] == [1.0]


def test_row_json_projection(spark):
    from pixelchange.functions.rows import json_rows
    df = spark.createDataFrame([(1, 2, ["2000-01-01"], True)], "cx int, cy int, dates array<string>, extra boolean")
    chip = df.select(*schemas.chip_schema().fieldNames())
    assert json_rows(chip).first().json == '{"cx":1,"cy":2,"dates":["2000-01-01"]}'
