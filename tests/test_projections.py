"""Projection contracts: one wide row with an extra column -> the table's
columns only, in table order (checked through the row's JSON form)."""

import json

from pyspark.sql import functions as F

from pixelchange import schemas
from pixelchange.functions.rows import json_rows
from pixelchange.operators import segments as SG


def _wide(spark):
    s = schemas.detection_schema()
    vals = {f.name: None for f in s.fields}
    vals.update(cx=100, cy=-100, px=50, py=-50, sday="0001-01-01", eday="0001-01-03", bday="0001-01-02",
                chprob=0.5, curqa=4, dates=["0001-01-01", "0001-01-02"], mask=[0, 1])
    for f in s.fields:
        if f.name.endswith(("mag", "rmse", "int")) and vals[f.name] is None:
            vals[f.name] = 0.5
        if f.name.endswith("coef"):
            vals[f.name] = [0.5, 0.5]
    df = spark.createDataFrame([tuple(vals[f.name] for f in s.fields)], s)
    return df.withColumn("extra", F.lit(True))


def test_project_segment(spark):
    seg = SG.project_segment(_wide(spark))
    assert seg.columns == schemas.segment_schema().names
    row = json.loads(json_rows(seg).first().json)
    assert "extra" not in row and "dates" not in row and row["blcoef"] == [0.5, 0.5]
    assert list(row)[:6] == ["cx", "cy", "px", "py", "sday", "eday"]


def test_project_pixel(spark):
    px = SG.project_pixel(_wide(spark).unionByName(_wide(spark)))
    assert px.columns == ["cx", "cy", "px", "py", "mask"]
    assert [json.loads(r.json) for r in json_rows(px).collect()] == \
        [{"cx": 100, "cy": -100, "px": 50, "py": -50, "mask": [0, 1]}]


def test_project_chip(spark):
    chip = SG.project_chip(_wide(spark))
    assert json.loads(json_rows(chip).first().json) == {"cx": 100, "cy": -100, "dates": ["0001-01-01", "0001-01-02"]}
    assert chip.schema.simpleString() == "struct<cx:int,cy:int,dates:array<string>>"


def test_tile_projection(spark):
    tile = spark.createDataFrame([(1, 2, "n", "m", "u", True)], "tx int, ty int, name string, model string, "
                                                                 "updated string, extra boolean")
    t = tile.select(*schemas.tile_schema().names)
    assert json.loads(json_rows(t).first().json) == {"tx": 1, "ty": 2, "name": "n", "model": "m", "updated": "u"}


def test_detect_tables_equal_wide_projections(spark):
    from pixelchange.operators import detect as D
    from pixelchange.sources import standins
    obs = standins.observations(spark, "/root/testdata/sf0.001")
    chip, pixel, segment = D.detect_tables(obs)
    ccd = D.detect(obs)
    norm = lambda df: sorted(r.json for r in json_rows(df).collect())
    assert norm(chip) == norm(SG.project_chip(ccd))
    assert norm(pixel) == norm(SG.project_pixel(ccd))
    assert norm(segment) == norm(SG.project_segment(ccd))


def test_nested_change_models(spark):
    """A full model, one with absent parts, and none at all."""
    from pixelchange.config import BAND_PREFIX
    from pixelchange.operators import segments as SG

    f = 0.5
    band = (f, f, [f, f], f)
    full = (730001, 730300, 730200, 3, f, f, *[band] * 7)
    part = (730001, 730300, None, 3, None, None, None, *[band] * 6)
    rows = [(1, 2, 3, 4, [730001, 730200, 730300], [0, 1, 0], [full]), (1, 2, 33, 4, [730001], None, [part, full]), (1, 2, 63, 4, [730001], [0], []), (1, 2, 93, 4, [730001], [0], None)]
    df = spark.createDataFrame(rows, f"cx int, cy int, px int, py int, dates array<int>, processing_mask array<int>, change_models array<{SG.change_model_type()}>")
    got = sorted(SG.format_change_models(df).collect(), key=lambda r: (r["px"], r["chprob"] is None))
    assert len(got) == 5
    r = got[0]
    assert (r["sday"], r["eday"], r["bday"], r["chprob"], r["mask"], len(r["dates"])) == ("1999-09-04", "2000-06-29", "2000-03-21", f, [0, 1, 0], 3)
    for p in BAND_PREFIX.values():
        assert (r[f"{p}mag"], r[f"{p}rmse"], r[f"{p}coef"], r[f"{p}int"]) == (f, f, [f, f], f)
    assert got[2]["bday"] is None and got[2]["blmag"] is None and got[2]["grmag"] == f and got[2]["mask"] is None
    assert all(x["sday"] == x["eday"] == x["bday"] == "0001-01-01" and x["chprob"] is None and x["blcoef"] is None for x in got[3:])
