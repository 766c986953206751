import base64

import numpy as np
from pyspark.sql import functions as F

from pixelchange.operators import series as SR
from pixelchange.sources import rasters


def test_registry_mapping(spark):
    bands = {r.layer: r.band for r in rasters.layer_bands(rasters.registry(spark)).collect()}
    assert bands["LE07_SRB1"] == "blues"
    assert bands["LC08_SRB2"] == "blues"
    assert bands["LC08_SRB7"] == "swir2s"
    assert "LE07_TAB1" not in bands
    assert bands["LC08_BTB10"] == "thermals" and "LC08_BTB11" not in bands
    assert bands["LE07_BTB6"] == "thermals"
    assert bands["LT05_PIXELQA"] == "qas"
    assert bands["AUX_DEM"] == "dem" and bands["AUX_TRENDS"] == "trends"


def _chip(values, dtype="<i2"):
    return base64.b64encode(np.asarray(values, dtype=dtype).tobytes()).decode()


def test_decode_all_fill_chip(spark):
    data = _chip(np.full(10000, -9999))
    df = spark.createDataFrame([(-1815585, 1064805, "2002-12-21T00:00:00Z", data, "h", "s", "le07_srb1")],
                               rasters.CHIP_RECORD_SCHEMA)
    px = SR.decoded_pixels(df, rasters.registry(spark))
    agg = px.agg(F.count("*"), F.min("value"), F.max("value"), F.min("px"), F.max("px"),
                 F.min("py"), F.max("py")).first()
    assert tuple(agg) == (10000, -9999.0, -9999.0, -1815585, -1812615, 1061835, 1064805)


def test_encode_decode_types(spark):
    vals = [1, -2, 300, -9999, 32767]
    df = spark.createDataFrame([(vals,)], "v array<int>")
    enc = df.select(rasters.encode_int16(F.col("v")).alias("d")).first().d
    assert enc == _chip(vals)
    f32 = _chip([1.5, -2.25], "<f4")
    u16 = _chip([65535, 1], "<u2")
    t = spark.createDataFrame([(enc, "INT16"), (f32, "FLOAT32"), (u16, "UINT16")], "d string, t string")
    got = [r.v for r in t.select(rasters.decode(F.col("d"), F.col("t")).alias("v")).collect()]
    assert got == [[1.0, -2.0, 300.0, -9999.0, 32767.0], [1.5, -2.25], [65535.0, 1.0]]


def test_pixel_coordinates(spark):
    df = spark.createDataFrame([(0, 0, list(range(201)))], "x int, y int, values array<int>")
    r = rasters.pixel_rows(df, "values", "x", "y").where("i = 201 - 1").first()
    assert (r.px, r.py) == (0, -60)


def test_series_assembly_and_alignment(spark):
    long = spark.createDataFrame(
        [(1, 1, 1, 1, 10, b, 100 + k) for k, b in enumerate(SR.ARD_BANDS)] +
        [(1, 1, 1, 1, 20, b, 200 + k) for k, b in enumerate(SR.ARD_BANDS)] +
        [(1, 1, 1, 1, 30, "blues", 5)],                # incomplete date: dropped
        "cx int, cy int, px int, py int, t int, band string, value int")
    wide = SR.pivot_bands(long, SR.ARD_BANDS)
    ard = SR.conform(SR.assemble(wide, SR.ARD_BANDS), "ard").first()
    assert ard.dates == [20, 10]
    assert ard.blues == [200, 100] and ard.qas == [207, 107]


def test_filter_acquired(spark):
    df = spark.createDataFrame([("2000-01-01T00:00:00Z",), ("2010-05-01T00:00:00Z",)], "acquired string")
    assert SR.filter_acquired(df, "1999-01-01/2005-12-31").count() == 1
