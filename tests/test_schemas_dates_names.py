import datetime

from pyspark.sql import functions as F

from pixelchange import schemas
from pixelchange.functions import dates, names


def test_segment_schema_string():
    s = schemas.segment_schema().simpleString()
    assert s.startswith("struct<cx:int,cy:int,px:int,py:int,sday:string,eday:string,bday:string,"
                        "chprob:float,curqa:int,blmag:float,")
    assert s.endswith("thint:float,rfrawp:array<float>>")
    assert len(schemas.segment_schema().fields) == 38
    assert len(schemas.detection_schema().fields) == 40


def test_table_schema_strings():
    assert schemas.chip_schema().simpleString() == "struct<cx:int,cy:int,dates:array<string>>"
    assert schemas.pixel_schema().simpleString() == "struct<cx:int,cy:int,px:int,py:int,mask:array<tinyint>>"
    assert schemas.tile_schema().names == ["tx", "ty", "name", "model", "updated"]


def test_series_schema():
    assert schemas.series_schema("foo") is None
    assert set(schemas.series_schema(None)) == {"ard", "aux"}
    assert schemas.series_schema("ard").names[4:] == ["dates", "blues", "greens", "reds", "nirs",
                                                      "swir1s", "swir2s", "thermals", "qas"]
    assert len(schemas.feature_columns()) == 33


def test_ordinals(spark):
    r = spark.createDataFrame([(1,), (734973,)], "o int").select(dates.ordinal_to_iso("o").alias("d")).collect()
    assert [x.d for x in r] == ["0001-01-01", "2013-04-15"]
    assert dates.iso_to_ordinal("2013-04-15") == 734973
    back = spark.createDataFrame([("2013-04-15",)], "s string").select(dates.date_to_ordinal("s")).first()[0]
    assert back == 734973


def test_acquired():
    a = dates.acquired_default(datetime.datetime(2020, 1, 2, 3, 4, 5))
    assert a == "0001-01-01/2020-01-02T03:04:05"
    assert dates.parse_acquired("1980-01-01/2017-01-01") == ("1980-01-01", "2017-01-01")


def test_namespace(spark):
    assert names.namespace_name(spark, "", "", "1.0") == "ccdc_1_0"
    assert names.namespace_name(spark, "http://h:5656/ard/v1", "http://h/aux", "1.0") == "ardv1_aux_ccdc_1_0"
    r = spark.createDataFrame([("", "", "1.0")], "a string, b string, v string") \
        .select(names.namespace_column("a", "b", "v")).first()[0]
    assert r == "ccdc_1_0"
