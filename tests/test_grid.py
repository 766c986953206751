from pyspark.sql import functions as F

from pixelchange.functions import grid


def _pt(spark, x, y):
    return spark.createDataFrame([(float(x), float(y))], "x double, y double")


def test_snap_fixture(spark):
    r = grid.snap(grid.snap(_pt(spark, -543585, 2378805), level="tile"), level="chip").first()
    assert (r.th, r.tv, r.tx, r.ty) == (13, 6, -615585, 2414805)
    assert (r.ch, r.cv, r.cx, r.cy) == (674, 312, -543585, 2378805)


def test_snap_origin(spark):
    r = grid.tile(_pt(spark, 0, 0)).first()
    assert (r.th, r.tv, r.tx, r.ty) == (17, 22, -15585, 14805)
    assert (r.ulx, r.uly, r.lrx, r.lry) == (-15585.0, 14805.0, 134415.0, -135195.0)


def test_tile_chips(spark):
    chips = grid.chips(grid.tile(_pt(spark, 0, 0)))
    assert chips.count() == 2500
    first = grid.classification_chips(_pt(spark, 0, 0)).orderBy("cx", F.desc("cy")).first()
    assert (first.cx, first.cy) == (-15585, 14805)


def test_near_order_and_training(spark):
    n = grid.near(_pt(spark, -543585, 2378805)).orderBy("nx", "ny").collect()
    assert len(n) == 9
    assert {(r.nh, r.nv) for r in n} == {(h, v) for h in (12, 13, 14) for v in (5, 6, 7)}
    assert grid.training_chips(_pt(spark, -543585, 2378805)).count() == 22500


def test_definition():
    assert grid.definition("tile")["sx"] == 150000
    assert [g["name"] for g in grid.definition()] == ["tile", "chip"]
    assert grid.chips_per_side() == 50
