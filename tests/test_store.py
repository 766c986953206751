from pyspark.sql import functions as F

from pixelchange import schemas
from pixelchange.sources import tables as T


def _seg(spark, rows):
    s = schemas.segment_schema()
    full = [tuple(list(r) + [None] * (len(s.fields) - len(r))) for r in rows]
    return spark.createDataFrame(full, s)


def test_upsert_replaces_by_key(spark, tmp_root):
    T.write_segment(_seg(spark, [(100, -100, 130, -130, "2000-01-01", "2001-01-01", "b1"),
                                 (300, -300, 330, -330, "2000-01-01", "2001-01-01", "b2")]), tmp_root)
    T.write_segment(_seg(spark, [(100, -100, 130, -130, "2000-01-01", "2001-01-01", "new"),
                                 (100, -100, 160, -130, "2000-01-01", "2001-01-01", "add")]), tmp_root)
    got = {(r.cx, r.px, r.bday) for r in T.scan_table(spark, tmp_root, "segment").collect()}
    assert got == {(100, 130, "new"), (300, 330, "b2"), (100, 160, "add")}


def test_replace_chips_drops_stale(spark, tmp_root):
    T.write_segment(_seg(spark, [(100, -100, 130, -130, "2000-01-01", "2001-01-01", "old")]), tmp_root)
    T.write_segment(_seg(spark, [(100, -100, 130, -130, "2000-01-01", "2002-01-01", "new")]), tmp_root,
                    replace_chips=True)
    got = [(r.eday, r.bday) for r in T.scan_table(spark, tmp_root, "segment").collect()]
    assert got == [("2002-01-01", "new")]


def test_read_by_ids(spark, tmp_root):
    T.write_segment(_seg(spark, [(100, -100, 130, -130, "2000-01-01", "2001-01-01", "a"),
                                 (300, -300, 330, -330, "2000-01-01", "2001-01-01", "b")]), tmp_root)
    ids = spark.createDataFrame([(100.0, -100.0), (300.0, -300.0), (5.0, 5.0)], "cx double, cy double")
    got = T.read_segment(spark, tmp_root, ids)
    assert {r.cx for r in got.collect()} == {100, 300}
    plan = got._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line or "Scan parquet" in line]
    assert scan and "PartitionFilters: [" in scan[0] and "tx#" in scan[0].split("PartitionFilters: [")[1]


def test_tile_round_trip(spark, tmp_root):
    row = T.tile_row(spark, 1, 2, "rf", "m", "2020-01-01T00:00:00")
    T.write_tile(row, tmp_root)
    T.write_tile(T.tile_row(spark, 1, 2, "rf2", "m2", "2021-01-01T00:00:00"), tmp_root)
    ids = spark.createDataFrame([(1, 2)], schemas.tile_id_schema())
    got = T.read_tile(spark, tmp_root, ids).collect()
    assert [(r.name, r.model) for r in got] == [("rf2", "m2")]


def test_latest_by_key(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (2, 1, "z")], "k int, seq int, v string")
    got = {(r.k, r.v) for r in T.latest_by_key(df, ["k"], ["seq"]).collect()}
    assert got == {(1, "c"), (2, "z")}


def test_chip_pixel_writers(spark, tmp_root):
    chips = spark.createDataFrame([(100, -100, ["2000-01-01"]), (100, -100, ["2000-01-01"])],
                                  schemas.chip_schema())
    T.write_chip(chips, tmp_root)
    assert T.scan_table(spark, tmp_root, "chip").count() == 1
    px = spark.createDataFrame([(100, -100, 130, -130, [1, 0])], "cx int, cy int, px int, py int, mask array<tinyint>")
    T.write_pixel(px, tmp_root)
    assert T.scan_table(spark, tmp_root, "pixel").select(F.size("mask")).first()[0] == 2


def test_newest_of_equal_incoming_keys_counts(spark, tmp_root):
    rows = _seg(spark, [(100, -100, 130, -130, "2000-01-01", "2001-01-01", b) for b in ("b", "c", "a")])
    T.write_segment(rows, tmp_root)
    assert [r.bday for r in T.scan_table(spark, tmp_root, "segment").collect()] == ["c"]
    T.write_segment(rows.withColumn("seq", F.when(F.col("bday") == "a", 9).otherwise(1)), tmp_root, order=["seq"])
    assert [r.bday for r in T.scan_table(spark, tmp_root, "segment").collect()] == ["a"]


def test_input_of_an_upsert_is_computed_once(spark, tmp_root):
    T.write_segment(_seg(spark, [(100, -100, 130, -130, "2000-01-01", "2001-01-01", "b1")]), tmp_root)
    seen = spark.sparkContext.accumulator(0)

    def note(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    new = _seg(spark, [(100, -100, 130, -130, "2000-01-01", "2001-01-01", "b2"), (100, -100, 160, -130, "2000-01-01", "2001-01-01", "b3")])
    T.write_segment(new.mapInArrow(note, new.schema), tmp_root)
    assert seen.value == 2


def test_tiles_are_separate_folders_and_repeated_ids_return_rows_once(spark, tmp_root):
    T.write_tile(T.tile_row(spark, 1, 2, "a", "m", "u"), tmp_root)
    T.write_tile(T.tile_row(spark, 3, 4, "b", "m", "u"), tmp_root)
    ids = spark.createDataFrame([(1, 2), (1, 2), (3, 4)], schemas.tile_id_schema())
    assert sorted(r["name"] for r in T.read_tile(spark, tmp_root, ids).collect()) == ["a", "b"]
    chips = spark.createDataFrame([(100, -100, ["2000-01-01"])], schemas.chip_schema())
    T.write_chip(chips, tmp_root)
    twice = spark.createDataFrame([(100, -100)] * 2, schemas.chip_id_schema())
    assert T.read_chip(spark, tmp_root, twice).count() == 1
