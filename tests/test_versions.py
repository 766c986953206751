"""The store's folders: appended writes, merged reads, compaction, pruning."""

import os

import pytest
from pyspark.sql import functions as F

from pixelchange import schemas
from pixelchange.plans import jobs
from pixelchange.sources import tables as T

COLS = ["cx", "cy", "px", "py", "sday", "eday", "bday"]


def _seg(spark, rows):
    s = schemas.segment_schema()
    return spark.createDataFrame([tuple(list(r) + [None] * (len(s.fields) - len(r))) for r in rows], s)


def _row(cx, cy, px, sday, bday):
    return (cx, cy, px, cy, sday, "2005-01-01", bday)


def _stored(spark, root):
    return sorted(tuple(r) for r in T.scan_table(spark, root, "segment").select(*COLS).collect())


def _size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(path) for f in files if f.endswith(".parquet"))


def _chips(spark):
    return [(r.cx, r.cy) for r in jobs.tile_chips(spark, -543585, 2378805).orderBy("cx", "cy").collect()]


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_writes_and_compactions_equals_a_dictionary(spark, tmp_root, seed):
    import random
    r = random.Random(seed)
    chips = r.sample(_chips(spark), 6) + [(300, -300)]
    want = {}
    for step in range(6):
        rows = [_row(*r.choice(chips), r.randrange(3), f"200{r.randrange(3)}-01-01", f"{step}-{i}") for i in range(12)]
        whole = step in (2, 4)
        T.write_segment(_seg(spark, rows), tmp_root, replace_chips=whole)
        if whole:
            gone = {x[:2] for x in rows}
            want = {k: v for k, v in want.items() if k[:2] not in gone}
        newest = {}
        for x in rows:
            newest[x[:6]] = max(newest.get(x[:6], ""), x[6])
        want.update(newest)
        expected = sorted((*k, v) for k, v in want.items())
        assert _stored(spark, tmp_root) == expected
        if step in (1, 4):
            assert T.compact(spark, tmp_root, "segment") > 0
            assert T.compact(spark, tmp_root, "segment") == 0
            assert _stored(spark, tmp_root) == expected
        if step == 4:
            assert T.vacuum(spark, tmp_root, "segment") > 0
            assert _stored(spark, tmp_root) == expected
    ids = spark.createDataFrame(chips[:3], schemas.chip_id_schema())
    got = sorted(tuple(x) for x in T.read_segment(spark, tmp_root, ids).select(*COLS).collect())
    assert got == [x for x in expected if x[:2] in chips[:3]]


def test_a_write_costs_its_rows_not_its_tile(spark, tmp_root):
    chips = _chips(spark)
    path = f"{tmp_root}/segment"
    one = _seg(spark, [_row(*chips[7], i, "2000-01-01", "x") for i in range(50)])
    T.write_segment(one, f"{tmp_root}/empty")
    alone = _size(f"{tmp_root}/empty/segment")
    T.write_segment(_seg(spark, [_row(*c, i, "2000-01-01", str(i)) for c in chips[:500] for i in range(20)]), tmp_root)
    before = _size(path)
    assert before > 4 * alone
    T.write_segment(one, tmp_root)
    assert _size(path) - before <= 2 * alone


def test_a_write_that_dies_is_not_seen_and_two_writers_of_a_tile_both_count(spark, tmp_root, monkeypatch):
    chips = _chips(spark)
    T.write_segment(_seg(spark, [_row(*chips[0], 0, "2000-01-01", "a")]), tmp_root)
    broken = _seg(spark, [_row(*chips[0], 0, "2000-01-01", "b")]).withColumn("bday", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        T.write_segment(broken, tmp_root)
    assert [x[-1] for x in _stored(spark, tmp_root)] == ["a"]
    # a second writer commits while the first one is still at work
    commit = T._commit

    def slow(spark_, df, *rest, **more):
        monkeypatch.setattr(T, "_commit", commit)
        T.write_segment(_seg(spark, [_row(*chips[0], 1, "2000-01-01", "second"), _row(*chips[0], 0, "2000-01-01", "c")]), tmp_root)
        return commit(spark_, df, *rest, **more)

    monkeypatch.setattr(T, "_commit", slow)
    T.write_segment(_seg(spark, [_row(*chips[0], 2, "2000-01-01", "first"), _row(*chips[0], 0, "2000-01-01", "d")]), tmp_root)
    assert sorted(x[-1] for x in _stored(spark, tmp_root)) == ["d", "first", "second"]


def test_a_compaction_keeps_writes_that_come_in_between(spark, tmp_root, monkeypatch):
    chips = _chips(spark)
    for b in "ab":
        T.write_segment(_seg(spark, [_row(*chips[0], 0, "2000-01-01", b)]), tmp_root)
    commit = T._commit

    def slow(*args, **more):
        monkeypatch.setattr(T, "_commit", commit)
        T.write_segment(_seg(spark, [_row(*chips[0], 0, "2000-01-01", "c")]), tmp_root)
        return commit(*args, **more)

    monkeypatch.setattr(T, "_commit", slow)
    assert T.compact(spark, tmp_root, "segment") == 1
    assert [x[-1] for x in _stored(spark, tmp_root)] == ["c"]
    T.compact(spark, tmp_root, "segment")
    T.vacuum(spark, tmp_root, "segment")
    assert [x[-1] for x in _stored(spark, tmp_root)] == ["c"]
    assert len(T._parts(spark, tmp_root, "segment")) == 1


def test_reads_open_only_the_blocks_of_their_ids(spark, tmp_root):
    chips = _chips(spark)
    T.write_segment(_seg(spark, [_row(*c, 0, "2000-01-01", "a") for c in chips]), tmp_root)
    seen = spark.createDataFrame(chips[:30], schemas.chip_id_schema())
    back = T.read_segment(spark, tmp_root, seen)
    back.collect()
    plan = back._jdf.queryExecution().executedPlan()
    assert "dynamicpruning" in plan.toString()
    # a run over the tile's 25 blocks: the first 30 chips by column lie in three or four of them
    files = {r.f for r in back.select(F.input_file_name().alias("f")).distinct().collect()}
    blocks = {f.split("block=")[1].split("/")[0] for f in files}
    scans = _scans(plan)
    assert 0 < sum(scans) <= 4 * len(blocks) and len(blocks) <= 4


def _scans(plan):
    """Files that the scans of an executed plan have read."""
    found, todo = [], [plan]
    while todo:
        p = todo.pop()
        name = p.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(p.plan())
        elif name == "FileSourceScanExec":
            found.append(p.metrics().apply("numFiles").value())
        else:
            todo += [p.children().apply(i) for i in range(p.children().size())]
    return found


def test_a_write_has_one_exchange(spark, tmp_root, monkeypatch):
    plans = []
    commit = T._commit

    def noted(spark_, df, *rest, **more):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return commit(spark_, df, *rest, **more)

    monkeypatch.setattr(T, "_commit", noted)
    T.write_segment(_seg(spark, [_row(300, -300, 0, "2000-01-01", "a")]), tmp_root)
    assert plans[0].count("Exchange hashpartitioning") == 1


def test_empty_writes_and_tables(spark, tmp_root):
    assert T.scan_table(spark, tmp_root, "segment").count() == 0
    T.write_segment(_seg(spark, []), tmp_root)
    assert T.scan_table(spark, tmp_root, "segment").count() == 0 and T.compact(spark, tmp_root, "segment") == 0
    assert T.read_segment(spark, tmp_root, spark.createDataFrame([], schemas.chip_id_schema())).count() == 0
