"""Chip files to the three tables: packed strips move once, pixel rows never."""

import base64
import datetime
import json
import re

import numpy as np
import pytest

from pixelchange.operators import detect as D
from pixelchange.operators import series as SR
from pixelchange.plans import jobs
from pixelchange.sources import rasters
from pixelchange.sources import tables as T

CX, CY = -1815585, 1064805
LAYERS = {"le07_srb1": "blues", "le07_srb2": "greens", "le07_srb3": "reds", "le07_srb4": "nirs",
          "le07_srb5": "swir1s", "le07_srb7": "swir2s", "le07_btb6": "thermals", "le07_pixelqa": "qas"}
STEP_AT = 24


@pytest.fixture(scope="module")
def chip_files(tmp_path_factory):
    """Two whole chips, 48 dates; each cell has its own level, in one chip they change once."""
    rng = np.random.default_rng(1)
    level, records = rng.integers(300, 3000, 10_000), []
    days = np.arange(730000, 730000 + 16 * 48, 16)
    for chip, step in ((0, 900), (1, 0)):
        for k, d in enumerate(days):
            for ubid, band in LAYERS.items():
                if band == "qas":
                    raster, kind = np.full(10_000, 66), "<u2"
                else:
                    raster, kind = level + rng.integers(-15, 16, 10_000) + (step if k >= STEP_AT else 0), "<i2"
                records.append(dict(x=CX + 3000 * chip, y=CY, acquired=datetime.date.fromordinal(int(d)).isoformat() + "T00:00:00Z",
                                    data=base64.b64encode(raster.astype(kind).tobytes()).decode(), hash="", source="", ubid=ubid))
    path = tmp_path_factory.mktemp("chips") / "chips.json"
    path.write_text("\n".join(json.dumps(r) for r in records))
    return str(path), days


def test_strips_hold_the_same_observations(spark, chip_files):
    chips = rasters.scan_chips(spark, chip_files[0])
    whole = SR.chip_observations(chips, rasters.registry(spark))
    strips = SR.strip_observations(chips, rasters.registry(spark), 6)
    few = "t < 730100"
    assert strips.drop("sid").where(few).exceptAll(whole.where(few)).isEmpty()
    assert strips.count() == whole.count() == 2 * 48 * 10_000
    assert strips.select("sid").distinct().count() == 2 * SR.STRIPS


def test_one_exchange_from_chip_files_to_segments(spark, chip_files, monkeypatch, tmp_root):
    plans = []

    def seen(df):
        keep = {k: spark.conf.get(k, "true") for k in D._PLANNED_WITHOUT}
        for k in keep:
            spark.conf.set(k, "false")
        try:
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        finally:
            for k, v in keep.items():
                spark.conf.set(k, v)
        return written(df)

    def stored(df, buckets):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return bucketed(df, buckets)

    written, bucketed = D.materialise, D.stored_by_strip
    monkeypatch.setattr(D, "materialise", seen)
    monkeypatch.setattr(D, "stored_by_strip", stored)
    path, days = chip_files
    ids = spark.createDataFrame([(CX, CY), (CX + 3000, CY)], "cx int, cy int")
    jobs.detect_chips(spark, ids, path, rasters.registry(spark), tmp_root)
    # the distinct ids of a broadcast side are no rows of chips
    shuffles = [len(re.findall(r"(?<!Broadcast)Exchange hashpartitioning\((\w+)#", p)) for p in plans]
    assert shuffles[0] - plans[0].count("Exchange hashpartitioning(x#") == 1 and "hashpartitioning(sid" in plans[0], plans[0]
    assert not any(shuffles[1:]) and len(plans) > 4, [p for p, n in zip(plans, shuffles) if n][-1][:3000]
    seg = T.scan_table(spark, tmp_root, "segment")
    by = {(r.cx, r.bday): r["count"] for r in seg.groupBy("cx", "bday").count().collect()}
    changed = datetime.date.fromordinal(int(days[STEP_AT])).isoformat()
    last = datetime.date.fromordinal(int(days[-1])).isoformat()
    assert by[CX, changed] > 9_000 and by.get((CX + 3000, changed), 0) < 50 and by[CX + 3000, last] > 9_000
    assert seg.select("px", "py").distinct().count() == 20_000
    assert T.scan_table(spark, tmp_root, "pixel").count() == 20_000
    assert T.scan_table(spark, tmp_root, "chip").count() == 2
