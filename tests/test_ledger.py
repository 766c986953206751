"""A detection run that is stopped between chunks and started again."""

import pytest
from pyspark.sql import functions as F

from pixelchange.operators import detect as D
from pixelchange.plans import jobs
from pixelchange.plans.catalogue import TREND, _first_point, _obs
from pixelchange.sources import ledger
from pixelchange.sources import tables as T

from .conftest import SF_SMALL

ACQUIRED = "1990-01-01/2005-12-31"


def test_a_stopped_run_goes_on_and_does_no_chip_twice(spark, tmp_root, monkeypatch):
    pt = _first_point(spark, SF_SMALL)
    obs = _obs(spark, SF_SMALL).checkpoint()
    whole, parts = f"{tmp_root}/whole", f"{tmp_root}/parts"
    run = lambda root, **more: jobs.change_detection(spark, pt.x, pt.y, obs, root, ACQUIRED, chunk_size=900, params=TREND, **more)
    done = {(r.cx, r.cy) for r in run(whole).collect()}
    seen, work = [], jobs.detect_batch

    def stopped(o, root, params=None, **more):
        if len(seen) == 1 and not more.get("again"):
            raise KeyboardInterrupt
        seen.append({(r.cx, r.cy) for r in o.select("cx", "cy").distinct().collect()})
        return work(o, root, params, **more)

    monkeypatch.setattr(jobs, "detect_batch", stopped)
    with pytest.raises(KeyboardInterrupt):
        run(parts, resume=True)
    first = list(seen)
    seen.clear()
    monkeypatch.setattr(jobs, "detect_batch", lambda o, root, params=None: (seen.append({(r.cx, r.cy) for r in o.select("cx", "cy").distinct().collect()}), work(o, root, params))[1])
    run(parts, resume=True)
    assert not (first[0] & set().union(*seen)) and first[0] | set().union(*seen) == done
    for table in ("chip", "pixel", "segment"):
        a, b = T.scan_table(spark, whole, table), T.scan_table(spark, parts, table)
        assert a.count() == b.count() > 0 and a.exceptAll(b).isEmpty()
    # all 2,500 chips are noted, those without observations too; nothing is left to do
    assert ledger.finished(spark, parts, ACQUIRED, TREND).count() == 2500
    seen.clear()
    assert run(parts, resume=True).count() == 0 and not seen
    # other dates or parameters are another run
    assert ledger.finished(spark, parts, "1990-01-01/1999-12-31", TREND).count() == 0
    assert ledger.finished(spark, parts, ACQUIRED, D.DetectParams()).count() == 0
    assert ledger.open_chips(spark.createDataFrame([(1, 2)], "cx int, cy int"), parts, ACQUIRED, TREND).select(F.col("cx")).first().cx == 1
