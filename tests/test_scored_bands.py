"""Only the bands that are scored are fitted before a segment's summary."""

from pyspark.sql import functions as F

from pixelchange.operators import detect as D
from pixelchange.sources import standins

from .conftest import SF_SMALL


def test_the_steps_carry_scored_bands_and_unread_masks_are_not_built(spark):
    p = D.DetectParams()
    prepared = D.prepare(standins.observations(spark, SF_SMALL), p, D.PID)
    assert [c for c in prepared.columns if c.startswith("vario_")] == [f"vario_{b}" for b in p.detection_bands]
    wide = D.detect(standins.observations(spark, SF_SMALL))
    assert "collect_list" not in wide.select(*D.PIXEL, "sday", "blmag")._jdf.queryExecution().executedPlan().toString()
    assert wide.where(F.size("dates") != F.size("mask")).isEmpty()
