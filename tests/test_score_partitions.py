"""q12: rows are dealt by pixel once, in as many partitions as the table's size asks for."""

import re

from pixelchange.plans import catalogue as C

from .conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_partitions_follow_the_size(spark, monkeypatch):
    plan = _plan(C.q12_scores(spark, SF_SMALL))
    assert "hashpartitioning(px" in plan and len(set(re.findall(r"hashpartitioning\(px#\d+, py#\d+, (\d+)\)", plan))) == 1
    assert "ENSURE_REQUIREMENTS" not in "".join(x for x in plan.splitlines() if "hashpartitioning(px" in x)
    monkeypatch.setattr(C, "SCORE_BYTES", 16 * 1024)
    monkeypatch.setattr(C.standins, "LINE_BYTES", 2 * 1024)
    lines = re.findall(r"hashpartitioning\(l_partkey#\d+L, (\d+)\)", _plan(C.q12_scores(spark, SF_SMALL)))
    assert lines and min(map(int, lines)) > 4
    more = re.findall(r"hashpartitioning\(px#\d+, py#\d+, (\d+)\)", _plan(C.q12_scores(spark, SF_SMALL)))
    assert more and min(map(int, more)) > 4
