"""Day numbers (proleptic Gregorian ordinals, 1 = 0001-01-01) and date ranges."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import UNIX_EPOCH_ORDINAL


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ordinal_to_date(o) -> Column:
    return F.date_from_unix_date((_col(o) - F.lit(UNIX_EPOCH_ORDINAL)).cast("int"))


def ordinal_to_iso(o) -> Column:
    """day number -> 'YYYY-MM-DD'."""
    return ordinal_to_date(o).cast("string")


def date_to_ordinal(d) -> Column:
    """date/timestamp/ISO string -> day number (int)."""
    return (F.unix_date(F.to_date(_col(d))) + F.lit(UNIX_EPOCH_ORDINAL)).cast("int")


def iso_to_ordinal(s: str) -> int:
    return datetime.date.fromisoformat(s[:10]).toordinal()


def acquired_default(now: datetime.datetime | None = None) -> str:
    """S10: '0001-01-01/<now>', evaluated on each call."""
    now = now or datetime.datetime.now()
    return f"0001-01-01/{now.isoformat()}"


def parse_acquired(acquired: str) -> tuple[str, str]:
    """'start/end' -> (start date, end date) as ISO day strings."""
    start, end = acquired.split("/")
    return start[:10], end[:10]


def in_acquired(date_col, acquired: str) -> Column:
    """Acquisition date inside the inclusive range 'start/end'."""
    start, end = parse_acquired(acquired)
    d = F.to_date(_col(date_col))
    return d.between(F.to_date(F.lit(start)), F.to_date(F.lit(end)))


def in_acquired_days(day, acquired: str) -> Column:
    """The same for a day number column: plain bounds, which scans push down."""
    start, end = parse_acquired(acquired)
    return _col(day).between(F.lit(iso_to_ordinal(start)), F.lit(iso_to_ordinal(end)))


def in_acquired_time(time, acquired: str) -> Column:
    """The same for a timestamp column: from the first day's start to before the
    day after the last, without a function on the column."""
    start, end = parse_acquired(acquired)
    after = datetime.date.fromordinal(iso_to_ordinal(end) + 1).isoformat()
    t = _col(time)
    return (t >= F.lit(start).cast("timestamp")) & (t < F.lit(after).cast("timestamp"))
