"""Days and instants. The clock is never read: callers pass the processing date in."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

_DAY = r"^\d{4}-\d{1,2}-\d{1,2}$"


def safe_date(c: Column) -> Column:
    """``YYYY-M-D`` text as a date. The guard keeps out ``2024`` and ``2024-02``, which
    Spark's cast would complete to a first of the month."""
    return F.when(c.rlike(_DAY), c.try_cast("date"))


def parse_day(c: Column) -> Column:
    """Like :func:`safe_date`, but white space around the text is allowed."""
    from cartloom.functions.text import ws_trim

    return safe_date(ws_trim(c))


def utc_instant(day: dt.date, hour: int = 0, minute: int = 0) -> dt.datetime:
    return dt.datetime(day.year, day.month, day.day, hour, minute, tzinfo=dt.timezone.utc)


def utc_day(ts: Column) -> Column:
    """UTC date of an instant, whatever the session time zone is."""
    return F.to_date(F.to_utc_timestamp(ts, F.current_timezone()))


def last_complete_month(day: dt.date) -> tuple[int, int]:
    """Year and month before the month of ``day``."""
    before = day.replace(day=1) - dt.timedelta(days=1)
    return before.year, before.month
