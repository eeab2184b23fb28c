"""Time expressions on wall-clock timestamps.

Every timestamp in the library is a ``timestamp_ntz``: UTC wall clock at the sources, local wall clock
after ``local_time``. The expressions below never go through the session time zone, so results do not
depend on ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def wall_clock(value: Column) -> Column:
    """A date becomes its midnight; a wall-clock timestamp stays what it is."""
    return value.cast("timestamp_ntz")


def local_time(ts: Column, zone: str | None, source: str = "UTC") -> Column:
    """Wall clock in ``zone`` of a wall clock in ``source``; unchanged when ``zone`` is None."""
    if zone is None:
        return ts
    return F.convert_timezone(F.lit(source), F.lit(zone), ts)


def minutes_between(start: Column, end: Column) -> Column:
    """Minute boundaries crossed from ``start`` to ``end`` (00:00:59 to 00:01:01 is 1), as bigint.

    Spark's own ``timestampdiff`` counts elapsed whole minutes and reads wall clocks in the session
    zone. Day, hour and minute fields give the boundary count directly.
    """
    start, end = wall_clock(start), wall_clock(end)
    days = F.datediff(end.cast("date"), start.cast("date")).cast("bigint")
    return days * 1440 + (F.hour(end) - F.hour(start)) * 60 + (F.minute(end) - F.minute(start))


def minus_minutes(ts: Column, minutes: Column) -> Column:
    """``ts`` moved back by ``minutes``; a fractional amount is rounded half away from zero first."""
    return F.timestamp_add("MINUTE", F.round(-minutes).cast("int"), wall_clock(ts))


def week_start(value: Column) -> Column:
    """Monday of the ISO week, as a date."""
    return F.trunc(value.cast("date"), "week")


def month_start(value: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(value.cast("date"), "month")
