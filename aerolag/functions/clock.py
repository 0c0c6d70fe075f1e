"""Clock arithmetic on timestamps without a zone.

Differences and shifts never pass through a zoned timestamp, so results do
not depend on the session time zone or on daylight saving changes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def local_timestamp(day: Column, hhmm: Column) -> Column:
    """Date text ``yyyy-MM-dd`` and clock number ``HHmm`` as a timestamp.

    2400 is midnight at the end of the day; clock values that do not exist
    and unreadable dates give null.
    """
    clock = hhmm.cast("int")
    hour = F.floor(clock / F.lit(100)).cast("int")
    minute = F.pmod(clock, F.lit(100))
    valid = (clock >= 0) & (minute < 60) & (clock <= 2400)
    start = day.try_cast("date").cast("timestamp_ntz")
    return F.when(valid, start + F.make_dt_interval(F.lit(0), hour, minute))


def add_hours(ts: Column, hours: Column) -> Column:
    """Shift by a possibly fractional number of hours."""
    return ts + F.expr("INTERVAL '1' HOUR") * hours


def add_minutes(ts: Column, minutes: Column) -> Column:
    """Shift by a possibly fractional number of minutes."""
    return ts + F.expr("INTERVAL '1' MINUTE") * minutes


def _readings(ts: Column, zone: Column) -> tuple[Column, Column, Column]:
    """The UTC time of a zone's clock time, the one by the offset that holds hours later, and if that one fits."""
    utc = F.lit("UTC")
    later = ts + F.expr("INTERVAL '6' HOUR")
    second = ts - (later - F.convert_timezone(zone, utc, later))
    return F.convert_timezone(zone, utc, ts), second, F.convert_timezone(utc, zone, second) == ts


def zone_to_utc(ts: Column, zone: Column, overlap: str = "first") -> Column:
    """Clock time in a named zone to UTC, by the zone's rules on that day.

    A time that the clock shows twice is read as its "first" or "second" time.
    A time that it skips is read with the offset before the change, that is as
    late as if the change had not come yet. No zone gives null.
    """
    if overlap not in ("first", "second"):
        raise ValueError(f"unknown reading {overlap!r} of a repeated time")
    first, second, fits = _readings(ts, zone)
    return first if overlap == "first" else F.when(fits, second).otherwise(first)


def clock_state(ts: Column, zone: Column) -> Column:
    """Whether a zone's clock shows a time "once", "twice" or "never"."""
    first, second, fits = _readings(ts, zone)
    shown = F.convert_timezone(F.lit("UTC"), zone, first) == ts
    return F.when(~shown, "never").when(fits & (first != second), "twice").when(shown, "once")


def whole_minutes(later: Column, earlier: Column) -> Column:
    """Minutes from ``earlier`` to ``later``, cut toward zero."""
    gap = later - earlier
    days, hours, minutes = (F.extract(F.lit(part), gap) for part in ("DAY", "HOUR", "MINUTE"))
    return (days * F.lit(1440) + hours * F.lit(60) + minutes).cast("int")
