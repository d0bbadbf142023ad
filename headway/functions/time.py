"""Time and date column functions.  All are JVM-side expressions, independent of the session
time zone: wall-clock values are kept as TIMESTAMP_NTZ and epoch arithmetic is done on NTZ."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from headway.functions._cols import as_col

_EPOCH_NTZ = "timestamp_ntz'1970-01-01 00:00:00'"


def hms_to_seconds(c) -> Column:
    """GTFS ``HH:MM:SS`` (hours may exceed 23) to seconds after midnight; NULL, blank or
    malformed text gives NULL (ANSI-safe: ``try_cast``)."""
    c = as_col(c)
    parts = F.split(c, ":")
    h = F.try_element_at(parts, F.lit(1)).try_cast("int")
    m = F.try_element_at(parts, F.lit(2)).try_cast("int")
    s = F.try_element_at(parts, F.lit(3)).try_cast("int")
    return F.when(F.trim(c) != "", h * 3600 + m * 60 + s).cast("int")


def hms_hour(c) -> Column:
    """Leading hour field of an ``HH:MM:SS`` text as int, NULL when not numeric."""
    return F.split_part(as_col(c), F.lit(":"), F.lit(1)).try_cast("int")


def yyyymmdd_to_date(c) -> Column:
    """GTFS ``YYYYMMDD`` to DATE; NULL for blank or malformed input."""
    return F.try_to_date(as_col(c).cast("string"), "yyyyMMdd")


def epoch_to_utc_ntz(c) -> Column:
    """Epoch seconds to a UTC wall-clock TIMESTAMP_NTZ."""
    return F.timestamp_add("SECOND", as_col(c).cast("bigint"), F.expr(_EPOCH_NTZ))


def epoch_to_local_ntz(c, tz: str = "America/New_York") -> Column:
    """Epoch seconds to the wall clock of ``tz`` as TIMESTAMP_NTZ (DST aware)."""
    utc = epoch_to_utc_ntz(c)
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def ntz_epoch_seconds(c) -> Column:
    """Whole seconds between 1970-01-01 00:00 and an NTZ wall-clock value (floor)."""
    c = as_col(c)
    return (F.unix_date(F.to_date(c)).cast("bigint") * 86400
            + F.hour(c) * 3600 + F.minute(c) * 60 + F.floor(F.second(c)).cast("bigint"))


def minute_boundaries_between(start, end) -> Column:
    """Number of minute boundaries crossed from ``start`` to ``end`` (NTZ).  10:00:59 to 10:01:00
    counts 1; this is the calendar-unit difference, not elapsed whole minutes."""
    return (F.floor(ntz_epoch_seconds(end) / 60) - F.floor(ntz_epoch_seconds(start) / 60)).cast("bigint")


def hours_by_minute_boundaries(start, end) -> Column:
    """Duration in hours as minute boundaries / 60, as a DOUBLE; NULL when ``end`` is NULL."""
    return minute_boundaries_between(start, end).cast("double") / F.lit(60.0).cast("double")


def seconds_since_day_start(day, ts) -> Column:
    """Wall-clock seconds from midnight of ``day`` to ``ts`` (NTZ); may exceed 86 400 for trips
    past midnight.  On DST days this is wall-clock, not elapsed, time."""
    return (ntz_epoch_seconds(ts) - F.unix_date(as_col(day)).cast("bigint") * 86400).cast("int")


def weekday_flag(day, flags: dict[int, str]) -> Column:
    """Select the calendar flag column matching the weekday of ``day``.

    ``flags`` maps Spark ``dayofweek`` numbers (1 = Sunday .. 7 = Saturday) to column names."""
    dow = F.dayofweek(as_col(day))
    expr = None
    for num, name in flags.items():
        expr = (F.when(dow == num, F.col(name)) if expr is None
                else expr.when(dow == num, F.col(name)))
    return expr


# GTFS calendar columns by Spark dayofweek number (1 = Sunday .. 7 = Saturday).
GTFS_WEEKDAY_COLUMNS = {
    1: "sunday", 2: "monday", 3: "tuesday", 4: "wednesday",
    5: "thursday", 6: "friday", 7: "saturday",
}
