"""Time functions on epoch milliseconds (UTC).

Everything is integer arithmetic on ``long`` milliseconds, so it stays inside whole-stage
codegen and does not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MS_MINUTE = 60_000
MS_HOUR = 3_600_000
MS_DAY = 86_400_000


def epoch_ms(ts: Column) -> Column:
    """Timestamp (with or without zone; NTZ read as UTC) -> epoch ms, truncated (floor)."""
    return F.unix_millis(ts.cast("timestamp"))


def ms_to_minutes(ms: int) -> int:
    """Integer minutes of a duration in ms (config-time helper)."""
    return int(ms) // MS_MINUTE


def window_start_ms(ts_ms: Column, minutes: int, align: str = "hour") -> Column:
    """Start of the tumbling window of ``ts_ms``.

    align="hour": minute-of-hour floored to a multiple of ``minutes``, seconds and ms
    zeroed -- windows are aligned to the hour, so 25 gives :00, :25, :50 and anything
    above 60 gives hourly starts.  align="epoch": true ``minutes``-wide windows from the
    epoch (what ``F.window`` does).
    """
    if minutes <= 0:
        raise ValueError("minutes must be > 0")
    if align == "epoch":
        width = minutes * MS_MINUTE
        return ts_ms - F.pmod(ts_ms, F.lit(width))
    in_hour = F.pmod(ts_ms, F.lit(MS_HOUR))
    minute_of_hour = F.floor(in_hour / MS_MINUTE)
    floored = F.floor(minute_of_hour / minutes) * (minutes * MS_MINUTE)
    return (ts_ms - in_hour + floored).cast("long")


def _utc_date(ms: Column) -> Column:
    return F.date_from_unix_date(F.floor(ms / MS_DAY).cast("int"))


def date_key(window_start: Column, minutes: int) -> Column:
    """Coarse partition key of a window: ``yyyy-MM`` for <= 60 minutes, else ``yyyy-01``
    (January-June) / ``yyyy-12`` (July-December).  Year is space-padded to 4 like ``%4d``."""
    d = _utc_date(window_start)
    year = F.lpad(F.year(d).cast("string"), 4, " ")
    if minutes <= 60:
        month = F.lpad(F.month(d).cast("string"), 2, "0")
    else:
        month = F.when(F.month(d) <= 6, F.lit("01")).otherwise(F.lit("12"))
    return F.concat(year, F.lit("-"), month)


def ntz_from_ms(ms: Column) -> Column:
    """Epoch ms -> TIMESTAMP_NTZ holding the UTC wall time (zone independent)."""
    day = F.floor(ms / MS_DAY)
    in_day = ms - day * MS_DAY
    base = F.date_from_unix_date(day.cast("int")).cast("timestamp_ntz")
    return base + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                     (in_day / F.lit(1000)).cast("decimal(18,6)"))


def format_ts(ms: Column) -> Column:
    """``yyyy-MM-dd'T'HH:mm:ss'Z'`` in UTC; NULL -> the string ``null``."""
    return F.coalesce(F.date_format(ntz_from_ms(ms), "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("null"))
