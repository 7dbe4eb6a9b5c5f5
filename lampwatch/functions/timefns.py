"""Calendar and time helpers as Column builders.

Readings carry TIMESTAMP_NTZ wall-clock time.  Calendar parts and durations
are read from the wall clock directly, so no daylight-saving rule of the
session zone shifts them: a wall time is ``unix_date`` plus its microsecond
of the day.  Only instants from outside (epoch milliseconds of a log) need a
zone, which callers name.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lampwatch import labels as L

US = 1_000_000
DAY_US = 86_400 * US


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros(ts: Column | str) -> Column:
    """Wall-clock microseconds of a TIMESTAMP_NTZ (as if it were UTC), in any
    session zone.  Equal to what pandas reads from the same value, so batch
    and streaming state agree."""
    t = col(ts)
    return F.unix_date(F.to_date(t)).cast("bigint") * DAY_US + micro_of_day(t)


def wall_time(us: Column | str) -> Column:
    """TIMESTAMP_NTZ of wall-clock microseconds (the inverse of ``micros``)."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(secs=(col(us) / US).cast("decimal(18,6)"))


def wall_ms(ts: Column | str) -> Column:
    """Wall-clock milliseconds of a TIMESTAMP_NTZ."""
    return F.floor(micros(ts) / 1000).cast("bigint")


def local_time(ms: Column | str, zone: str) -> Column:
    """TIMESTAMP_NTZ wall time in ``zone`` of epoch milliseconds, whatever the
    session zone."""
    utc = F.convert_timezone(F.lit("UTC"), F.lit(zone), wall_time(col(ms).cast("bigint") * 1000))
    return utc.cast("timestamp_ntz")


def micro_of_day(ts: Column | str) -> Column:
    """Microsecond of the wall-clock day, zone independent."""
    t = col(ts)
    return ((F.hour(t) * 3600 + F.minute(t) * 60).cast("bigint") * US
            + (F.date_part(F.lit("SECOND"), t) * US).cast("bigint"))


def in_schedule(ts: Column | str, hour_start, minute_start, hour_end,
                minute_end) -> Column:
    """Working hours on Monday..Friday, closed interval [start, end].

    Saturday and Sunday are never in schedule; a start after the end
    (overnight) is never in schedule either."""
    t = col(ts)
    start = (_c(hour_start) * 3600 + _c(minute_start) * 60).cast("bigint") * US
    end = (_c(hour_end) * 3600 + _c(minute_end) * 60).cast("bigint") * US
    sod = micro_of_day(t)
    weekday = ~F.dayofweek(t).isin(1, 7)
    return weekday & (sod >= start) & (sod <= end)


def next_start_gap_s(ts: Column | str, hour_start, minute_start) -> Column:
    """whole seconds until the next schedule start; today's start when
    before it, else tomorrow's (weekends are not skipped)."""
    start = (_c(hour_start) * 3600 + _c(minute_start) * 60).cast("bigint") * US
    sod = micro_of_day(ts)
    gap = F.when(sod < start, start - sod).otherwise(start + DAY_US - sod)
    return F.floor(gap / US).cast("bigint")


def duration_s(start: Column | str, finish: Column | str) -> Column:
    """whole seconds from start to finish, truncated."""
    d = micros(finish) - micros(start)
    return F.when(d >= 0, F.floor(d / US)).otherwise(F.ceil(d / US)).cast("bigint")


def format_time(ts: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss``, of the wall time itself."""
    return F.substring(col(ts).cast("timestamp_ntz").cast("string"), 1, 19)


def parse_time(text: Column | str) -> Column:
    """strict ``yyyy-MM-dd HH:mm:ss``; a fractional tail is tolerated,
    anything else is NULL."""
    t = col(text)
    ok = t.rlike(r"\A\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d+)?\z")
    return F.when(ok, F.substring(t, 1, 19).try_cast("timestamp_ntz"))


def week_of_year(ts: Column | str) -> Column:
    """week of year with Sunday as first day and one minimal day in
    the first week (not ISO): the week holding 1 January is week 1."""
    d = F.to_date(col(ts))
    saturday = F.date_add(d, 7 - F.dayofweek(d))
    return F.floor((F.dayofyear(saturday) + 6) / 7).cast("int")


def weekday_sun0(ts: Column | str) -> Column:
    """F8: Sunday = 0 ... Saturday = 6."""
    return (F.dayofweek(col(ts)) - 1).cast("int")


def calendar_parts(ts: Column | str, prefix: str = "time_") -> list[Column]:
    """F6-F8 as named columns."""
    t = col(ts)
    return [
        F.year(t).alias(f"{prefix}year"),
        F.month(t).alias(f"{prefix}month"),
        F.dayofmonth(t).alias(f"{prefix}day"),
        F.hour(t).alias(f"{prefix}hour"),
        F.minute(t).alias(f"{prefix}minute"),
        F.second(t).alias(f"{prefix}second"),
        week_of_year(t).alias(f"{prefix}week"),
        weekday_sun0(t).alias(f"{prefix}weekday"),
    ]


def epoch_ms(x: Column | str) -> Column:
    """epoch numbers below 1e11 are seconds, scaled to milliseconds."""
    c = col(x).cast("bigint")
    return F.when(c < L.EPOCH_SECONDS_LIMIT, c * 1000).otherwise(c)


def _c(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)
