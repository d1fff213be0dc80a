"""Date and time expressions; the clock is always a parameter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400
SECONDS_PER_YEAR = 365 * SECONDS_PER_DAY
SECONDS_PER_MONTH = SECONDS_PER_YEAR / 12
SECONDS_BEFORE_1970 = 62167219200
MONDAY = 2


def synthetic_seconds(ts: Column) -> Column:
    """Seconds of a calendar of 365-day years and equal months, as double."""
    return (
        F.year(ts).cast("double") * SECONDS_PER_YEAR
        + (F.month(ts) - 1) * F.lit(SECONDS_PER_MONTH)
        + (F.dayofmonth(ts) - 1) * SECONDS_PER_DAY
        + F.hour(ts) * 3600
        + F.minute(ts) * 60
        + F.second(ts)
    )


def epoch_minus_years(seconds: Column) -> Column:
    """1970-01-01 moved back whole years until `seconds` is not negative.

    The existing back conversion; it is not the inverse of
    `synthetic_seconds`. Use `instant` for a true conversion.
    """
    short = F.lit(SECONDS_BEFORE_1970) - seconds
    years = F.when(short > 0, F.ceil(short / SECONDS_PER_YEAR)).otherwise(0)
    return F.make_timestamp_ntz(
        (F.lit(1970) - years).cast("int"), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)
    )


def instant(seconds: Column) -> Column:
    """Timestamp of seconds since 1970."""
    return F.timestamp_seconds(seconds)


def previous_run_day(day: Column, weekend_aware: bool) -> Column:
    """Day before; where weekends do not run, Monday goes back to Friday."""
    if not weekend_aware:
        return F.date_sub(day, 1)
    return F.date_sub(day, F.when(F.dayofweek(day) == MONDAY, 3).otherwise(1))


def iso_day(day: Column) -> Column:
    """`yyyy-MM-dd` text."""
    return F.date_format(day, "yyyy-MM-dd")


def short_day(day: Column) -> Column:
    """`d/M/yyyy` text without zero padding."""
    return F.date_format(day, "d/M/yyyy")
