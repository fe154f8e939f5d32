"""Date and time columns (DAT1-DAT8)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_date(value: Column, pattern: str = "yyyy-MM-dd") -> Column:
    """DAT1: text to date; text that does not fit gives NULL."""
    return F.try_to_timestamp(value, F.lit(pattern)).cast("date")


def parse_timestamp(value: Column, pattern: str | None = None) -> Column:
    """DAT2: text to timestamp; text that does not fit gives NULL."""
    return F.try_to_timestamp(value, F.lit(pattern)) if pattern else value.try_cast("timestamp")


def date_from_parts(year: Column, month: Column, day: Column) -> Column:
    """DAT6: a date, or NULL where the parts name no day (``make_date`` would raise)."""
    text = F.format_string("%04d-%02d-%02d", year.cast("int"), month.cast("int"), day.cast("int"))
    known = year.isNotNull() & month.isNotNull() & day.isNotNull()
    return F.when(known, text.try_cast("date"))


def month_gap(first: Column, second: Column) -> Column:
    """DAT7: absolute distance in months."""
    return F.abs(F.months_between(first, second))


def hour_distance(ts: Column, now: Column, wrap: bool = True) -> Column:
    """DAT8: hours of the day between two times; 23 and 0 are one apart unless ``wrap`` is off."""
    return hours_apart(F.hour(ts), F.hour(now), wrap)


def hours_apart(first: Column, second: Column, wrap: bool = True) -> Column:
    apart = F.abs(first - second)
    return F.least(apart, F.lit(24) - apart) if wrap else apart
