"""Calendar and clock expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F

# The zone of the point-of-sale clocks and the text form of their timestamps.
LOCAL_ZONE = "Asia/Jakarta"
STAMP_PATTERN = "yyyy-MM-dd H:m:s '+07:00'"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def stamp(value: Column | str) -> Column:
    """Timestamp as text, time parts unpadded, with the fixed offset."""
    return F.date_format(_column(value), STAMP_PATTERN)


def local_to_utc(value: Column | str) -> Column:
    return F.convert_timezone(F.lit(LOCAL_ZONE), F.lit("UTC"), _column(value).cast("timestamp_ntz"))


def utc_to_local(value: Column | str) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(LOCAL_ZONE), _column(value).cast("timestamp_ntz"))


def first_of_month(value: Column | str) -> Column:
    return F.trunc(_column(value), "month")


def last_of_month(value: Column | str) -> Column:
    return F.last_day(_column(value))


def previous_month(value: Column | str) -> Column:
    """First day of the month before, over the year boundary too."""
    return F.add_months(first_of_month(value), -1)


def months_covered(start: Column | str, end: Column | str) -> Column:
    """First days of all months touched by a date range, as an array to explode."""
    return F.sequence(first_of_month(start), first_of_month(end), F.expr("interval 1 month"))


def seconds_of_day(clock: Column | str) -> Column:
    """Seconds in an ``HH:MM:SS`` text; null where the text is none."""
    parts = F.split(_column(clock).cast("string"), ":")
    return sum((F.try_element_at(parts, F.lit(i + 1)).try_cast("int") * unit for i, unit in enumerate((3600, 60, 1))), F.lit(0))


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Whole minutes between two clock texts, whatever their order (so midnight wraps to 24 h minus the length)."""
    return F.round(F.abs(seconds_of_day(end) - seconds_of_day(start)) / 60).cast("int")


def before_month(year: str, month: str, start: date) -> Column:
    return (F.col(year) < start.year) | ((F.col(year) == start.year) & (F.col(month) < start.month))


def before_year(year: str, start: date) -> Column:
    return F.col(year) < start.year
