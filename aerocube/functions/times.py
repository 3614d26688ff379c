"""Epochs and times of the input formats, all in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seconds_since(seconds: Column, epoch: str) -> Column:
    """Seconds (may be fractional) since a UTC time such as '1993-01-01'."""
    return F.timestamp_micros((F.unix_seconds(F.lit(epoch).cast("timestamp")) * 1_000_000 + seconds * 1_000_000).cast("long"))


def tai93(seconds: Column) -> Column:
    return seconds_since(seconds, "1993-01-01")


def mjd2000(days: Column) -> Column:
    """Fractional days since 2000-01-01."""
    return seconds_since(F.round(days * 86_400, 3), "2000-01-01")


def hours_since_1900(hours: Column) -> Column:
    return seconds_since(hours * 3_600, "1900-01-01")


def day_1950(day: Column, ms: Column) -> Column:
    return seconds_since(day * 86_400 + ms / 1_000, "1950-01-01")


def year_day(text: Column) -> Column:
    """YYYYDDD as a date."""
    return F.date_add(F.make_date(F.substring(text, 1, 4).cast("int"), F.lit(1), F.lit(1)), F.substring(text, 5, 3).cast("int") - 1)


def clock_ms(value: Column) -> Column:
    """HHMMSSfff (an integer) as seconds of the day."""
    v = value.cast("long")
    return F.floor(v / 10_000_000) * 3_600 + F.floor(v / 100_000) % 100 * 60 + F.floor(v / 1_000) % 100 + v % 1_000 / 1_000


def day_fraction_hours(days: Column) -> Column:
    """Hours of the day in a fractional day."""
    return (days - F.floor(days)) * 24


def line_time(start: Column, end: Column, line: Column, lines: Column) -> Column:
    """Seconds at a scan line, between the seconds of day of the first and last; a pass may cross midnight."""
    span = F.when(end < start, end + 86_400).otherwise(end) - start
    return (start + line * span / lines) % 86_400


def line_stamp(start: Column, end: Column, line: Column, lines: Column) -> Column:
    """The time at a scan line as text, from those of the first and last line: `101530` where they are clock times `10:15:30`,
    `20150601_101530` where they are `2015:06:01:10:15:30`. A pass may cross midnight. Seconds are rounded; NULL for other texts."""
    clock = lambda t: F.unix_seconds(F.try_to_timestamp(F.concat(F.lit("1970-01-01 "), F.right(t, F.lit(8))), F.lit("yyyy-MM-dd HH:mm:ss")))
    first, last = clock(start), clock(end)
    seconds = F.floor(first + line * (F.when(last < first, last + 86_400).otherwise(last) - first) / lines + 0.5).cast("long")
    day = F.unix_seconds(F.try_to_timestamp(F.left(start, F.lit(10)), F.lit("yyyy:MM:dd")))
    dated = F.date_format(F.timestamp_seconds(day + seconds), "yyyyMMdd_HHmmss")
    return F.when(F.length(start) == 8, F.date_format(F.timestamp_seconds(F.pmod(seconds, F.lit(86_400))), "HHmmss")).when(F.length(start) == 19, dated)


def iso(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ssX"))
