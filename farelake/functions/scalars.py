"""Scalar expressions. All are built-in JVM expressions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _second_of_epoch(ts: Column) -> Column:
    """Whole seconds on the wall clock; a zoned time is first read in the session zone."""
    return F.unix_timestamp(ts.cast("timestamp_ntz"))


def hour_of_day(ts: Column) -> Column:
    """Hour 0..23, as `F.hour`, which builds a calendar object per row and takes far longer."""
    return F.floor(F.pmod(_second_of_epoch(ts), F.lit(86400)) / 3600).cast("int")


def date_of(ts: Column) -> Column:
    """Calendar date, as `F.to_date`, but by plain division."""
    return F.date_from_unix_date(F.floor(_second_of_epoch(ts) / 86400).cast("int"))


def day_of_week(ts: Column) -> Column:
    """Day number with Sunday = 0. Spark's own `dayofweek` starts at 1."""
    return F.dayofweek(ts) - 1


def _elapsed(interval: Column) -> Column:
    return interval.cast("interval second").cast("decimal(18,6)")


def interval_micros(interval: Column) -> Column:
    """Length of a day-time interval in microseconds, as bigint."""
    return (_elapsed(interval) * 1_000_000).cast("bigint")


def seconds_between(start: Column, end: Column) -> Column:
    """Signed seconds from `start` to `end`, as double, fraction kept.

    Taken from the interval: `timestampdiff` would first move zoneless times into the session zone,
    where a clock change can fall between them.
    """
    return _elapsed(end - start).cast("double")


def longer_than(start: Column, end: Column, seconds: int) -> Column:
    """Whether `end` is more than `seconds` after `start`, to the microsecond.

    Whole seconds are a plain division of the stored value, and settle all but the trips within a
    second of the limit; only those pay for a calendar subtraction.
    """
    whole = _second_of_epoch(end) - _second_of_epoch(start)
    limit = F.expr(f"INTERVAL {seconds} SECONDS")
    return (whole > seconds) | ((whole == seconds) & (end - start > limit))


def round_half_away(value: Column, digits: int = 0) -> Column:
    """Round the scaled double half away from zero: 2.675 -> 2.68, but 1.005 -> 1.0.

    `F.round(value, digits)` rounds the decimal text instead, which gives 1.01 for 1.005.
    """
    scale = F.lit(float(10**digits))
    return F.round(value * scale, 0) / scale


def to_int_half_even(value: Column) -> Column:
    """Double to int, ties to even; null for NaN and for anything outside the int range."""
    return F.rint(value).try_cast("int")


def mean_from(total: Column, count: Column) -> Column:
    """Mean of pre-aggregated parts; null when nothing was counted."""
    return F.try_divide(total, count)


def month_start(text: Column) -> Column:
    """First day of a `YYYY-MM` text, null when the text is no such month."""
    parts = F.split(F.trim(text), "-")
    padded = F.concat(F.lpad(parts[0], 4, "0"), F.lit("-"), F.lpad(parts[1], 2, "0"), F.lit("-01"))
    return F.when(F.trim(text).rlike(r"^\d{1,4}-\d{1,2}$"), padded.try_cast("date"))


def file_name(taxi_type: Column, month: Column) -> Column:
    """Name of the file that holds one month (a date) of one taxi type."""
    return F.format_string("%s_tripdata_%s.parquet", taxi_type, F.date_format(month, "yyyy-MM"))


def split_list(text: Column) -> Column:
    """Comma list to array: items trimmed and lower-cased, empty items dropped."""
    items = F.transform(F.split(text, ","), lambda x: F.lower(F.regexp_replace(x, r"^\s+|\s+$", "")))
    return F.filter(items, lambda x: x != "")
