"""Time parsing and calendar expressions (pure ``Column -> Column``).

All parsing is row-wise: a value's result never depends on other rows, and a
value that no format accepts becomes NULL (ANSI-safe ``try_*`` functions).
The session zone must be UTC (``tallyline.session.configure``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline import schemas as S
from tallyline.functions.datetext import parse_free_timestamp


def _blank_to_null(c: Column) -> Column:
    t = F.trim(c)
    return F.when(t != "", t)


def parse_timestamp(c: Column, dtype: T.DataType | None = None) -> Column:
    """Timestamp from text or a typed value; NULL on failure or blank.

    Tries the ISO cast (with optional ``T``, fraction and zone), then the
    fixed format list in order, then the free-format grammar of ``datetext``. A bare time of day is never accepted, so the
    run date cannot leak into calendar features. Typed timestamps (``NTZ`` or
    not) and dates are cast directly.
    """
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return c.cast("timestamp")
    text = _blank_to_null(c.cast("string"))
    has_date = text.rlike(r"\d{1,4}[-/]\d{1,2}[-/]\d{1,4}")
    options = [F.when(has_date, F.try_to_timestamp(text))]
    options += [F.try_to_timestamp(text, F.lit(f)) for f in S.TIMESTAMP_FORMATS + S.DATE_FORMATS]
    return F.coalesce(*options, parse_free_timestamp(text))


def parse_date(c: Column, dtype: T.DataType | None = None) -> Column:
    """Date from text by the fixed format order, then the ISO cast; NULL otherwise."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return c.cast("date")
    text = _blank_to_null(c.cast("string"))
    has_date = text.rlike(r"\d{1,4}[-/]\d{1,2}[-/]\d{1,4}")
    options = [F.try_to_timestamp(text, F.lit(f)) for f in S.DATE_FORMATS]
    options.append(F.when(has_date, F.try_to_timestamp(text)))  # a bare time is no date of today
    return F.coalesce(*options).cast("date")


def parse_time(c: Column) -> Column:
    """Time of day as ``struct<hour:int, minute:int>``; NULL if invalid.

    Accepts ``H:M`` with exactly two integer parts or a 4-digit ``HHMM``, after
    trimming, with hour in 0..23 and minute in 0..59.
    """
    text = F.trim(c.cast("string"))
    colon = text.rlike(r"^[+-]?\d+\s*:\s*[+-]?\d+$")
    digits = text.rlike(r"^\d{4}$")
    hour = (
        F.when(colon, F.split(text, ":").getItem(0).try_cast("int"))
        .when(digits, F.substring(text, 1, 2).try_cast("int"))
    )
    minute = (
        F.when(colon, F.split(text, ":").getItem(1).try_cast("int"))
        .when(digits, F.substring(text, 3, 2).try_cast("int"))
    )
    ok = hour.between(0, 23) & minute.between(0, 59)
    return F.when(ok, F.struct(hour.alias("hour"), minute.alias("minute")))


def combine_date_time(date_col: Column, time_col: Column) -> Column:
    """Timestamp from a date text and a time text joined by one space."""
    return parse_timestamp(F.concat_ws(" ", date_col.cast("string"), time_col.cast("string")))


def minutes_between(start: Column, end: Column) -> Column:
    """Signed minutes from ``start`` to ``end`` (timestamps), as double."""
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / F.lit(60_000_000.0)


def hours_between(start: Column, end: Column) -> Column:
    """Signed hours from ``start`` to ``end`` (timestamps), as double."""
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / F.lit(3_600_000_000.0)


def weekday(ts: Column) -> Column:
    """Day of week with Monday = 0."""
    return F.weekday(ts)


def time_of_day(hour: Column) -> Column:
    """Right-closed hour bins with 0 included: 0-6, 7-12, 13-18, 19-23."""
    expr = None
    lower = None
    for upper, label in S.TIME_OF_DAY_BINS:
        cond = hour <= upper if lower is None else (hour > lower) & (hour <= upper)
        if lower is None:
            cond = (hour >= 0) & cond
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
        lower = upper
    return expr


def calendar_block(ts: Column, prefix: str = "") -> list[Column]:
    """Calendar features of a timestamp; flags are FALSE when the time is NULL."""
    h = F.hour(ts)
    wd = weekday(ts)
    start, end = S.BUSINESS_HOURS
    return [
        h.alias(f"{prefix}hour"),
        wd.alias(f"{prefix}weekday"),
        F.month(ts).alias(f"{prefix}month"),
        F.dayofmonth(ts).alias(f"{prefix}day"),
        F.year(ts).alias(f"{prefix}year"),
        time_of_day(h).alias(f"{prefix}time_of_day"),
        F.coalesce(wd >= S.WEEKEND_START, F.lit(False)).alias(f"{prefix}is_weekend"),
        F.coalesce((wd < S.WEEKEND_START) & (h >= start) & (h < end), F.lit(False)).alias(f"{prefix}is_business_hour"),
    ]


def date_block(d: Column) -> list[Column]:
    """Staffing calendar features of a date; flags are FALSE when the date is NULL."""
    wd = weekday(d)
    return [
        wd.alias("weekday"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.year(d).alias("year"),
        F.coalesce(wd >= S.WEEKEND_START, F.lit(False)).alias("is_weekend"),
        F.quarter(d).alias("quarter"),
        F.coalesce(F.last_day(d) == d, F.lit(False)).alias("is_month_end"),
        F.coalesce(F.dayofmonth(d) == 1, F.lit(False)).alias("is_month_start"),
    ]
