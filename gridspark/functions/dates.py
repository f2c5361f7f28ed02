"""Civil (UTC, zone-free) date helpers."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted spellings of a valid time, most specific first.
TIME_PATTERNS = [
    "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd_HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd HH:mm", "yyyy-MM-dd", "yyyyMMddHH", "yyyyMMdd",
]


def _parse(text: Column, pattern: str) -> Column:
    return F.try_to_timestamp(text, F.lit(pattern))


def _day_of_year(year_text: Column, doy_text: Column) -> Column:
    """Date of ``year`` and day-of-year text, NULL when the day does not exist."""
    first = F.make_date(year_text.try_cast("int"), F.lit(1), F.lit(1))
    day = F.date_add(first, doy_text.try_cast("int") - 1)
    return F.when((doy_text.try_cast("int") >= 1) & (F.year(day) == year_text.try_cast("int")), day)


def parse_time(text: Column) -> Column:
    """Timestamp from any accepted spelling; a trailing Z is ignored; NULL if none fits."""
    t = F.trim(F.replace(text, F.lit("Z"), F.lit("")))
    return F.coalesce(*[_parse(t, p) for p in TIME_PATTERNS])


def date_from_name(name: Column) -> Column:
    """Date held in a file name: ``20YYMMDD`` first, else ``20YYDDD`` (day of year)."""
    # fixed values: stamps of file names
    base = F.regexp_extract(F.split_part(name, F.lit("?"), F.lit(1)), r"([^/]*)$", 1)
    ymd = F.regexp_extract(base, r"(20\d{2}\d{2}\d{2})", 1)
    yd = r"(20\d{2})(\d{3})(?:\D|$)"
    civil = F.when(ymd != "", _parse(ymd, "yyyyMMdd").cast("date"))
    ordinal = _day_of_year(F.regexp_extract(base, yd, 1), F.regexp_extract(base, yd, 2))
    return F.coalesce(civil, ordinal)


def stamp_hours(stamp: Column, hours) -> Column:
    """``yyyyMMddHH`` text moved by a number of hours."""
    h = F.lit(hours) if isinstance(hours, int) else hours
    moved = F.to_timestamp(stamp, "yyyyMMddHH") + F.make_dt_interval(hours=h)
    return F.date_format(moved, "yyyyMMddHH")


def reformat_stamp(stamp: Column, pattern_in: str, pattern_out: str) -> Column:
    """Date text from one pattern to another; NULL if it does not fit the first."""
    return F.date_format(_parse(stamp, pattern_in), pattern_out)


def stamps_back(start: Column, end: Column, step_hours: int) -> Column:
    """Array of ``yyyyMMddHH`` from ``end`` down to, but excluding, ``start``."""
    a, b = F.to_timestamp(start, "yyyyMMddHH"), F.to_timestamp(end, "yyyyMMddHH")
    step = F.make_dt_interval(hours=F.lit(step_hours))
    times = F.when(b > a, F.sequence(b, a + F.expr("interval 1 second"), -step)).otherwise(
        F.array().cast("array<timestamp>"))
    return F.transform(times, lambda t: F.date_format(t, "yyyyMMddHH"))


def previous_hour_label(label: Column, hours: int) -> Column:
    """``...THH`` label moved back by ``hours`` within the day, NULL stays NULL."""
    hour = F.split_part(label, F.lit("T"), F.lit(2)).cast("int")
    return F.concat(F.lit("T"), F.lpad(F.pmod(hour - hours, F.lit(24)).cast("string"), 2, "0"))


def restamp(df, valid_time, column: str = "valid_time"):
    """Replace the valid time of a state copy."""
    value = valid_time if isinstance(valid_time, Column) else F.lit(valid_time).cast("timestamp")
    return df.withColumn(column, value)


def source_date(valid: Column, source_year: int | None = None, leap_fallback: bool = True) -> Column:
    """Date to read for ``valid``: the same year or a climatology year; 29 Feb may fall to 28 Feb."""
    if source_year is None:
        return valid.cast("date")
    leap = (source_year % 4 == 0 and source_year % 100 != 0) or source_year % 400 == 0
    feb29 = (F.month(valid) == 2) & (F.dayofmonth(valid) == 29) & F.lit(not leap)
    moved = F.make_date(F.lit(source_year), F.month(valid), F.when(feb29, 28).otherwise(F.dayofmonth(valid)))
    return moved if leap_fallback else F.when(~feb29, moved)
