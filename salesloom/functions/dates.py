"""Dates: calendar attributes, prunable ranges, whole-day distances."""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ntz(moment: dt.date | str) -> Column:
    """A timestamp literal without zone, so a comparison reaches the Parquet reader unchanged."""
    return F.lit(str(moment)).cast("timestamp_ntz")


def in_window(column: Column, start: dt.date | None, end: dt.date | None) -> Column:
    """Half-open window ``start <= column < end``; a missing bound is open."""
    test = F.lit(True)
    if start is not None:
        test = test & (column >= ntz(start))
    if end is not None:
        test = test & (column < ntz(end))
    return test


def in_years(column: Column, first: int, last: int) -> Column:
    """Calendar years as a range on the raw column, which lets file statistics prune."""
    return in_window(column, dt.date(first, 1, 1), dt.date(last + 1, 1, 1))


def quarter_bounds(as_of: dt.date) -> tuple[dt.date, dt.date]:
    """First day of the quarter holding ``as_of`` and first day of the next one."""
    month = 3 * ((as_of.month - 1) // 3) + 1
    start = dt.date(as_of.year, month, 1)
    return start, months_later(start, 3)


def months_later(day: dt.date, months: int) -> dt.date:
    """Month shift; a day that the month lacks becomes the last one it has."""
    index = day.year * 12 + day.month - 1 + months
    year, month = index // 12, index % 12 + 1
    return dt.date(year, month, min(day.day, calendar.monthrange(year, month)[1]))


def whole_days(end: Column, start: Column) -> Column:
    """Day field of the interval between two timestamps without zone."""
    return F.extract(F.lit("DAY"), end - start).cast("int")


CALENDAR = {
    "calendar_year": lambda d: F.year(d),
    "calendar_quarter_number": lambda d: F.quarter(d),
    "calendar_month_number": lambda d: F.month(d),
    "calendar_month_desc": lambda d: F.date_format(d, "yyyy-MM"),
    "calendar_week_number": lambda d: F.weekofyear(d),
    "day_name": lambda d: F.date_format(d, "EEEE"),
}


def with_calendar(df: DataFrame, day: str, *attributes: str) -> DataFrame:
    """Add calendar attributes derived from a date column; no calendar table is joined."""
    names = attributes or tuple(CALENDAR)
    return df.withColumns({name: CALENDAR[name](F.col(day)) for name in names})


def calendar_of(df: DataFrame, moment: str, day: str = "time_id") -> DataFrame:
    """Calendar dimension: one row per day that occurs in ``df``, with all attributes."""
    days = df.filter(F.col(moment).isNotNull()).select(F.to_date(moment).alias(day)).distinct()
    return with_calendar(days, day)


def dense_calendar(df: DataFrame, moment: str, day: str = "time_id") -> DataFrame:
    """One row per calendar day from the first to the last day of ``df``, days that do not occur included."""
    ends = df.agg(F.min(F.to_date(moment)).alias("first"), F.max(F.to_date(moment)).alias("last"))
    return ends.filter(F.col("first").isNotNull()).select(F.explode(F.sequence("first", "last")).alias(day))
