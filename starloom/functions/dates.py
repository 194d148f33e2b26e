"""Date expressions shared by the calendar, archive and SCD operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the "still open" end of a validity interval.
OPEN_END = dt.date(9999, 12, 31)


def as_date(value: str | dt.date) -> dt.date:
    """Accept ``datetime``, ``date`` or ISO text and give a ``date``."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(value)


def date_column(value: str | dt.date | Column) -> Column:
    """A ``DateType`` column from a Python date, ISO text or an expression."""
    if isinstance(value, Column):
        return value.cast("date")
    return F.lit(as_date(value))


def calendar_columns(day: Column) -> dict[str, Column]:
    """Descriptive calendar attributes of a date column; Monday is day 1."""
    weekday = F.weekday(day)
    return {
        "full_date": F.date_format(day, "yyyy-MM-dd"),
        "year": F.year(day),
        "month": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "day": F.dayofmonth(day),
        "day_name": F.date_format(day, "EEEE"),
        "day_of_week": weekday + 1,
        "is_weekday": (weekday < 5).cast("int"),
        "is_weekend": (weekday >= 5).cast("int"),
    }


def previous_quarter(as_of: str | dt.date | Column) -> tuple[Column, Column]:
    """First and last day of the last full quarter before ``as_of``."""
    this_quarter = F.trunc(date_column(as_of), "quarter")
    return F.add_months(this_quarter, -3), F.date_sub(this_quarter, 1)


def previous_quarter_dates(as_of: str | dt.date) -> tuple[dt.date, dt.date]:
    """Driver-side twin of :func:`previous_quarter`, for names and filters."""
    day = as_date(as_of)
    this_quarter = dt.date(day.year, 3 * ((day.month - 1) // 3) + 1, 1)
    end = this_quarter - dt.timedelta(days=1)
    return dt.date(end.year, end.month - 2, 1), end
