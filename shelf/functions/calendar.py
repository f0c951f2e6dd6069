"""Calendar columns derived from a date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The weekday names, Monday first.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

SHORT_SET = ("year", "month", "day", "day_of_week", "week_of_year", "quarter", "is_weekend")


def _flag(condition: Column) -> Column:
    return condition.cast("int")


def calendar_columns(date: Column) -> dict[str, Column]:
    """The ten calendar features; weekdays count from Monday = 0, weeks are ISO weeks."""
    return {
        "year": F.year(date),
        "month": F.month(date),
        "day": F.dayofmonth(date),
        "day_of_week": F.weekday(date),
        "week_of_year": F.weekofyear(date),
        "quarter": F.quarter(date),
        "is_weekend": _flag(F.weekday(date) >= 5),
        "is_month_start": _flag(F.dayofmonth(date) == 1),
        "is_month_end": _flag(F.last_day(date) == date),
        "day_of_year": F.dayofyear(date),
    }


def year_month(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def weekday_name(date: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, WEEKDAYS)), F.weekday(date) + 1)
