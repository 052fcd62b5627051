"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column) -> Column:
    """Integer yyyymmdd key."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def date_parts(day: Column) -> dict[str, Column]:
    """Numeric parts of a day; ``week`` is the ISO week."""
    return {
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "week": F.weekofyear(day),
        "day": F.dayofmonth(day),
        "day_of_year": F.dayofyear(day),
    }


def date_names(day: Column) -> dict[str, Column]:
    """English weekday and month names."""
    return {
        "day_name_of_week": F.date_format(day, "EEEE"),
        "month_name_of_week": F.date_format(day, "MMMM"),
    }
