"""Calendar columns of the ``dates`` dimension."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_parts(day: Column) -> list[Column]:
    """ISO week, month, calendar year, and weekday with 1 = Sunday.

    The year is not the ISO year: 2021-01-03 is in week 53 of year 2021 here.
    """
    return [
        F.weekofyear(day).alias("date_week"),
        F.month(day).alias("date_month"),
        F.year(day).alias("date_year"),
        F.dayofweek(day).alias("date_weekday"),
    ]
