"""Calendar parts of a date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column | str) -> Column:
    """``yyyyMMdd`` as a long, from arithmetic on the parts (no text round trip)."""
    day = F.col(day) if isinstance(day, str) else day
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("bigint")


def parts(day: Column | str) -> list[Column]:
    """Key, parts and names of a date, in the order of the date dimension."""
    day = F.col(day) if isinstance(day, str) else day
    weekday = F.dayofweek(day)
    return [
        date_key(day).alias("date_key"),
        F.dayofmonth(day).alias("day"),
        weekday.alias("day_of_week"),
        F.dayofyear(day).alias("day_of_year"),
        F.weekofyear(day).alias("week_of_year"),
        F.month(day).alias("month"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        # Sunday is 1, so the weekend flag marks Friday and Saturday.
        (weekday >= 6).cast("int").alias("is_weekend"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "yyyyMM").alias("year_month"),
    ]
