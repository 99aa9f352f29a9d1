"""Expressions over aggregated values: growth, segments, display formatting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def growth_percent(current: Column, previous: Column) -> Column:
    """Change in percent; null without a previous value or when it is zero."""
    return F.try_divide(current - previous, previous) * 100


def segment(purchases: Column | str, spend: Column | str) -> Column:
    """Customer value class from number of purchases and money spent."""
    purchases, spend = (F.col(c) if isinstance(c, str) else c for c in (purchases, spend))
    return (
        F.when((purchases > 10) & (spend > 1000), "High Value")
        .when((purchases > 5) & (spend > 500), "Medium Value")
        .otherwise("Low Value")
    )


def formatted(df: DataFrame, **decimals: int) -> DataFrame:
    """Replace numbers by text with thousands separators, for display only.

    Sort before calling this: afterwards the column sorts as text.
    """
    return df.withColumns({name: F.format_number(name, d) for name, d in decimals.items()})
