"""Projection operators: rename, drop, order, cast, blank columns."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillwright.functions import cleaning

# Column names of the agent and branch files and their business names.
BUSINESS_NAMES = {
    "name": "sales_agent_name",
    "hire_date": "sales_agent_hire_date",
    "location": "branch_location",
    "establish_date": "branch_establish_date",
    "class": "branch_class",
}

# Headers that arrive misspelt or under an older name.
HEADER_REPAIRS = {
    "cusomter_lname": "customer_lname",
    "cusomter_email": "customer_email",
    "sales_person_id": "sales_agent_id",
}

DATES = ("transaction_date", "branch_establish_date", "sales_agent_hire_date")
IDS = ("sales_agent_id", "branch_id")


def rename_business(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(BUSINESS_NAMES)


def repair_headers(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(HEADER_REPAIRS)


def blank_columns(df: DataFrame, candidates: Iterable[str] | None = None) -> list[str]:
    """Columns without a single value, found in one pass over the data."""
    names = [c for c in df.columns if candidates is None or c in set(candidates)]
    if not names:
        return []
    # max over a boolean is one bit per column and task, unlike a count per column.
    seen = df.agg(*[F.max(F.col(f"`{c}`").isNotNull()).alias(c) for c in names]).first()
    return [c for c in names if not seen[c]]


def drop_blank_columns(df: DataFrame, candidates: Iterable[str] | None = None) -> DataFrame:
    """Drop columns that hold no value.

    ``candidates`` limits this to optional columns: later rules need some
    columns to exist even when a drop leaves them empty.
    """
    return df.drop(*blank_columns(df, candidates))


def in_order(df: DataFrame, columns: Sequence[str] | StructType) -> DataFrame:
    """Exactly these columns in this order."""
    names = columns.fieldNames() if isinstance(columns, StructType) else columns
    return df.select(*[F.col(f"`{c}`") for c in names])


def cast_dates(df: DataFrame, columns: Sequence[str] = DATES) -> DataFrame:
    """Text to date where the columns exist; null where it is no date."""
    return df.withColumns({c: F.try_to_date(c) for c in columns if c in df.columns})


def cast_ids(df: DataFrame, columns: Sequence[str] = IDS) -> DataFrame:
    return df.withColumns({c: cleaning.whole_number(c) for c in columns if c in df.columns})


def row_index(df: DataFrame, name: str = "row_index") -> DataFrame:
    """Unique, increasing, not consecutive number per row; needs no shuffle."""
    return df.withColumn(name, F.monotonically_increasing_id())


def pipeline(df: DataFrame, steps: Iterable[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Apply DataFrame functions in order."""
    for step in steps:
        df = df.transform(step)
    return df
