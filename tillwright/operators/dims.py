"""Dimension rows: calendar, product, customer, branch, agent, location."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.functions import calendar

PRODUCT = ["product_id", "product_name", "product_category", "unit_price"]
CUSTOMER = ["customer_id", "customer_name", "customer_email"]
BRANCH = ["branch_id", "branch_location", "branch_establish_date", "branch_class"]
SALES_AGENT = ["sales_agent_id", "sales_agent_hire_date", "sales_agent_name"]
LOCATION = ["shipping_street_name", "shipping_city", "shipping_state", "shipping_zip_code"]


def date_dim(spark: SparkSession, start: date | str, end: date | str) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    if str(start) > str(end):
        raise ValueError(f"calendar ends before it starts: {start} to {end}")
    bounds = spark.range(1).select(
        F.lit(str(start)).cast("date").alias("first_day"),
        F.lit(str(end)).cast("date").alias("last_day"),
    )
    return _days(bounds)


def date_dim_for(df: DataFrame, column: str) -> DataFrame:
    """Calendar that covers the dates of ``column``, so that no row falls outside."""
    day = F.col(column).cast("date")
    return _days(df.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day")))


def _days(bounds: DataFrame) -> DataFrame:
    # Bounds of an empty table are null; exploding null gives no days.
    days = bounds.select(
        F.explode(F.sequence("first_day", "last_day", F.expr("interval 1 day"))).alias("datee"))
    return days.select("datee", *calendar.parts("datee"))


def distinct_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Every combination of values; an id can come with several attribute sets."""
    return df.select(*columns).distinct()


def one_per_id(df: DataFrame, columns: list[str], seen: str = "transaction_date") -> DataFrame:
    """One row per id (the first column): the attributes seen last.

    On a tie the greatest attributes win. Attribute sets are reduced by a hash
    aggregate in every task first, so what is shuffled and compared afterwards
    is a few sets per id, however many sales a popular id has.
    """
    natural, attributes = columns[0], columns[1:]
    sets = (
        df.where(F.col(natural).isNotNull())
        .groupBy(*columns).agg(F.max(seen).alias("__seen"))
    )
    latest = sets.groupBy(natural).agg(F.max(F.struct("__seen", *attributes)).alias("__row"))
    return latest.select(natural, *[F.col(f"__row.{c}").alias(c) for c in attributes])


def product(sales: DataFrame) -> DataFrame:
    return one_per_id(sales, PRODUCT)


def customer(sales: DataFrame) -> DataFrame:
    return one_per_id(sales, CUSTOMER)


def branch(offline: DataFrame) -> DataFrame:
    return one_per_id(offline, BRANCH)


def sales_agent(offline: DataFrame) -> DataFrame:
    return one_per_id(offline, SALES_AGENT)


def location(online: DataFrame) -> DataFrame:
    """Distinct shipping locations, rows without any part left out."""
    present = F.coalesce(*[F.col(c) for c in LOCATION]).isNotNull()
    return distinct_rows(online.where(present), LOCATION)


# Reference value lists of the cleaned sales, by name.
VALUE_LISTS = {
    "products": ["product_name"],
    "categories": ["product_category"],
    "category_products": ["product_category", "product_name"],
    "shipping_locations": LOCATION,
    "streets": ["shipping_street_name"],
    "states": ["shipping_state"],
    "cities": ["shipping_city"],
    "zip_codes": ["shipping_zip_code"],
    "branch_locations": ["branch_location"],
    "branch_classes": ["branch_class"],
    "groups": ["group"],
}


def value_list(sales: DataFrame, name: str) -> DataFrame:
    return distinct_rows(sales, VALUE_LISTS[name])


def single_value_lists(sales: DataFrame) -> DataFrame:
    """All one-column lists as (list_name, value), from a single scan."""
    singles = {n: c[0] for n, c in VALUE_LISTS.items() if len(c) == 1}
    pairs = F.array(*[
        F.struct(F.lit(n).alias("list_name"), F.col(f"`{c}`").cast("string").alias("value"))
        for n, c in singles.items()
    ])
    return sales.select(F.explode(pairs).alias("pair")).select("pair.*").distinct()
