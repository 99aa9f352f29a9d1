"""Clean a merged drop into the standardized online and offline layouts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from tillwright.functions import cleaning
from tillwright.operators import channels, shaping
from tillwright.sources import schemas, sinks

LAYOUTS = {channels.ONLINE: schemas.ONLINE, channels.OFFLINE: schemas.OFFLINE}


def _day(raw: DataFrame, name: str) -> Column:
    """Date column; text that is no date becomes null."""
    is_date = isinstance(raw.schema[name].dataType, DateType)
    return F.col(name) if is_date else F.try_to_date(F.col(name).cast("string"))


def _apart(value: Column) -> Column:
    """``value`` as it is, by a function that Spark leaves out of the code of a whole stage.

    All rules in the one method of a stage exceed what HotSpot compiles (8000 bytes) in a session
    without ``session.SETTINGS``; a projection of its own is generated in small methods.
    """
    return F.get(F.transform(F.array(value), lambda v: v), F.lit(0))


def standardize(
    raw: DataFrame,
    email_mode: str = "lenient",
    fix_price: bool = True,
    offers: Mapping[str, float] = cleaning.OFFERS,
) -> DataFrame:
    """All cleaning rules in one projection; rows are tagged by channel.

    No shuffle and no cache: the rules work row by row, so this runs inside the
    scan stage and whatever writes the result decides on the partitioning.
    """
    price = cleaning.unit_price("unit_price") if fix_price else F.col("unit_price")
    cleaned = raw.select(
        _apart(cleaning.transaction_id("transaction_id")).alias("transaction_id"),
        _day(raw, "transaction_date").alias("transaction_date"),
        "customer_id",
        cleaning.full_name("customer_fname", "customer_lname").alias("customer_name"),
        cleaning.email("customer_email", email_mode).alias("customer_email"),
        "product_id", "product_name", "product_category", "units",
        price.alias("unit_price"),
        cleaning.discount(offers).alias("discount"),
        "payment_method", "group",
        channels.tag("is_online").alias("transaction_type"),
        cleaning.whole_number("sales_agent_id").alias("sales_agent_id"),
        F.col("name").alias("sales_agent_name"),
        _day(raw, "hire_date").alias("sales_agent_hire_date"),
        cleaning.whole_number("branch_id").alias("branch_id"),
        F.col("location").alias("branch_location"),
        F.col("class").alias("branch_class"),
        _day(raw, "establish_date").alias("branch_establish_date"),
        *cleaning.address_parts("shipping_address"),
    )
    return cleaned.withColumn(
        "total_price", cleaning.total_price("units", "unit_price", "discount"))


def channel(standardized: DataFrame, name: str) -> DataFrame:
    """One channel in its layout."""
    rows = standardized.where(F.col("transaction_type") == name)
    return shaping.in_order(rows, LAYOUTS[name])


def standardize_strict(raw: DataFrame, drop_blank: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """The stricter chain: valid e-mails only, rows without a clear channel left out.

    Blank columns are dropped among ``drop_blank`` only, after the rules that
    need the offer columns.
    """
    common = shaping.pipeline(raw, [
        shaping.rename_business,
        lambda df: df.withColumns({
            "discount": cleaning.discount(),
            "customer_name": cleaning.full_name("customer_fname", "customer_lname"),
            "customer_email": cleaning.email("customer_email", "strict"),
            "transaction_id": cleaning.transaction_id("transaction_id"),
        }),
        lambda df: df.drop(*cleaning.OFFERS, "customer_fname", "customer_lname"),
        lambda df: df.withColumn(
            "total_price", cleaning.total_price("units", "unit_price", "discount")),
        shaping.cast_dates,
    ])
    if drop_blank:
        common = shaping.drop_blank_columns(common, drop_blank)
    parts = channels.split(common)
    online = parts[channels.ONLINE].select("*", *cleaning.address_parts()).drop("shipping_address")
    offline = shaping.cast_ids(parts[channels.OFFLINE])
    return {
        name: shaping.in_order(df, [c for c in LAYOUTS[name].fieldNames() if c in df.columns])
        for name, df in ((channels.ONLINE, online), (channels.OFFLINE, offline))
    }


def cleaned_layout(standardized: DataFrame) -> DataFrame:
    """Both channels in the 24 column layout that keeps the online flag."""
    flagged = standardized.withColumn(
        "is_online",
        F.when(F.col("transaction_type") == channels.ONLINE, F.lit("yes")).otherwise(F.lit("no")))
    return shaping.in_order(flagged, schemas.CLEANED)


def run(
    raw: DataFrame, base: str, run_stamp: str, group: str | None = None, grain: str = "day"
) -> dict[str, str]:
    """Standardize and store both channels; returns the table paths.

    ``run_stamp`` (``yyyyMMddHHmmss``) comes from the caller, so a repeated run
    writes to the same place.
    """
    cleaned = standardize(raw)
    return {
        name: sinks.write_standardized(channel(cleaned, name), base, name, run_stamp, group, grain)
        for name in LAYOUTS
    }
