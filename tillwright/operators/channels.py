"""Online and offline: tagging, splitting, re-uniting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.operators.shaping import in_order
from tillwright.sources import schemas

ONLINE, OFFLINE = "online", "offline"



def tag(flag: Column | str = "is_online") -> Column:
    """``online`` for ``yes``; everything else, null included, is ``offline``."""
    flag = F.col(flag) if isinstance(flag, str) else flag
    return F.when(flag == "yes", F.lit(ONLINE)).otherwise(F.lit(OFFLINE))


def split(df: DataFrame, flag: str = "is_online") -> dict[str, DataFrame]:
    """Strict split: only ``yes`` and ``no`` rows, without the flag."""
    return {
        ONLINE: df.where(F.col(flag) == "yes").drop(flag),
        OFFLINE: df.where(F.col(flag) == "no").drop(flag),
    }


def split_losses(df: DataFrame, flag: str = "is_online") -> DataFrame:
    """Rows the strict split leaves out, counted by flag value."""
    kept = F.coalesce(F.col(flag).isin("yes", "no"), F.lit(False))
    return df.where(~kept).groupBy(flag).agg(F.count("*").alias("dropped_rows"))


def stack(*frames: DataFrame) -> DataFrame:
    """Union by name; a column missing on one side is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def all_sales(online: DataFrame, offline: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Both channels in the common 24 column layout, tagged by channel.

    ``extra`` adds columns the layout leaves out, such as ``total_price``.
    """
    both = stack(
        online.withColumn("transaction_type", F.lit(ONLINE)),
        offline.withColumn("transaction_type", F.lit(OFFLINE)),
    )
    return in_order(both, [*schemas.ALL_SALES, *extra])


def sales_of(online_fact: DataFrame, offline_fact: DataFrame) -> DataFrame:
    """Both facts as one tagged table, the input of the marts."""
    return stack(
        online_fact.withColumn("transaction_type", F.lit(ONLINE)),
        offline_fact.withColumn("transaction_type", F.lit(OFFLINE)),
    )
