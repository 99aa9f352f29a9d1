"""Distinct customers of any period from stored sketches of its hours.

A distinct count cannot be added up; a HyperLogLog sketch can be united. Hours are
sketched once, days and months are merged from the stored hours without a look at the
events. Uniting is idempotent and takes parts in any order, so the stream needs neither
state nor a watermark: each micro-batch stores sketches of its own events, an event that
comes a week late is one more part of its hour, and a batch that is repeated
replaces its directory.

Sketches of ``LG_K`` have 2^LG_K registers, at most 4 KB, whatever they count. Customers that
are null are not counted and make no row. Hours are those of the session time zone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillwright.streaming import sinks

LG_K = 12
# Relative standard error of a united sketch, 1.04 / sqrt(2^LG_K), and three times that.
ERROR = 3 * 1.04 / 2 ** (LG_K / 2)


def hourly(events: DataFrame, keys: Sequence[str], counted: str = "customerId") -> DataFrame:
    """A sketch of ``counted`` and the number of events per hour and key.

    Aggregated in each task before the shuffle: a hot key sends one sketch per task.
    """
    return events.where(F.col(counted).isNotNull() & F.col("timestamp").isNotNull()).groupBy(
        *keys, F.date_trunc("hour", "timestamp").alias("hour")).agg(
        F.count("*").alias("events"), F.hll_sketch_agg(counted, LG_K).alias("sketch"))


def merge(hours: DataFrame, unit: str) -> DataFrame:
    """Sketches of days, months or other units of ``date_trunc`` from those of hours.

    Keys are the columns beside hour, events and sketch. A merge of merged ones
    is ``merge(days.withColumnRenamed("period", "hour"), "month")``.
    """
    keys = [c for c in hours.columns if c not in ("hour", "events", "sketch")]
    return hours.groupBy(*keys, F.date_trunc(unit, "hour").alias("period")).agg(
        F.sum("events").alias("events"), F.hll_union_agg("sketch").alias("sketch"))


def estimate(sketch: str = "sketch") -> Column:
    return F.hll_sketch_estimate(sketch)


def within_error(estimated: str, exact: str) -> Column:
    """Whether an estimate lies within three standard errors; small counts are exact."""
    return F.abs(F.col(estimated) - F.col(exact)) <= F.ceil(F.col(exact) * ERROR)


def write_hours(
    events: DataFrame, keys: Sequence[str], path: str, checkpoint: str,
    trigger: Mapping = sinks.VIEW_TRIGGER, counted: str = "customerId",
) -> StreamingQuery:
    """Store the sketches of every micro-batch in a directory of its own."""
    def store(batch: DataFrame, number: int) -> None:
        hourly(batch, keys, counted).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (events.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
            .trigger(**trigger).start())


def stored_hours(spark: SparkSession, path: str) -> DataFrame:
    """Sketches of hours as the stream stored them; an hour may have several parts."""
    return spark.read.parquet(path).drop("batch")


def fold(spark: SparkSession, path: str, target: str) -> DataFrame:
    """One part per hour and key at ``target``, for when micro-batches have left many."""
    folded = merge(stored_hours(spark, path), "hour").withColumnRenamed("period", "hour")
    folded.write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)
