"""From message text to typed event columns. Works on streams and on tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.sources import schemas


def decode(messages: DataFrame, value: str = "value") -> DataFrame:
    """Event columns and ``date`` from JSON text; bad JSON gives a row of nulls."""
    data = F.from_json(F.col(value).cast("string"), schemas.EVENT).alias("data")
    return messages.select(data).select("data.*").withColumn(
        "date", F.col("timestamp").cast("date"))
