"""Kafka as an event source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def options(
    servers: str, topic: str, user: str | None = None, password: str | None = None,
    starting: str = "earliest", max_per_trigger: int | None = None,
) -> dict[str, str]:
    """Reader options; with a user the connection is SASL over TLS.

    ``max_per_trigger`` bounds a micro-batch, so that starting at the earliest
    offset of a long topic does not read all of it at once.
    """
    out = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if max_per_trigger:
        out["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if user is not None:
        login = "org.apache.kafka.common.security.plain.PlainLoginModule"
        out["kafka.security.protocol"] = "SASL_SSL"
        out["kafka.sasl.mechanism"] = "PLAIN"
        out["kafka.sasl.jaas.config"] = (
            f'{login} required username="{user}" password="{password}";'
        )
    return out


def read_stream(spark: SparkSession, settings: dict[str, str]) -> DataFrame:
    """Topic as a stream with one text column, ``value``."""
    rows = spark.readStream.format("kafka").options(**settings).load()
    return rows.selectExpr("CAST(value AS STRING) AS value")
