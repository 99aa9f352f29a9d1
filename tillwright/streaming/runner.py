"""Run the archive and the views side by side."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tillwright.streaming import sinks
from tillwright.streaming.views import VIEWS


def state_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """Session to start streams from, with one state partition per core by default.

    The number is fixed for the life of a checkpoint and cannot be adapted at run
    time, unlike that of a batch query: every partition commits state in every
    micro-batch, so too many cost as much as too few.
    """
    own = spark.newSession()
    for name in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        own.conf.set(name, spark.conf.get(name))
    cores = spark.sparkContext.defaultParallelism
    own.conf.set("spark.sql.shuffle.partitions", str(partitions or cores))
    return own


def start_all(
    events: DataFrame, base: str, names: Iterable[str] = tuple(VIEWS), drain: bool = False
) -> dict[str, StreamingQuery]:
    """Start archive and views, each with a checkpoint of its own.

    ``drain`` processes what is there and stops; otherwise the queries run at
    their trigger intervals until stopped.
    """
    def trigger(default: Mapping) -> Mapping:
        return sinks.DRAIN if drain else default

    queries = {
        "archive": sinks.archive(events, f"{base}/archive", f"{base}/checkpoints/archive",
                                 trigger(sinks.ARCHIVE_TRIGGER))
    }
    for name in names:
        queries[name] = sinks.write_view(
            VIEWS[name](events), f"{base}/{name}", f"{base}/checkpoints/{name}",
            trigger(sinks.VIEW_TRIGGER))
    return queries


def wait_all(spark: SparkSession, queries: Mapping[str, StreamingQuery]) -> None:
    """Wait until every query has ended; the first failure stops the others.

    ``spark`` is the session the queries were started from.
    """
    try:
        while any(q.isActive for q in queries.values()):
            spark.streams.awaitAnyTermination()
            spark.streams.resetTerminated()
        for query in queries.values():
            query.awaitTermination()
    except Exception:
        for query in queries.values():
            query.stop()
        raise
