"""Where streams end: event archive, view tables, latest event per customer."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# File size bounds and trigger intervals of the two kinds of sinks.
ARCHIVE_RECORDS_PER_FILE = 1_000_000
VIEW_RECORDS_PER_FILE = 100_000
ARCHIVE_TRIGGER = {"processingTime": "1 minute"}
VIEW_TRIGGER = {"processingTime": "5 minutes"}
DRAIN = {"availableNow": True}


def archive(
    events: DataFrame, path: str, checkpoint: str, trigger: Mapping = ARCHIVE_TRIGGER
) -> StreamingQuery:
    """All events as Parquet, by type and date."""
    return (
        events.writeStream.outputMode("append").format("parquet")
        .option("path", path).option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", ARCHIVE_RECORDS_PER_FILE)
        .partitionBy("eventType", "date")
        .trigger(**trigger).start()
    )


def archive_flat(
    events: DataFrame, path: str, checkpoint: str, trigger: Mapping | None = None
) -> StreamingQuery:
    """The archive without partition directories."""
    return (
        events.writeStream.outputMode("append").format("parquet")
        .option("path", path).option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", ARCHIVE_RECORDS_PER_FILE)
        .trigger(**(trigger or {"processingTime": "30 seconds"})).start()
    )


def write_view(
    view: DataFrame, path: str, checkpoint: str, trigger: Mapping = VIEW_TRIGGER
) -> StreamingQuery:
    """Closed windows as Parquet files."""
    return (
        view.writeStream.outputMode("append").format("parquet")
        .option("path", path).option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", VIEW_RECORDS_PER_FILE)
        .option("compression", "snappy")
        .trigger(**trigger).start()
    )


# --- latest event per customer ------------------------------------------------
#
# Each micro-batch writes its newest event per customer to a directory of its
# own, named by the batch: the cost of a batch is that of its customers, and a
# replayed batch overwrites its own directory. Every ``FOLD_EVERY`` batches, the
# stream folds them and the last fold into a new one. What a fold has replaced is
# deleted one fold later, so that a running reader keeps its files. The table
# holds at most two folds and twice as many batches, however long the stream runs.

KEY, TIME = "customerId", "timestamp"
BATCH = "__batch"
FOLD_EVERY = 16


def newest_per_customer(events: DataFrame) -> DataFrame:
    """One whole row per customer: the latest event, the greatest row on a tie.

    Partial aggregation keeps one row per customer and task before the shuffle.
    """
    others = [c for c in events.columns if c not in (KEY, TIME)]
    newest = events.where(F.col(KEY).isNotNull()).groupBy(KEY).agg(
        F.max(F.struct(TIME, *others)).alias("row"))
    return newest.select(KEY, "row.*").select(*events.columns)


def upsert_latest(path: str, fold_every: int = FOLD_EVERY):
    """``foreachBatch`` callback that puts the batch into the table at ``path``."""

    def put(batch: DataFrame, epoch: int) -> None:
        newest_per_customer(batch).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")
        if (epoch + 1) % fold_every == 0:
            _fold(batch.sparkSession, path, epoch, fold_every)

    return put


def _numbers(spark: SparkSession, path: str, kind: str) -> list[int]:
    """Numbers of the finished directories ``kind=N`` below ``path``."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    done = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{kind}=*/_SUCCESS")) or []
    return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in done)


def _fold(spark: SparkSession, path: str, epoch: int, every: int) -> None:
    """Safe to repeat: a finished fold is not made again from batches that may be gone."""
    if epoch not in _numbers(spark, path, "fold"):
        _newest(_puts(spark, path, epoch)).write.mode("overwrite").parquet(f"{path}/fold={epoch}")
    for kind in ("epoch", "fold"):
        for number in _numbers(spark, path, kind):
            if number <= epoch - every:
                target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{kind}={number}")
                target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _puts(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """The last fold (before a batch) and the batches after it, each row with its batch."""
    folds = [n for n in _numbers(spark, path, "fold") if before is None or n < before]
    last = max(folds, default=-2)
    parts = [spark.read.parquet(f"{path}/fold={last}")] if folds else []
    for number in _numbers(spark, path, "epoch"):
        if number > last and (before is None or number <= before):
            rows = spark.read.parquet(f"{path}/epoch={number}")
            parts.append(rows.withColumn(BATCH, F.lit(number)))
    return reduce(DataFrame.unionByName, parts)


def _newest(puts: DataFrame) -> DataFrame:
    others = [c for c in puts.columns if c not in (KEY, TIME, BATCH)]
    newest = puts.groupBy(KEY).agg(F.max(F.struct(TIME, BATCH, *others)).alias("row"))
    return newest.select(KEY, "row.*")


def latest_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Newest event per customer over all batches; a later batch wins on equal time."""
    return _newest(_puts(spark, path)).drop(BATCH)


def compact(spark: SparkSession, path: str, target: str) -> DataFrame:
    """Write the snapshot as the first batch of a new table at ``target``."""
    latest_snapshot(spark, path).write.parquet(f"{target}/epoch=-1")
    return latest_snapshot(spark, target)


def as_cells(rows: DataFrame, family: str = "cf") -> DataFrame:
    """Row key and ``family:column`` text cells, the layout of a wide-column store."""
    cells = [
        (F.to_json(c) if rows.schema[c].dataType.typeName() == "struct"
         else F.col(c).cast("string")).alias(f"{family}:{c}")
        for c in rows.columns
    ]
    return rows.select(F.col(KEY).alias("row_key"), *cells)


def write_latest(
    events: DataFrame, path: str, checkpoint: str, trigger: Mapping | None = None
) -> StreamingQuery:
    """Stream the events into the latest-per-customer table."""
    return (
        events.writeStream.outputMode("append").foreachBatch(upsert_latest(path))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or ARCHIVE_TRIGGER)).start()
    )
