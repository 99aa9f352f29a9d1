"""Where intermediate tables go: the shared folder the cluster names.

``spark.checkpoint.dir`` is read from the session. Only a local session that
leaves it unset (tests, laptop) gets a folder of its own; a cluster without the
setting is an error, because a machine-local folder would not be visible to the
other executors.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
CODEC = "zstd"           # of the Parquet files: a fifth smaller than the default
_FREES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock, _inside = threading.Lock(), {}


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach."""
    named = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder shared by all executors")
    own = tempfile.mkdtemp(prefix="tillwright-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def drop(*tables: DataFrame) -> None:
    """Delete tables of :func:`materialize` that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            target = spark._jvm.org.apache.hadoop.fs.Path(folder)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def freeing(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside go when its job ends.

    Else they lie on the disks of the executors until the driver happens to collect its garbage.
    The setting of the session is put back when the last thread leaves.
    """
    conf, name = spark.conf, spark._jsparkSession.sessionUUID()
    with _lock:
        count, before = _inside.get(name) or (0, conf.get(_FREES, None))
        _inside[name] = count + 1, before
        conf.set(_FREES, "true")
    try:
        yield
    finally:
        with _lock:
            count, before = _inside.pop(name)
            if count > 1:
                _inside[name] = count - 1, before
            elif before is None:
                conf.unset(_FREES)
            else:
                conf.set(_FREES, before)


def store(df: DataFrame, path: str, *folders: str, mode: str = "errorifexists") -> None:
    """Write ``df`` as Parquet, by ``folders`` if there are any; its shuffle files go at once."""
    writer = df.write.mode(mode).option("compression", CODEC)
    with freeing(df.sparkSession):
        (writer.partitionBy(*folders) if folders else writer).parquet(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts lineage without relying on executor memory or disks: a lost executor
    re-reads files. Also pins values of position-dependent expressions.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    store(df, path)
    return spark.read.schema(df.schema).parquet(path)
