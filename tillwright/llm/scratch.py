"""Tables written in the middle of a job, in the shared folder the cluster names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillwright.sources import workspace


class Scratch:
    """Intermediate tables of one job.

    A written table cuts lineage: a lost executor re-reads files of the shared
    folder. ``drop`` removes tables that nothing reads any more; what the job
    returns may still read the others, whose folder the caller can drop by
    :meth:`close` once the result is stored.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = workspace.fresh_path(spark, name)
        self._name = self.base.rsplit("/", 1)[-1]  # the same in any spelling of the path
        self._written = 0

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def path(self, name: str) -> str:
        self._written += 1
        return f"{self.base}/{self._written:03d}-{name}"

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
                if f"/{self._name}/" in folder:
                    self._delete(folder)

    def close(self) -> None:
        self._delete(self.base)

    def _delete(self, path: str) -> None:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)
