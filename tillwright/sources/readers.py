"""File readers: enforced schema, header only, reconciliation, side-car schema."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

SIDECAR = "_schema"
# Text is neither trimmed nor changed: null is an empty field, empty text is quoted.
CSV_TEXT = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
# An empty field is read as the null mark, which must not be the empty text.
_CSV_NULLS = {"nullValue": "\u0000", "emptyValue": ""}
MONTH = "transaction_month"  # directory column of tables stored by month


def read_csv(
    spark: SparkSession, path: str, schema: StructType | None = None, header: bool = True
) -> DataFrame:
    """CSV file, directory or glob. With a schema, columns bind by position.

    A header that names other columns than the schema is an error. Without a
    schema every column is text: nothing is inferred, so the files are read once
    and not twice. Text comes back as :func:`sinks.write_csv` wrote it.
    """
    reader = spark.read.options(header=header, **CSV_TEXT, **_CSV_NULLS)
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", not header)
    return reader.csv(path)


def read_parquet(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def read_with_sidecar(spark: SparkSession, path: str) -> DataFrame:
    """Parquet table read with the schema stored next to it, so no footer is merged."""
    schema = spark.read.parquet(f"{path}/{SIDECAR}").schema
    return spark.read.schema(schema).parquet(path).drop(MONTH)


def read_stored(spark: SparkSession, path: str, keep_month: bool = False) -> DataFrame:
    """A table kept by this package, read with its side-car schema.

    So a table without rows reads as such. The directory-only column is dropped,
    unless the caller wants to choose months by it.
    """
    schema = spark.read.parquet(f"{path}/{SIDECAR}").schema
    df = spark.read.schema(schema.add(MONTH, StringType())).parquet(path)
    return df if keep_month else df.drop(MONTH)


def reconcile(df: DataFrame, expected: StructType, partitions: int | None = None) -> DataFrame:
    """Bring ``df`` to ``expected`` by column name.

    Expected columns are cast (null where the text does not fit), missing ones
    are added as typed nulls, unknown ones are kept after them.
    ``partitions`` spreads the rows of an unsplittable input.
    """
    wanted = [
        (F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in df.columns
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in expected.fields
    ]
    extra = [F.col(f"`{c}`") for c in df.columns if c not in expected.fieldNames()]
    out = df.select(*wanted, *extra)
    return out.repartition(partitions) if partitions else out


def read_any(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    strategy: Callable[[DataFrame], DataFrame] | None = None,
    multiline: bool = False,
) -> DataFrame:
    """Reader chosen by extension: ``.csv`` or ``.json``, else ``ValueError``.

    JSON is one object per line, which Spark can split; ``multiline`` reads
    files holding one JSON array. ``strategy`` is applied to what was read.
    """
    kind = path.rstrip("/*").rsplit(".", 1)[-1].lower()
    if kind == "csv":
        df = read_csv(spark, path, schema)
    elif kind == "json":
        reader = spark.read.option("multiLine", multiline)
        df = (reader.schema(schema) if schema is not None else reader).json(path)
    else:
        raise ValueError(f"unsupported file type: {kind}")
    return strategy(df) if strategy else df


def read_latest_csv(
    spark: SparkSession,
    directory: str,
    expected: StructType,
    partitions: int | None = None,
) -> DataFrame | None:
    """Newest CSV file of a directory in the expected schema, None if it is empty."""
    from tillwright.sources import manifest

    path = manifest.newest(manifest.listing(spark, directory, "*.csv"))
    if path is None:
        return None
    return reconcile(read_csv(spark, path), expected, partitions)


def text_schema(names: list[str]) -> StructType:
    schema = StructType()
    for name in names:
        schema = schema.add(name, StringType())
    return schema
