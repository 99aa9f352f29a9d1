"""CSV intake that keeps an account of what it could not read.

:func:`intake` reads files as text, casts every column, and stores one table: the typed
columns, the texts that did not fit (``rejected``), and the whole line where its number
of fields is wrong (``malformed``). Nothing is read twice and nothing is lost; readers
open only the columns they need, so :func:`accepted` costs nothing for the ledger and
:func:`ledger` does not read the typed columns.

A text is rejected if it is there and its cast is null; an empty field is a null and no
reject, an empty text (quoted) is one where the type has no empty value. A malformed line is
no row, as its fields may stand in other columns. A column that the files lack is null, one that is
not expected stays as text. Files that differ in their header are an error. Empty
files and files with a header only give an empty table. A column of the files that has the name
of one of the three added ones is an error.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tillwright.sources import readers

REJECTED = "rejected"      # array of (column, value)
MALFORMED = "malformed"    # the line, or null
FILE = "source_file"
ADDED = (REJECTED, MALFORMED, FILE)


@dataclass(frozen=True)
class Intake:
    """Counts of one intake, taken while it was written."""

    rows_in: int
    malformed: int
    rejected: dict[str, int]   # by expected column that the files have

    @property
    def accepted(self) -> int:
        return self.rows_in - self.malformed


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """All columns of CSV files as text, with the line itself where its fields do not match."""
    names = readers.read_csv(spark, path).columns
    clash = {n.lower() for n in names} & set(ADDED)
    if clash:
        raise ValueError(f"columns of the intake itself: {sorted(clash)}")
    schema = readers.text_schema(names).add(MALFORMED, StringType())
    # Every column is parsed even if a caller wants a few: a line is malformed or not by itself.
    return (spark.read.options(header=True, columnPruning=False, columnNameOfCorruptRecord=MALFORMED,
                               **readers.CSV_TEXT, **readers._CSV_NULLS)
            .schema(schema).option("enforceSchema", False).csv(path)
            .withColumn(FILE, F.col("_metadata.file_path")))


def _misfit(name: str, kind) -> Column:
    text = F.col(f"`{name}`")
    return text.isNotNull() & text.try_cast(kind).isNull()


def typed(lines: DataFrame, expected: StructType) -> DataFrame:
    """Lines in the expected schema, with the texts that did not fit beside them."""
    known = [f for f in expected.fields if f.name in lines.columns]
    misfits = [
        F.when(_misfit(f.name, f.dataType), F.struct(
            F.lit(f.name).alias("column"), F.col(f"`{f.name}`").alias("value")))
        for f in known if not isinstance(f.dataType, StringType)
    ]
    none = F.array().cast("array<struct<column:string,value:string>>")
    found = F.filter(F.array(*misfits), lambda m: m.isNotNull()) if misfits else none
    rejected = F.when(F.col(MALFORMED).isNull(), found).otherwise(none).alias(REJECTED)
    own = [F.col(f"`{c}`") for c in lines.columns if c not in ADDED]
    return readers.reconcile(lines.select(*own, rejected, MALFORMED, FILE), expected)


def intake(spark: SparkSession, path: str, expected: StructType, target: str) -> Intake:
    """Read ``path``, store it at ``target``, and count in the same pass.

    The counts are taken above the write, in its only stage; a task that is repeated
    counts once. :func:`counts` gives the same from the stored table.
    """
    rows = typed(read_lines(spark, path), expected)
    columns = [f.name for f in expected.fields]
    seen = Observation()
    per_column = [F.count_if(F.array_contains(F.col(REJECTED)["column"], c)).alias(f"r{i}")
                  for i, c in enumerate(columns)]
    rows.observe(seen, F.count("*").alias("rows_in"), F.count(MALFORMED).alias("malformed"),
                 *per_column).write.mode("overwrite").parquet(target)
    got = seen.get
    return Intake(got["rows_in"], got["malformed"],
                  {c: got[f"r{i}"] for i, c in enumerate(columns)})


def accepted(spark: SparkSession, target: str) -> DataFrame:
    """Rows of an intake in the expected columns; texts that did not fit are null."""
    return spark.read.parquet(target).where(F.col(MALFORMED).isNull()).drop(*ADDED)


def ledger(spark: SparkSession, target: str, key: Sequence[str] = ()) -> DataFrame:
    """One row per rejected text, and per malformed line (column null).

    ``key`` are columns of the row that go along; they are null for malformed lines.
    """
    table = spark.read.parquet(target)
    whole = F.col(MALFORMED).isNotNull()
    line = F.array(F.struct(F.lit(None).cast("string").alias("column"), F.col(MALFORMED).alias("value")))
    return table.where(whole | (F.size(REJECTED) > 0)).select(
        FILE, *[F.when(~whole, F.col(f"`{c}`")).alias(c) for c in key],
        F.explode(F.when(whole, line).otherwise(F.col(REJECTED))).alias("reject"),
    ).select(FILE, *[F.col(f"`{c}`") for c in key],
             F.col("reject.column").alias("rejected_column"), F.col("reject.value").alias("value"))


def counts(spark: SparkSession, target: str) -> DataFrame:
    """Rejected texts by column, malformed lines under null."""
    return ledger(spark, target).groupBy("rejected_column").agg(F.count("*").alias("rows"))
