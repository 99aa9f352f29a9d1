"""External tables over files that are already there."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType


def create_external(
    spark: SparkSession,
    database: str,
    tables: Mapping[str, tuple[StructType, str]],
    source: str = "csv",
    location: str | None = None,
) -> None:
    """Declare ``database.name`` for every ``name -> (schema, location)``.

    The DDL is generated from the schemas the writers use, so a table cannot be
    out of step with its files. Dropping such a table leaves the files alone.
    ``location`` is the database's own folder, by default below the warehouse.
    """
    place = f"LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} {place}")
    options = "OPTIONS (header 'true')" if source == "csv" else ""
    for name, (schema, location) in tables.items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        spark.sql(
            f"CREATE TABLE {database}.{name} ({columns}) USING {source} {options} "
            f"LOCATION '{location}'"
        )
