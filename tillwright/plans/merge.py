"""Merge one hourly drop: transactions with their agents and branches."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.operators.lookup import lookup
from tillwright.operators.shaping import repair_headers
from tillwright.sources import manifest, readers, schemas, sinks


def merge_group(
    transactions: DataFrame, agents: DataFrame, branches: DataFrame, group: str | int
) -> DataFrame:
    """Left joins, so that a sale without a known agent or branch is kept."""
    sold = repair_headers(transactions)
    merged = lookup(sold, repair_headers(agents), "sales_agent_id", "left")
    merged = lookup(merged, branches, "branch_id", "left")
    return merged.withColumn("group", F.lit(group))


def merge_drop(
    spark: SparkSession, files: DataFrame, layouts: Mapping | None = None
) -> DataFrame | None:
    """Read and merge the files chosen by ``manifest.latest_complete_group``; None if there are none.

    ``files`` has one row per kind (three rows), so collecting it is bounded.
    """
    chosen = {row["kind"]: row for row in files.collect()}
    if not chosen:
        return None
    read = {
        kind: readers.read_any(spark, row["path"], (layouts or {}).get(kind))
        for kind, row in chosen.items()
    }
    number = next(iter(chosen.values()))["group_number"]
    return merge_group(
        read["sales_transactions"], read["sales_agents"], read["branches"], f"group{number}")


def raw_path(base: str, run_stamp: str) -> str:
    """``run_stamp`` is ``yyyyMMddHHmmss``; its day names the directory."""
    day = f"{run_stamp[:4]}-{run_stamp[4:6]}-{run_stamp[6:8]}"
    return f"{base}/raw_sales_transactions_{day}"


def land(
    spark: SparkSession, drops: str, base: str, run_stamp: str, as_of: Column,
    max_age: str = "1 hour",
) -> str | None:
    """Merge the newest complete drop below ``drops`` into the raw layer below ``base``.

    Columns come in the order of ``schemas.RAW``, which readers of the layer bind to.
    Returns the directory, or None if no drop is complete.
    """
    files = manifest.listing(spark, drops, "*.csv")
    merged = merge_drop(spark, manifest.latest_complete_group(files, as_of, max_age))
    if merged is None:
        return None
    raw = readers.reconcile(merged, schemas.RAW).select(*schemas.RAW.fieldNames())
    sinks.write_csv(raw, raw_path(base, run_stamp))
    return raw_path(base, run_stamp)
