"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm.scratch import Scratch


def large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of its neighbourhood."""
    both = edges.select(F.col("u").alias("n"), F.col("v").alias("x")).unionAll(
        edges.select(F.col("v").alias("n"), F.col("u").alias("x")))
    least = both.groupBy("n").agg(F.min("x").alias("m"))
    return both.join(least, "n").where("x > n").select(
        F.col("x").alias("u"), F.least("m", "n").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them; needs u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v) but the smallest of a component.

    The component is its smallest node. Neighbourhoods are never collected: each
    step takes a minimum per node, pre-aggregated in the tasks, and a join whose
    skewed partitions are split at run time. Every step is written to the shared
    folder. Loops and repeated edges do not matter; no edges give no rows.
    """
    now = scratch.write(edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = _checksum(now)
    while state[0]:
        then = scratch.write(small_star(large_star(now)), "star")
        scratch.drop(now)
        before, state, now = state, _checksum(then), then
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _checksum(edges: DataFrame) -> tuple:
    """Count and sums that change with any edge; one row per task reaches the driver."""
    mark = F.xxhash64("u", "v")
    return tuple(edges.agg(
        F.count("*"), F.sum(F.shiftright(mark, 32)),
        F.sum(mark.bitwiseAND(F.lit(0xFFFFFFFF)))).first())
