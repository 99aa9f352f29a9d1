"""A training corpus in five stages, from the operators of ``tillwright.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written and read again as the next stage's ``docs``. All but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillwright.llm import decontamination, mixing, near_dups, quality_classifier, sharding
from tillwright.llm.scratch import Scratch

SHARDS = 16


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents that it rejects go."""
    model = quality_classifier.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_classifier.accept(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: one document of each group stays (five words, 0.8)."""
    return near_dups.deduplicate(docs, shingle=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents with a benchmark passage go."""
    return decontamination.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing sources to target weights: documents as often as the mix takes them."""
    return mixing.mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sharding: every document with its shard and its gapless place in it."""
    placed = sharding.assign(docs, sharding.tree(SHARDS))
    return sharding.with_slots(placed, order=("source", "text"))


STAGES = [
    ("quality classifier", quality),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: The classifier and the knapsack cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; the result is not stored."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
