"""The operators applied to whole tables, one query each, and their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.llm import (
    alignment, conversations, decontamination, mixing, near_dups, quality_classifier, quality_rules,
    repeats, sentencepieces, sharding, toxicity, training_order, warc,
)
from tillwright.llm import reference_sql as sql
from tillwright.llm.scratch import Scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLES[fn.__name__] = oracle
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(sql.DECONTAMINATION)
def op1_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    report = decontamination.judged(docs, table(spark, sf_dir, "benchmark"))
    return report.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@query()
def op2_training_order(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = Scratch(spark, "training").path("shards")
    training_order.write(docs, path)
    return training_order.read(spark, path).select(
        "slot", "shard", "doc_id", "part", "n_tokens",
        F.crc32("tokens").alias("tokens_crc32"))


@query(sql.REPEATS)
def op3_repeated_passages(spark, sf_dir):
    return repeats.spans(table(spark, sf_dir, "documents"))


@query(sql.SHARDING)
def op4_sharding(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    leaves = sharding.tree(16)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.lit("key").alias("law"))
    placed = sharding.assign(rows, leaves)
    placed = sharding.assign(placed, sharding.grown(leaves), name="grown_shard")
    return sharding.with_slots(placed, order=("text_crc32", "size"))


@query(sql.QUALITY_RULES)
def op5_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.assess(docs).drop("text").withColumn(
        "failed_rules", F.array_join("failed_rules", ","))


@query()
def op6_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"))
    return quality_classifier.classify(docs, model).select(
        "doc_id", quality_classifier.held_out(F.col("doc_id")).alias("held_out"),
        "score", "predicted")


@query(sql.WARC)
def op7_warc(spark, sf_dir):
    scratch = Scratch(spark, "archives")
    path = scratch.path("warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    return warc.pages(spark, path, scratch=scratch).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


@query()
def op8_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.classify(docs, model).select(
        "doc_id", quality_classifier.held_out(F.col("doc_id")).alias("held_out"),
        "score", "predicted", F.slice("evidence", 1, 3).alias("evidence"), "blocks_skipped")


@query(sql.NEAR_DUPLICATES)
def op9_near_duplicates(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return near_dups.classify(docs, shingle=3, percent=85)


@query()
def op10_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return mixing.report(docs).select("doc_id", "size", "source_size", "target", "taken")


@query()
def op11_alignment(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    files = alignment.Tokenizers.read()
    found = alignment.align(docs, files, columns=["doc_id"])
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    stored = Scratch(spark, "alignment").write(found.select(
        "doc_id", *alignment.COUNTS, digest.alias("groups_sha256"), "pairs"), "aligned")
    return alignment.judged(stored, files)


@query()
def op12_sentencepieces(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = sentencepieces.encode(docs, columns=["doc_id"])
    covered = F.aggregate(F.arrays_zip("begins", "ends"), F.lit(0).cast("long"),
                          lambda n, s: n + s["ends"] - s["begins"])
    rows = found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
                        covered.alias("source_bytes"), "ids")
    return sentencepieces.decode(rows).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"),
        "source_bytes")


@query()
def op13_conversations(spark, sf_dir):
    rows = conversations.damaged(table(spark, sf_dir, "conversations"))
    return conversations.repair(rows, Scratch(spark, "conversations"))
