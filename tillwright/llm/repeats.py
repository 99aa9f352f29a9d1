"""Repeated passages across documents with a sparse suffix array.

Suffixes are kept only at positions that the content selects: of ``SELECT``
neighbouring word 8-grams, the one with the smallest hash. Every passage of
``LENGTH`` words therefore holds a kept suffix whose first ``PREFIX`` words lie
inside the passage, at the same place in all its copies.

The kept suffixes are sorted by fingerprints of their first ``PREFIX`` and
``LENGTH`` words, over range partitions that cut even a passage with a third of
all suffixes into many pieces. Neighbours are compared: equal prefixes in
different documents are candidates, equal long stretches are repeats. Candidates
around which long matches do not cover every stretch of some document are extended
left and right in all documents: all stretches of ``LENGTH`` words around the
prefix are compared. A word is repeated exactly if it lies in a stretch of
``LENGTH`` words that stands in two documents. Pairs of documents are never made.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. Repeats within one document
do not count; rows that share an id count as one document. Null texts, short texts and rows
without an id hold no passage. Copies of a row give one result. Extra columns are
not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwright.llm import tokens
from tillwright.llm.columns import let
from tillwright.llm.scratch import Scratch

LENGTH = 50
GRAM = 8
SELECT = 26
PREFIX = LENGTH - SELECT + 1
PIECE = 2 << 20
BROADCAST_IDS = 1_000_000


def kept_positions(words: tokens.Words) -> tuple[np.ndarray, np.ndarray]:
    """(position, text) of the kept suffixes of texts with a passage's length."""
    firsts = [np.arange(a, b - LENGTH + 1) for a, b in zip(words.bounds[:-1], words.bounds[1:])]
    starts = np.concatenate(firsts) if firsts else np.zeros(0, np.int64)
    if not len(starts):
        return starts.astype(np.int64), starts.astype(np.int64)
    owner = np.repeat(np.arange(len(firsts)), [len(f) for f in firsts])
    sums = tokens.running(words.hashes)
    grams = tokens.stretch(sums, np.arange(len(words.hashes) - GRAM + 1), GRAM)
    least = np.lib.stride_tricks.sliding_window_view(grams, SELECT).argmin(axis=1)
    chosen, first = np.unique(starts + least[starts], return_index=True)
    return chosen, owner[first]


def suffixes(docs: DataFrame) -> DataFrame:
    """prefix, long, doc_id, pos: a row per kept suffix.

    ``long`` is null where fewer than ``LENGTH`` words follow.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in tokens.pieces(batch, "text", PIECE):
                words = tokens.words(piece.column("text"), tokens.spaced())
                at, owner = kept_positions(words)
                if not len(at):
                    continue
                sums = tokens.running(words.hashes)
                fits = at + LENGTH <= words.bounds[owner + 1]
                long = tokens.stretch(sums, np.where(fits, at, 0), LENGTH).view(np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(tokens.stretch(sums, at, PREFIX).view(np.int64)),
                    pa.array(long, mask=~fits), piece.column("doc_id").take(pa.array(owner)),
                    pa.array((at - words.bounds[owner]).astype(np.int32)),
                ], ["prefix", "long", "doc_id", "pos"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(cut, f"prefix long, long long, doc_id {kind}, pos int")


def neighbours(ordered: DataFrame) -> DataFrame:
    """key, lo, hi: runs of equal fingerprints in sorted partitions, with their range of ids.

    Single suffixes are dropped where they stand, except at the ends of a partition,
    whose runs may go on in the next one.
    """
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple] = {}
        first = {"prefix": True, "long": True}
        for batch in batches:
            ids = np.array(batch.column("doc_id").to_pylist())
            for name in ("prefix", "long"):
                column = batch.column(name)
                there = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
                if not len(there):
                    continue
                keys = column.drop_null().to_numpy()
                own = ids[there]
                edges = np.flatnonzero(keys[1:] != keys[:-1]) + 1
                starts = np.concatenate([[0], edges])
                runs = [list(r) for r in zip(
                    keys[starts].tolist(), np.minimum.reduceat(own, starts).tolist(),
                    np.maximum.reduceat(own, starts).tolist(),
                    np.diff(np.append(starts, len(keys))).tolist())]
                last = held.get(name)
                if last and last[0] == runs[0][0]:
                    runs[0] = [last[0], min(last[1], runs[0][1]), max(last[2], runs[0][2]),
                               last[3] + runs[0][3]]
                elif last:
                    runs.insert(0, last)
                held[name] = runs.pop()
                kept = [r for i, r in enumerate(runs) if r[3] > 1 or (i == 0 and first[name])]
                first[name] = first[name] and not runs
                if kept:
                    yield _runs(kept, batch.schema.field("doc_id").type)
        if held:
            yield _runs(list(held.values()), batch.schema.field("doc_id").type)

    kind = ordered.schema["doc_id"].dataType.simpleString()
    return ordered.mapInArrow(compare, f"key long, lo {kind}, hi {kind}")


def _runs(runs: list, kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array([r[0] for r in runs], pa.int64()), pa.array([r[1] for r in runs], kind),
        pa.array([r[2] for r in runs], kind)], ["key", "lo", "hi"])


def _in_two(rows: DataFrame) -> DataFrame:
    """Keys that stand in two documents."""
    return rows.groupBy("key").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where(
        "lo <> hi").select("key")


def stretches_around(texts: DataFrame) -> DataFrame:
    """key, doc_id, start: the stretches of ``LENGTH`` words that hold a given prefix."""
    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in tokens.pieces(batch, "text", PIECE):
                words = tokens.words(piece.column("text"), tokens.spaced())
                sums = tokens.running(words.hashes)
                lists = piece.column("at").to_pylist()
                owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
                at = np.array([p for x in lists for p in x], np.int64) + words.bounds[owner]
                starts = at[:, None] - np.arange(SELECT)
                good = ((starts >= words.bounds[owner][:, None])
                        & (starts + LENGTH <= words.bounds[owner + 1][:, None]))
                starts, first = np.unique(starts[good], return_index=True)
                owner = np.broadcast_to(owner[:, None], good.shape)[good][first]
                yield pa.RecordBatch.from_arrays([
                    pa.array(tokens.stretch(sums, starts, LENGTH).view(np.int64)),
                    piece.column("doc_id").take(pa.array(owner)),
                    pa.array((starts - words.bounds[owner]).astype(np.int32)),
                ], ["key", "doc_id", "start"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(extend, f"key long, doc_id {kind}, start int")


def spans(
    docs: DataFrame, key: str = "doc_id", text: str = "text", scratch: Scratch | None = None,
) -> DataFrame:
    """doc_id, start_word, n_words: maximal spans of repeated words."""
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "repeats")
    docs = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).where(
        "doc_id IS NOT NULL")
    kept = scratch.write(suffixes(docs), "suffixes")
    pieces = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = kept.repartitionByRange(pieces, "prefix", "long", "doc_id", "pos").sortWithinPartitions(
        "prefix", "long", "doc_id", "pos")
    repeated = scratch.write(_in_two(neighbours(ordered)), "repeated")

    again = kept.join(repeated.withColumnRenamed("key", "prefix"), "prefix", "left_semi")
    far = repeated.withColumnRenamed("key", "long").withColumn("far", F.lit(True))
    matched = scratch.write(again.join(far, "long", "left").select(
        "doc_id", "pos", "prefix", F.coalesce("far", F.lit(False)).alias("far")).distinct(), "matched")
    scratch.drop(kept)

    # A prefix is extended in all documents if in one of them a stretch around it is not
    # covered by long matches. A stretch that a document lacks is thus compared in every
    # document that holds it, also where long matches cover it.
    open_ = matched.withColumn("covered", _covered()).where("NOT covered").select("prefix").distinct()
    wanted = scratch.write(matched.join(open_, "prefix", "left_semi").groupBy("doc_id").agg(
        F.sort_array(F.collect_list("pos")).alias("at")), "ends")

    texts = _rows_with(docs, wanted.select("doc_id")).dropDuplicates(["doc_id", "text"])
    around = scratch.write(stretches_around(texts.join(wanted, "doc_id")), "around")
    # Stored, so that the join with it shuffles both sides and splits a hot key's rows.
    twice = scratch.write(_in_two(around.select(
        "key", F.col("doc_id").alias("lo"), F.col("doc_id").alias("hi"))), "twice")
    starts = around.join(twice, "key", "left_semi").select("doc_id", "start").unionAll(
        matched.where("far").select("doc_id", F.col("pos").alias("start")))
    return _joined(starts)


def _covered():
    """Do long matches without a gap cover all stretches that hold the prefix of this one?"""
    by_doc = Window.partitionBy("doc_id").orderBy("pos")
    long = F.when(F.col("far"), F.col("pos"))
    before = F.max(long).over(by_doc.rangeBetween(Window.unboundedPreceding, 1 - SELECT))
    after = F.min(long).over(by_doc.rangeBetween(2 - SELECT, 0))
    return F.col("far") & F.coalesce(after - before <= LENGTH, F.lit(False))


def _rows_with(docs: DataFrame, ids: DataFrame) -> DataFrame:
    ids = ids.distinct()
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return docs.join(ids, "doc_id", "left_semi")


def _joined(starts: DataFrame) -> DataFrame:
    """Stretches that overlap or touch become one span; a document's own list is merged."""
    s = F.col("s")
    listed = starts.groupBy("doc_id").agg(F.sort_array(F.collect_set("start")).alias("s"))
    heads = F.filter(F.sequence(F.lit(0), F.size("s") - 1), lambda i: F.coalesce(
        F.get(s, i) - F.get(s, i - 1) > LENGTH, F.lit(True)))
    merged = let(heads, lambda h: F.transform(h, lambda at, k: F.struct(
        F.get(s, at).alias("start"),
        (F.get(s, F.coalesce(F.get(h, k + 1), F.size("s")) - 1) + LENGTH).alias("end"))))
    return listed.select("doc_id", F.explode(merged).alias("x")).select(
        "doc_id", F.col("x.start").cast("long").alias("start_word"),
        (F.col("x.end") - F.col("x.start")).cast("long").alias("n_words"))


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the documents that hold a repeated passage, all columns kept."""
    hit = spans(docs, key, text).select(F.col("doc_id").alias("__hit")).distinct()
    return docs.join(hit, docs[f"`{key}`"] == hit["__hit"], "left_anti")
