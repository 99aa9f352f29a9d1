"""Mixing sources to target weights by subset-sum budget fitting.

Every source gets a share of all words by weight, at most ``MAX_PASSES`` times
its own words. Whole passes over a source come first. For the budget that is
left, documents are counted by exact length; a proportional part of every length
is taken, and a bounded knapsack over the lengths closes the gap to the word.
Which documents of a length are taken is decided by a seeded draw per document,
so reruns agree, wherever and in whatever order tasks run.

Null texts and texts without words have size 0 and take nothing. A null source
is a source of its own, last in order. Rows with equal id, source and size are
interchangeable. Extra columns are kept by :func:`mix`, whose own column gets an
underscore in front when it clashes. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwright.llm.columns import draw_bits, fresh_name, word_count
from tillwright.llm.scratch import Scratch

WEIGHTS = (5.0, 2.0, 1.0)
MAX_PASSES = 3
SEED = "mix-1"
#: Documents of one source and length are ranked in this many slices of the draw.
SLICE_BITS = 8


def sizes(docs: DataFrame, key: str, text: str, source: str, seed: str = SEED) -> DataFrame:
    """The few bytes per document that mixing needs."""
    draw = draw_bits(F.col(f"`{key}`"), F.lit(seed))
    return docs.select(
        F.col(f"`{key}`").alias("doc_id"), F.col(f"`{source}`").alias("source"),
        F.when(F.col(f"`{source}`").isNull(), F.lit("n")).otherwise(
            F.concat(F.lit("s"), F.col(f"`{source}`"))).alias("skey"),
        word_count(F.col(f"`{text}`")).alias("size"), draw.alias("draw"),
    )


def targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS) -> DataFrame:
    """One row per source: its words and its target.

    A source is full at ``MAX_PASSES`` times its words. Sources in order of the
    level (words per unit of weight) at which they are full: one is full exactly
    if the level of all that are not full before it exceeds its own. Windows over
    the table of sources, which has one small row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    per = sized.groupBy("skey", "source").agg(F.sum("size").alias("source_size"))
    rank = (F.row_number().over(by_name) - 1) % len(weights)
    per = per.withColumn("weight", F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (rank + 1).cast("int")))
    cap = MAX_PASSES * F.col("source_size")
    by_level = Window.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last())
    full_before = F.coalesce(F.sum(cap).over(
        by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weight_after = F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(Window.partitionBy())
    per = per.withColumn("level", (total - full_before) / weight_after)
    per = per.withColumn("full", cap <= F.col("level") * F.col("weight"))
    # Levels fall after the first source that is not full; its level holds for all of them.
    level = F.max(F.when(~F.col("full"), F.col("level"))).over(Window.partitionBy())
    return per.select(
        "skey", "source", "source_size",
        F.when(F.col("full"), cap.cast("double")).otherwise(
            level * F.col("weight")).alias("target"))


def plan_source(lengths: np.ndarray, counts: np.ndarray, target: float) -> tuple[int, np.ndarray]:
    """Whole passes, and how many documents of each length are taken once more."""
    total = int((lengths * counts).sum())
    taken = np.zeros(len(lengths), np.int64)
    if total == 0:
        return 0, taken
    passes = min(int(target // total), MAX_PASSES)
    budget = int(np.floor(target - passes * total + 0.5))
    if passes == MAX_PASSES or budget <= 0:
        return passes, taken
    usable = lengths > 0
    taken[usable] = np.floor(counts[usable] * (budget / total)).astype(np.int64)
    rest = budget - int((taken * lengths).sum())
    # One more of each length, the longest first, while more remains than the
    # knapsack should settle: a few long documents and some thousand words.
    margin = 4 * int(lengths.max()) + 4096
    for i in np.argsort(-lengths, kind="stable"):
        if usable[i] and taken[i] < counts[i] and lengths[i] <= rest - margin:
            taken[i] += 1
            rest -= int(lengths[i])
    taken += knapsack(lengths, np.where(usable, counts - taken, 0), rest)
    return passes, taken


def knapsack(lengths: np.ndarray, spare: np.ndarray, budget: int) -> np.ndarray:
    """Counts ``<= spare`` whose total length is as near ``budget`` as possible.

    Bounded subset sum: each length is split into lots of 1, 2, 4, ... documents;
    ``first[s]`` is the lot that first made the sum ``s``. The sum without that
    lot was made by earlier lots, so walking back never uses a lot twice.
    """
    out = np.zeros(len(lengths), np.int64)
    open_ = [i for i in np.argsort(-lengths, kind="stable") if spare[i] > 0 and lengths[i] > 0]
    if budget <= 0 or not open_:
        return out
    top = 2 * budget  # anything above is further from the budget than nothing at all
    first = np.full(top + 1, -1, np.int64)
    made = np.zeros(top + 1, bool)
    made[0] = True
    lots: list[tuple[int, int]] = []
    for i, many in _lots(open_, spare):
        weight = int(lengths[i]) * many
        if weight > top:
            continue
        new = np.zeros(top + 1, bool)
        new[weight:] = made[:-weight]
        new &= ~made
        first[new] = len(lots)
        lots.append((i, many))
        made |= new
        if made[budget]:
            break
    sums = np.flatnonzero(made)
    best = int(sums[np.argmin(np.abs(sums - budget))])
    while best:
        i, many = lots[first[best]]
        out[i] += many
        best -= int(lengths[i]) * many
    return out


def _lots(order: Sequence[int], spare: np.ndarray) -> Iterator[tuple[int, int]]:
    for i in order:
        left, many = int(spare[i]), 1
        while left > 0:
            yield i, min(many, left)
            left -= many
            many *= 2


def plan(sized: DataFrame, weights: Sequence[float] = WEIGHTS) -> DataFrame:
    """Per source and length: passes, and the number of documents taken once more.

    One task plans one source from its table of lengths, whose size is bounded
    by the number of different lengths, not by the number of documents.
    """
    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("size", ignore_index=True)
        passes, taken = plan_source(
            pdf["size"].to_numpy(), pdf["n"].to_numpy(), float(pdf["target"].iloc[0]))
        return pdf.assign(passes=passes, chosen=taken)[
            ["skey", "size", "source_size", "target", "passes", "chosen"]]

    by_length = sized.groupBy("skey", "size").agg(F.count("*").alias("n"))
    facts = targets(sized, weights).drop("source")
    return by_length.join(facts, "skey").groupBy("skey").applyInPandas(
        fit, "skey string, size long, source_size long, target double, passes long, chosen long")


def assign(sized: DataFrame, weights: Sequence[float] = WEIGHTS) -> DataFrame:
    """doc_id, size, source_size, target, copies: how often a document is taken."""
    cell = F.shiftright("draw", 52 - SLICE_BITS).alias("slice")
    rows = sized.select("doc_id", "skey", "size", "draw", cell)
    cells = rows.groupBy("skey", "size", "slice").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("skey", "size").orderBy("slice").rowsBetween(
        Window.unboundedPreceding, -1)
    cells = cells.join(plan(sized, weights), ["skey", "size"]).withColumn(
        "before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    within = Window.partitionBy("skey", "size", "slice").orderBy("draw", "doc_id")
    ranked = rows.withColumn("position", F.row_number().over(within) - 1)
    picked = (F.col("before") + F.col("position")) < F.col("chosen")
    return ranked.join(cells, ["skey", "size", "slice"]).select(
        "doc_id", "skey", "size", "source_size", "target",
        (F.col("passes") + picked.cast("long")).alias("copies"))


def report(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[float] = WEIGHTS, seed: str = SEED, scratch: Scratch | None = None,
) -> DataFrame:
    """One row per document: what the mix takes of it. Texts are read once."""
    scratch = scratch or Scratch(docs.sparkSession, "mixing")
    sized = scratch.write(sizes(docs, key, text, source, seed), "sizes")
    return assign(sized, weights).withColumn("taken", F.col("size") * F.col("copies"))


def mix(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[float] = WEIGHTS, seed: str = SEED, repeat: bool = True,
) -> DataFrame:
    """The mixed documents: each row as often as the mix takes it.

    With ``repeat=False`` a taken document appears once, and column ``copies``
    says how often it is read. Documents are matched by their id, size and source.
    """
    taken = report(docs, key, text, source, weights, seed)
    # Rows that share id, source and size: their copies are dealt out by position.
    deal = Window.partitionBy("__id", "__skey", "__size")
    sized = docs.withColumns({
        "__id": F.col(f"`{key}`"), "__size": word_count(F.col(f"`{text}`")),
        "__skey": F.when(F.col(f"`{source}`").isNull(), F.lit("n")).otherwise(
            F.concat(F.lit("s"), F.col(f"`{source}`")))})
    left = sized.withColumn("__n", F.row_number().over(deal.orderBy(F.xxhash64(f"`{text}`"))))
    right = taken.select(
        F.col("doc_id").alias("__id"), F.col("skey").alias("__skey"), F.col("size").alias("__size"),
        "copies").withColumn("__n", F.row_number().over(deal.orderBy(F.desc("copies"))))
    same = (left["__id"].eqNullSafe(right["__id"]) & (left["__skey"] == right["__skey"])
            & (left["__size"] == right["__size"]) & (left["__n"] == right["__n"]))
    out = left.join(right, same).where(right["copies"] > 0)
    columns: list[Column] = [left[f"`{c}`"] for c in docs.columns]
    if repeat:
        return out.withColumn("__copy", F.explode(F.sequence(F.lit(1), right["copies"]))).select(
            *columns)
    return out.select(*columns, right["copies"].alias(fresh_name(docs, "copies")))
