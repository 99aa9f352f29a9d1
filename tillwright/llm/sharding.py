"""Sharding by a hierarchical weighted hash tree: region, rack, shard.

A row descends the tree. At every level each child draws ``-ln(u) / weight``
with ``u`` hashed from the key and the child's own name; the smallest draw wins,
so a child gets rows in proportion to its weight. A child whose weight and name
stay as they are keeps its draw: when the weight below one region changes, rows
move only into or out of that region, and within it only into or out of the rack
concerned.

Growth by :func:`grown` hangs the new shard into a region of its own. No draw of
an old child changes, so rows only move into the new shard.

Rows without a key share the key ``null``. Equal keys get equal shards; texts,
extra columns and row order do not matter. Texts that are null count one byte.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwright.llm.columns import draw_bits, let, unit_draw

#: Slices of a shard that are numbered on their own; a slice, not a shard, is one
#: task's work, so raise it with the input (4,096 slices: 65,536 pieces of 16 shards).
SLICES = 1024


@dataclass(frozen=True)
class Leaf:
    shard: int
    region: str
    rack: str
    weight: float = 1.0


def tree(shards: int, racks_per_region: int = 2, shards_per_rack: int = 4) -> tuple[Leaf, ...]:
    """A regular tree of ``shards`` equal leaves, filled rack by rack."""
    out = []
    for n in range(shards):
        rack = n // shards_per_rack
        out.append(Leaf(n, f"region{rack // racks_per_region}", f"rack{rack}"))
    return tuple(out)


def grown(leaves: Sequence[Leaf], weight: float = 1.0) -> tuple[Leaf, ...]:
    """One more shard, in a new region: it takes rows only into itself."""
    n = max((x.shard for x in leaves), default=-1) + 1
    return (*leaves, Leaf(n, f"added{n}", f"added{n}", weight))


def reweighted(leaves: Sequence[Leaf], shard: int, weight: float) -> tuple[Leaf, ...]:
    return tuple(replace(x, weight=weight) if x.shard == shard else x for x in leaves)


def _draw(key: Column, name: str, weight: float) -> Column:
    return -F.log(unit_draw(key, F.lit(name))) / F.lit(float(weight))


def _choose(key: Column, children: dict[str, float], then: dict[str, Column]) -> Column:
    """The descent into the child with the smallest draw; draws are made once per row."""
    names = [n for n, w in sorted(children.items()) if w > 0]
    if not names:
        raise ValueError("a subtree without weight cannot take rows")
    if len(names) == 1:
        return then[names[0]]
    draws = F.array(*[F.struct(_draw(key, n, children[n]).alias("d"), F.lit(i).alias("i"))
                      for i, n in enumerate(names)])
    def below(child: Column) -> Column:
        out = F.when(child == 0, then[names[0]])
        for i, n in enumerate(names[1:], 1):
            out = out.when(child == i, then[n])
        return out

    return let(F.array_min(draws)["i"], below)


def shard_of(key: Column, leaves: Sequence[Leaf]) -> Column:
    """Shard number of ``key`` as a column expression. A weight of 0 takes no rows."""
    regions: dict[str, dict[str, list[Leaf]]] = {}
    for leaf in leaves:
        if leaf.weight > 0:
            regions.setdefault(leaf.region, {}).setdefault(leaf.rack, []).append(leaf)

    def weight(racks: dict[str, list[Leaf]]) -> float:
        return sum(x.weight for leaves in racks.values() for x in leaves)

    below_region = {}
    for region, racks in regions.items():
        below_rack = {}
        for rack, members in racks.items():
            below_rack[rack] = _choose(
                key, {f"shard{x.shard}": x.weight for x in members},
                {f"shard{x.shard}": F.lit(x.shard) for x in members})
        below_region[region] = _choose(
            key, {r: sum(x.weight for x in m) for r, m in racks.items()}, below_rack)
    return _choose(key, {r: weight(racks) for r, racks in regions.items()}, below_region)


def assign(
    docs: DataFrame, leaves: Sequence[Leaf], key: str = "doc_id", name: str = "shard"
) -> DataFrame:
    """``docs`` with the shard of each row; a projection, no shuffle."""
    return docs.withColumn(name, shard_of(F.col(f"`{key}`"), leaves))


def with_slots(
    rows: DataFrame, shard: str = "shard", key: str = "doc_id",
    order: Sequence[str] = (), slices: int = SLICES, name: str = "slot",
) -> DataFrame:
    """Gapless numbers from 0 within each shard.

    A shard is cut into slices by a hash of the key. Slices are numbered on
    their own; the rows before a slice are the sum of a table of counts, which
    has one small row per slice. Order within a slice: key, then ``order``.
    """
    part, before = "__slice", "__before"
    sliced = rows.withColumn(part, F.pmod(
        draw_bits(F.col(f"`{key}`"), F.lit("slot")), F.lit(slices)).cast("int"))
    sizes = sliced.groupBy(shard, part).agg(F.count("*").alias("__n"))
    earlier = Window.partitionBy(shard).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        shard, part, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias(before))
    within = Window.partitionBy(shard, part).orderBy(key, *order)
    numbered = sliced.withColumn("__position", F.row_number().over(within) - 1)
    return (numbered.join(offsets, [shard, part])
            .withColumn(name, (F.col(before) + F.col("__position")).cast("long"))
            .drop(part, before, "__position"))


def write(docs: DataFrame, path: str, leaves: Sequence[Leaf], key: str = "doc_id") -> None:
    """Store ``docs`` as one directory per shard; a large shard gets several files."""
    placed = assign(docs, leaves, key)
    placed.hint("rebalance", F.col("shard")).write.partitionBy("shard").parquet(path)
