"""Near-duplicate documents: MinHash, banding, verification, connected components.

Documents are sets of word shingles. Those with equal sets form one class, kept
under its smallest id. Per class, ``HASHES`` universal hash functions give minima;
minima in bands are bucket keys. :func:`banding` chooses bands so that two classes
at the threshold miss each other in all of them with a probability of at most 1e-4;
at a similarity 0.05 above it, this is below 1e-6.

Pairs inside a bucket are never all emitted. In every bucket the member with most
company over all its buckets leads, and all others are compared with it. What
remains are members of one bucket in different components; they are compared
inside one join, whose condition compares parity marks and which emits hardly more
than true links. Parity marks hold, for each of ``PARITIES`` cells, whether an odd
number of shingles falls into it: common shingles cancel out, so the cells that
differ are a lower bound of the shingles that differ, and no link is lost. Full
sets confirm every link.

Rows without an id link with nothing, unless their set equals another's; texts
that are null, empty or without words have no shingles and link with nothing.
Rows that repeat an id are classed by their own text. Extra columns are not
needed and clashing names cannot occur, as only id and text are read. An empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.llm import tokens
from tillwright.llm.columns import fresh_name
from tillwright.llm.components import components
from tillwright.llm.scratch import Scratch

HASHES = 256
MISS = 1e-4
#: Deviations from the mean beyond which two sketches are taken for dissimilar.
DEVIATIONS = 5.3
PARITIES = 1024
PIECE = 1 << 20
#: Ids of 8 bytes; beyond that many, the texts are joined by shuffle.
BROADCAST_IDS = 1_000_000

_RNG = np.random.default_rng(17)
_A = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_K = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def banding(percent: int) -> tuple[int, int]:
    """(bands, rows): the longest bands that miss a pair at the threshold rarely enough."""
    s = percent / 100
    good = [r for r in range(1, 33) if (1 - s ** r) ** (HASHES // r) <= MISS]
    rows = max(good, default=1)
    return HASHES // rows, rows


def most_marks(percent: int) -> int:
    """How many of the two-bit marks may differ: equal minima agree, others in one case of four."""
    p = 0.75 * (1 - percent / 100)
    return round(HASHES * p + DEVIATIONS * (HASHES * p * (1 - p)) ** 0.5)


def shingle_sets(texts: pa.Array, shingle: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    words = tokens.words(texts, tokens.spaced())
    grams = tokens.grams(words.hashes, shingle)
    out = []
    for start, end in zip(words.bounds[:-1], words.bounds[1:]):
        if end - start >= shingle:
            out.append(np.unique(grams[start:end - shingle + 1]))
        else:
            out.append(tokens.grams(words.hashes[start:end], max(int(end - start), 1)))
    return out


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """For every non-empty set, the minimum of each hash function ``(a x + b) >> 32``."""
    sizes = np.array([len(s) for s in sets], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    keys = np.concatenate(sets) >> np.uint64(32)
    out, held = np.empty((HASHES, len(sets)), np.uint64), np.empty_like(keys)
    with np.errstate(over="ignore"):
        for i in range(HASHES):
            np.multiply(keys, _A[i], out=held)
            held += _B[i]
            np.minimum.reduceat(held, starts, out=out[i])
    return out.T >> np.uint64(32)


def band_keys(mins: np.ndarray, bands: int, rows: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        by_band = mins[:, :bands * rows].reshape(len(mins), bands, rows)
        keys = (tokens.mixed(by_band + _K[:rows]) * _K[:rows]).sum(2, dtype=np.uint64)
        return tokens.mixed(keys + np.arange(bands, dtype=np.uint64) * _K[0]).view(np.int64)


def sketches(mins: np.ndarray) -> np.ndarray:
    """Two bits of every minimum, in eight numbers of 64 bits."""
    marks = (mins & np.uint64(3)).reshape(len(mins), HASHES // 32, 32)
    places = np.arange(0, 64, 2, dtype=np.uint64)
    return np.bitwise_or.reduce(marks << places, axis=2).view(np.int64)


def parities(sets: list[np.ndarray]) -> np.ndarray:
    """For every set, the parity of the shingles in each cell, 64 cells to a number."""
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    cells = (np.concatenate(sets) & np.uint64(PARITIES - 1)).astype(np.int64)
    odd = np.bincount(rows * PARITIES + cells, minlength=len(sets) * PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).reshape(len(sets), PARITIES // 64)


def _lists(values: np.ndarray) -> pa.Array:
    n, width = values.shape
    return pa.ListArray.from_arrays(
        pa.array(np.arange(0, (n + 1) * width, width, dtype=np.int32)),
        pa.array(np.ascontiguousarray(values).ravel()))


SIGNATURE = ("doc_id {id}, digest binary, n_shingles long, bands array<long>, sketch array<long>, "
             "parity array<long>")


def signatures(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Per document with a shingle: digest of its set, set size, band keys, sketch, parities."""
    bands, rows = banding(percent)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in tokens.pieces(batch, "text", PIECE):
                sets = shingle_sets(piece.column("text"), shingle)
                some = [i for i, s in enumerate(sets) if len(s)]
                if not some:
                    continue
                full = [sets[i] for i in some]
                mins = minima(full)
                yield pa.RecordBatch.from_arrays([
                    piece.column("doc_id").take(pa.array(some)),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in full],
                             pa.binary()),
                    pa.array([len(s) for s in full], pa.int64()),
                    _lists(band_keys(mins, bands, rows)), _lists(sketches(mins)), _lists(parities(full)),
                ], ["doc_id", "digest", "n_shingles", "bands", "sketch", "parity"])

    return docs.mapInArrow(sign, SIGNATURE.format(id=docs.schema["doc_id"].dataType.simpleString()))


def full_sets(docs: DataFrame, shingle: int) -> DataFrame:
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in tokens.pieces(batch, "text", PIECE):
                sets = shingle_sets(piece.column("text"), shingle)
                places = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
                yield pa.RecordBatch.from_arrays([
                    piece.column("doc_id"),
                    pa.ListArray.from_arrays(
                        pa.array(places.astype(np.int32)),
                        pa.array(np.concatenate(sets).view(np.int64))),
                ], ["rep", "shingles"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(build, f"rep {kind}, shingles array<long>")


def differing_marks(a: str, b: str) -> Column:
    """In how many marks two sketch columns differ."""
    total = F.lit(0)
    odd = F.lit(0x5555555555555555)
    for k in range(HASHES // 32):
        x = F.get(a, F.lit(k)).bitwiseXOR(F.get(b, F.lit(k)))
        total = total + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(odd))
    return total


def may_link(a: str, b: str, percent: int) -> Column:
    """False only for pairs that cannot be linked; ``a`` and ``b`` end the column names.

    Sets of n and m shingles are linked if at most (n + m) (100 - percent) /
    (100 + percent) shingles are in one of them only.
    """
    cells = F.lit(0)
    for k in range(PARITIES // 64):
        cells = cells + F.bit_count(F.get(f"parity_{a}", F.lit(k)).bitwiseXOR(
            F.get(f"parity_{b}", F.lit(k))))
    total = F.col(f"n_{a}") + F.col(f"n_{b}")
    return cells * (100 + percent) <= total * (100 - percent)


def similar(a: str, b: str, percent: int) -> Column:
    """Exact test on full sets: 100 * common >= percent * all."""
    common = F.size(F.array_intersect(a, b)).cast("long")
    return common * (100 + percent) >= percent * (F.size(a) + F.size(b))


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id is in ``ids``."""
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return docs.join(ids, docs["doc_id"] == ids["rep"], "left_semi")


def classify(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5,
    percent: int = 80, scratch: Scratch | None = None,
) -> DataFrame:
    """One row per document: n_shingles, component_id, kept.

    ``component_id`` is the smallest id reachable over links, and ``kept`` tells
    whether it is the document's own; a row without an id is kept unless it copies
    another.
    """
    scratch = scratch or Scratch(docs.sparkSession, "near-dups")
    docs = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    signed = scratch.write(signatures(docs, shingle, percent), "signatures")
    classes = scratch.write(signed.groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"),
        F.first("bands").alias("bands"), F.first("sketch").alias("sketch"),
        F.first("parity").alias("parity")), "classes")

    members = classes.where("rep IS NOT NULL").select("rep", F.explode("bands").alias("bucket"))
    crowds = members.groupBy("bucket").agg(F.count("*").alias("crowd")).where("crowd > 1")
    shared = scratch.write(members.join(crowds, "bucket"), "shared")
    sets = scratch.write(full_sets(_texts_of(docs, shared.select("rep").distinct()), shingle), "sets")

    links = scratch.write(star_links(shared, classes, sets, percent), "links")
    first = components(links, scratch)
    rest = scratch.write(remaining_links(shared, classes, sets, first, percent), "rest")
    joined = first.select(F.col("node").alias("u"), F.col("component").alias("v")).unionAll(rest)
    found = components(joined, scratch)
    scratch.drop(sets, shared, links)

    of_class = classes.select("digest", "rep").join(
        found, F.col("rep") == F.col("node"), "left").select(
        "digest", F.coalesce("component", "rep").alias("component_id"))
    some = signed.select("doc_id", "digest", "n_shingles").join(of_class, "digest").drop("digest")
    # Documents without shingles carry no signature.
    none = docs.where(~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))).select(
        "doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return some.unionByName(none).withColumn("kept", F.coalesce(
        F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


def _marks(classes: DataFrame, name: str) -> DataFrame:
    return classes.select(F.col("rep").alias(name), *[
        F.col(c).alias(f"{c}_{name}") for c in ("n", "sketch", "parity")])


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets are similar."""
    return (pairs
            .join(sets.select(F.col("rep").alias("u"), F.col("shingles").alias("a")), "u")
            .join(sets.select(F.col("rep").alias("v"), F.col("shingles").alias("b")), "v")
            .where(similar("a", "b", percent)).select("u", "v").distinct())


def star_links(shared: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between the members of a bucket and its most popular member."""
    company = shared.groupBy("rep").agg(F.sum("crowd").alias("company"))
    leaders = shared.select("bucket", "rep").join(company, "rep").groupBy("bucket").agg(
        F.max_by("rep", F.struct("company", "rep")).alias("leader"))
    pairs = shared.join(leaders, "bucket").where("rep <> leader").select(
        F.least("rep", "leader").alias("u"), F.greatest("rep", "leader").alias("v")).distinct()
    hopeful = pairs.join(_marks(classes, "u"), "u").join(_marks(classes, "v"), "v").where(
        (differing_marks("sketch_u", "sketch_v") <= most_marks(percent))
        & may_link("u", "v", percent)).select("u", "v")
    return _confirmed(hopeful, sets, percent)


def remaining_links(
    shared: DataFrame, classes: DataFrame, sets: DataFrame, found: DataFrame, percent: int
) -> DataFrame:
    """Links between members of one bucket that are still in different components."""
    placed = shared.select("bucket", "rep").where("crowd > 2").join(
        found, F.col("rep") == F.col("node"), "left").select(
        "bucket", "rep", F.coalesce("component", "rep").alias("comp"))
    open_ = placed.groupBy("bucket").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("bucket")
    rows = placed.join(open_, "bucket").join(classes.select("rep", "n", "parity"), "rep")
    u, v = (rows.select("bucket", F.col("rep").alias(x), *[
        F.col(c).alias(f"{c}_{x}") for c in ("comp", "n", "parity")]) for x in "uv")
    pairs = u.join(v, "bucket").where(
        (F.col("comp_u") < F.col("comp_v")) & may_link("u", "v", percent)).select("u", "v").distinct()
    return _confirmed(pairs, sets, percent)


def deduplicate(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80,
) -> DataFrame:
    """``docs`` with one row of each group; all columns as they are.

    The row with the smallest id stays, a row without an id only where none of the group has
    one. Rows that repeat an id are rows like all others: equal ones are a group, of which
    one stays. Rows without a word stay. Rows are told apart by a number, which is stored
    with them, so that a repeated task sees the same numbers.
    """
    scratch = Scratch(docs.sparkSession, "dedup")
    row, component = fresh_name(docs, "__row"), "component_id"
    numbered = scratch.write(
        docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    classed = classify(numbered, row, text, shingle, percent).select(
        F.col("doc_id").alias(row), component)
    ids = numbered.select(row, F.col(f"`{key}`").alias("id"))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", row))
    stay = classed.join(ids, row).groupBy(component).agg(first.alias("first")).select(
        F.col(f"first.{row}").alias(row))
    return numbered.join(stay, row, "left_semi").drop(row)
