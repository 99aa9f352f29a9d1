"""Benchmark decontamination with suffix arrays over the training text.

The documents a task reads are cut into shards of a few megabytes. A shard gets a
suffix array: its word positions sorted by the words that follow, as deep as a
window is long. Every window of every benchmark item, that is every item suffix
cut at the window length, is looked up by binary search, which gives all places
of the shard where it stands. Matches that continue each other are joined into
the longest verbatim matches.

The benchmark travels to the tasks in blocks of a bounded number of bytes, each
block in a pass of its own over the documents. No pass shuffles, so neither a
passage that stands in a third of all documents nor a hot key moves any row.

Words are ``[0-9a-z]`` and all characters above ASCII, after lower-casing A-Z. An
item with fewer words than a window is one window; one without words matches
nothing. Null texts have no words. Rows are judged one by one: repeated rows,
null ids and extra columns do not matter. Items that share an id count once, an
item without an id is named ``null``. Empty tables give empty or clean results.
A column of the result replaces an input column of the same name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwright.llm import tokens

WINDOW = 10
SHARD_BYTES = 4 << 20
BLOCK_BYTES = 8 << 20

MATCH = T.StructType([
    T.StructField("item_id", T.StringType()), T.StructField("item_word", T.LongType()),
    T.StructField("doc_word", T.LongType()), T.StructField("n_words", T.LongType())])
STATE = [
    T.StructField("__n_words", T.LongType()),
    T.StructField("__n_hit", T.LongType()),
    T.StructField("__hits", T.ArrayType(T.LongType())),     # bounds of hit word ranges
    T.StructField("__items", T.ArrayType(T.StringType())),
]
_STATE_NAMES = [f.name for f in STATE]


@dataclass
class Windows:
    """Distinct benchmark windows of one length, and where each of them stands."""

    words: np.ndarray   # (windows, length) word hashes
    first: np.ndarray   # places[first[w]:first[w + 1]] belong to window w
    item: np.ndarray    # per place: index of the item
    start: np.ndarray   # per place: word of the item at which it begins


def windows(texts: pa.Array, window: int) -> list[Windows]:
    found = tokens.words(texts, tokens.alphanumeric())
    by_length: dict[int, list[tuple[int, int]]] = {}
    for item, (start, end) in enumerate(zip(found.bounds[:-1], found.bounds[1:])):
        length = min(window, int(end - start))
        for at in range(int(start), int(end) - length + 1 if length else int(start)):
            by_length.setdefault(length, []).append((item, at))
    out = []
    for length, places in sorted(by_length.items()):
        item, at = np.array(places, np.int64).T
        rows = found.hashes[at[:, None] + np.arange(length)]
        distinct, which = np.unique(rows, axis=0, return_inverse=True)
        order = np.argsort(which.ravel(), kind="stable")
        first = np.searchsorted(which.ravel()[order], np.arange(len(distinct) + 1))
        out.append(Windows(distinct, first, item[order], (at - found.bounds[item])[order]))
    return out


class SuffixArray:
    """Word positions of many texts, sorted by the next ``depth`` words.

    Words are numbered; 0 ends a text, so no match runs from one text into the
    next. The order is found by sorting ranks: each round packs the ranks of as
    many consecutive stretches as fit into 63 bits.
    """

    def __init__(self, found: tokens.Words, depth: int):
        codes, names = pd.factorize(found.hashes)
        self._by_name = np.argsort(names)
        self._names = names[self._by_name]
        self.owners = found.owners()
        self.places = np.arange(len(codes)) + self.owners
        size = len(codes) + len(found.bounds)
        self.codes = np.zeros(size + depth, np.int64)
        self.codes[self.places] = codes + 1
        self.order = self._sorted(self.codes[:size], depth)

    @staticmethod
    def _sorted(codes: np.ndarray, depth: int) -> np.ndarray:
        rank, span = codes, 1
        order = np.argsort(rank, kind="stable")
        while span < depth:
            bits = max(int(rank.max(initial=0)).bit_length(), 1)
            reach = min(depth, span * (62 // bits))
            offsets = [*range(0, reach - span, span), reach - span]
            key = np.zeros(len(rank), np.int64)
            for offset in offsets:
                key <<= bits
                if offset < len(rank):
                    key[:len(rank) - offset] |= rank[offset:]
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            rank = np.empty_like(key)
            rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
            span = reach
        return order

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, from, to): the ranges of ``order`` that begin with each row of ``words``."""
        if not len(self._names):
            return (np.zeros(0, np.int64),) * 3
        at = np.minimum(np.searchsorted(self._names, words), len(self._names) - 1)
        known = np.flatnonzero((self._names[at] == words).all(axis=1))
        queries = self._by_name[at[known]] + 1
        low = self._bound(queries, False)
        high = self._bound(queries, True)
        some = low < high
        return known[some], low[some], high[some]

    def _bound(self, queries: np.ndarray, after: bool) -> np.ndarray:
        """First suffix not below each query or, with ``after``, above all that begin with it."""
        low = np.zeros(len(queries), np.int64)
        high = np.full(len(queries), len(self.order), np.int64)
        steps = np.arange(queries.shape[1])
        rows = np.arange(len(queries))
        while (low < high).any():
            middle = np.minimum((low + high) >> 1, len(self.order) - 1)
            there = self.codes[self.order[middle][:, None] + steps]
            differs = there != queries
            place = differs.argmax(axis=1)
            below = np.where(differs.any(axis=1),
                             there[rows, place] < queries[rows, place], after)
            open_ = low < high
            low = np.where(open_ & below, middle + 1, low)
            high = np.where(open_ & ~below, middle, high)
        return low


def _ranges(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges [first, last), and the range each belongs to."""
    sizes = last - first
    which = np.repeat(np.arange(len(first)), sizes)
    return np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[which], which


def occurrences(array: SuffixArray, table: Windows) -> tuple[np.ndarray, np.ndarray]:
    """(word position, window) of every occurrence in the shard."""
    query, low, high = array.find(table.words)
    at, which = _ranges(low, high)
    return np.searchsorted(array.places, array.order[at]), query[which]


def search(texts: pa.Array, tables: list[Windows], window: int):
    """Per text: words, hit words (a mask over all), and distinct (text, item) pairs."""
    found = tokens.words(texts, tokens.alphanumeric())
    covered = np.zeros(len(found.hashes) + 1, np.int64)
    pairs = [np.zeros((0, 2), np.int64)]
    if len(found.hashes):
        array = SuffixArray(found, window)
        for table in tables:
            at, which = occurrences(array, table)
            if not len(at):
                continue
            covered += np.bincount(at, minlength=len(covered))
            covered -= np.bincount(at + table.words.shape[1], minlength=len(covered))
            hits = np.unique(np.stack([array.owners[at], which], 1), axis=0)
            place, row = _ranges(table.first[hits[:, 1]], table.first[hits[:, 1] + 1])
            pairs.append(np.stack([hits[row, 0], table.item[place]], 1))
    return found, np.cumsum(covered[:-1]) > 0, np.unique(np.concatenate(pairs), axis=0)


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[pd.DataFrame]:
    """The items in parts of about ``block_bytes`` (and at least one item)."""
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(size / block_bytes))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    for n in range(parts):
        yield benchmark.where(part == n).toPandas()


def _pass(docs: DataFrame, text: str, items: pd.DataFrame, window: int) -> DataFrame:
    """One block: adds to the hit ranges and items of every document."""
    names = np.array(items["item_id"].tolist(), dtype=object)
    tables = docs.sparkSession.sparkContext.broadcast(
        windows(pa.array(items["text"].tolist(), pa.string()), window))
    names = docs.sparkSession.sparkContext.broadcast(names)
    columns = docs.columns

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in tokens.pieces(batch, text, SHARD_BYTES):
                texts = piece.column(text)
                found, hit, pairs = search(texts, tables.value, window)
                items = [[] for _ in range(piece.num_rows)]
                for doc, item in pairs.tolist():
                    items[doc].append(names.value[item])
                hits = _hit_ranges(hit, found.bounds)
                if "__hits" in columns:
                    hits = [_merged(a, b) for a, b in
                            zip(piece.column("__hits").to_pylist(), hits)]
                    items = [a + b for a, b in zip(piece.column("__items").to_pylist(), items)]
                kept = [c for c in columns if c not in _STATE_NAMES]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(c) for c in kept] + [
                        pa.array(found.counts, pa.int64()),
                        pa.array([sum(h[1::2]) - sum(h[::2]) for h in hits], pa.int64()),
                        pa.array(hits, pa.list_(pa.int64())),
                        pa.array(items, pa.list_(pa.string()))],
                    kept + _STATE_NAMES)

    fields = [f for f in docs.schema.fields if f.name not in _STATE_NAMES]
    return docs.mapInArrow(judge, T.StructType(fields + STATE))


def _hit_ranges(hit: np.ndarray, bounds: np.ndarray) -> list[list[int]]:
    """Per text the hit words as first, past-last, first, past-last, ... of the text."""
    out = []
    for start, end in zip(bounds[:-1], bounds[1:]):
        if not hit[start:end].any():
            out.append([])
            continue
        inner = np.diff(np.concatenate([[0], hit[start:end].astype(np.int8), [0]]))
        out.append(np.flatnonzero(inner).tolist())
    return out


def _merged(a: list[int], b: list[int]) -> list[int]:
    """Union of two lists of ranges."""
    out: list[int] = []
    for start, end in sorted([*zip(a[::2], a[1::2]), *zip(b[::2], b[1::2])]):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out


def _searched(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    items = benchmark.select(
        F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("null")).alias("item_id"),
        F.col(f"`{item_text}`").alias("text")).where("text IS NOT NULL")
    for block in _blocks(items, block_bytes):
        docs = _pass(docs, text, block, window)
    return docs


def judged(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with n_words, n_hit, hit_ranges, items (ids as sorted text) and contaminated."""
    return _searched(docs, benchmark, text, **options).withColumns({
        "n_words": F.col("__n_words"), "n_hit": F.col("__n_hit"),
        "hit_ranges": F.col("__hits"),
        "items": F.sort_array(F.array_distinct("__items")),
        "contaminated": F.size("__hits") > 0,
    }).drop(*_STATE_NAMES)


def remove(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` without the affected documents, all columns as they are."""
    return _searched(docs, benchmark, text, **options).where(
        F.size("__hits") == 0).drop(*_STATE_NAMES)


def matches(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The longest verbatim matches and their places: one row per document and item passage.

    A match cannot be made longer on either side; it is at least a window long, or
    a whole item that is shorter than a window.
    """
    items = benchmark.select(
        F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("null")).alias("item_id"),
        F.col(f"`{item_text}`").alias("text")).where("text IS NOT NULL")
    docs = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    schema = T.StructType([docs.schema["doc_id"], *MATCH.fields])
    out = None
    for block in _blocks(items, block_bytes):
        found = docs.mapInArrow(_locate(docs, block, window), schema)
        out = found if out is None else out.unionAll(found)
    return out


def _locate(docs: DataFrame, items: pd.DataFrame, window: int):
    spark = docs.sparkSession
    names = spark.sparkContext.broadcast(items["item_id"].tolist())
    tables = spark.sparkContext.broadcast(
        windows(pa.array(items["text"].tolist(), pa.string()), window))

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in tokens.pieces(batch, "text", SHARD_BYTES):
                found = tokens.words(piece.column("text"), tokens.alphanumeric())
                if not len(found.hashes):
                    continue
                array = SuffixArray(found, window)
                for table in tables.value:
                    doc, item, item_word, doc_word, n = longest(array, found, table)
                    yield pa.RecordBatch.from_arrays([
                        piece.column("doc_id").take(pa.array(doc)),
                        pa.array([names.value[i] for i in item], pa.string()),
                        pa.array(item_word), pa.array(doc_word), pa.array(n),
                    ], ["doc_id", *MATCH.names])

    return locate


def longest(array: SuffixArray, found: tokens.Words, table: Windows):
    """Occurrences of neighbouring windows of one item, joined along the text."""
    at, which = occurrences(array, table)
    place, row = _ranges(table.first[which], table.first[which + 1])
    at, item, start = at[row], table.item[place], table.start[place]
    order = np.lexsort((at, at - start, item))
    at, item, start = at[order], item[order], start[order]
    new = np.ones(len(at), bool)
    new[1:] = ((item[1:] != item[:-1]) | (at[1:] != at[:-1] + 1) | (start[1:] != start[:-1] + 1)
               | (array.owners[at[1:]] != array.owners[at[:-1]]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at))[:len(first)] - 1
    doc = array.owners[at[first]]
    return (doc, item[first], start[first], at[first] - found.bounds[doc],
            at[last] - at[first] + table.words.shape[1])
