"""Token ids in training order: fixed-stride shards that are read in sequence.

Texts become token ids of a public tokenizer, each text ended by ``END``, cut
into parts of ``LENGTH`` tokens. A first pass counts the parts of every input
piece; the sums give every part its number, 0 to N - 1. A keyed Feistel network
over the next power of four, walked along its cycles until it falls below N,
permutes the numbers: every part gets its slot without a sort and without a table.
A shard holds ``SHARD`` consecutive slots and is written by one task, in order, as
records of the same size. So any slot is at a known byte of a known file, and a
reader resumes at a slot without looking at what lies before it.

A record is: id (8 bytes), part (4), tokens in use (4), ``LENGTH`` tokens of two
bytes (unused ones are ``END``), line feed; little-endian. Shards are written by
Spark's text writer, so they can lie in any file system Spark knows.

Null and empty texts are one part that holds ``END`` alone, so no row is lost. Ids
must be integers or null. Repeated rows stay repeated. Extra columns are not
written. An empty table writes no records. Texts are tokenized twice, which costs
less than to keep their tokens between the passes. A single space between characters
that are no white space always begins a new piece of the pattern, so texts are cut
there and the tokens of a worker's words are remembered. What is taken from memory is
compared with the text byte by byte, so no hash decides.
"""

from __future__ import annotations

import base64
import functools
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.llm import tokens

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that splits a text before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END = 50256
LENGTH = 512
SHARD = 16_384
KEY = 20240712
ROUNDS = 6
PIECE = 1 << 18
SLOTS = 1 << 19        # words that a worker can remember
POOL = 1 << 22         # and their tokens
WORD_BYTES = 64        # longer words are not remembered
NO_ID = -(1 << 63)
_END = np.uint16(END).tobytes()
# Bytes that may end, or begin, a white space character; taking more of them only cuts less.
_SPACE_ENDS, _SPACE_BEGINS = np.zeros(256, bool), np.zeros(256, bool)
_SPACE_ENDS[[*range(0x09, 0x0E), *range(0x1C, 0x21), *range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = True
_SPACE_BEGINS[[*range(0x09, 0x0E), *range(0x1C, 0x21), 0xC2, 0xE1, 0xE2, 0xE3]] = True
_HEAD = np.dtype([("doc_id", "<i8"), ("part", "<i4"), ("n_tokens", "<i4")])


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    """One tokenizer per worker; the file must lie at ``path`` on every machine."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("shards", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def permuted(numbers: np.ndarray, size: int, key: int = KEY) -> np.ndarray:
    """A keyed bijection of 0 .. size - 1.

    A balanced Feistel network permutes the numbers of an even number of bits;
    a number that leaves the range is permuted again until it is back.
    """
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = tokens.mixed(np.arange(1, ROUNDS + 1, dtype=np.uint64) + tokens.mixed(
        np.array([key], np.uint64)))
    out = numbers.astype(np.uint64)
    open_ = np.arange(len(out))
    while len(open_):
        left, right = out[open_] >> np.uint64(half), out[open_] & mask
        for k in keys:
            left, right = right, left ^ (tokens.mixed(right + k) & mask)
        out[open_] = (left << np.uint64(half)) | right
        open_ = open_[out[open_] >= size]
    return out.astype(np.int64)


def _joined(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of all ranges, one after the other."""
    out = np.repeat(first - np.cumsum(size) + size, size)
    out += np.arange(len(out))
    return out


class _Words:
    """Tokens of words by their hash, each in the only slot it can have; later words replace earlier ones."""

    def __init__(self, tokenizer) -> None:
        self.encode = tokenizer.encode_ordinary
        known = tokenizer.token_byte_values()
        ids = [tokenizer.encode_single_token(t) for t in known]
        self.size = np.zeros(max(ids) + 1, np.int64)
        self.size[ids] = [len(t) for t in known]
        self.begin = np.zeros(max(ids) + 1, np.int64)
        self.begin[ids] = np.cumsum(self.size[ids]) - self.size[ids]
        self.bytes = np.frombuffer(b"".join(known), np.uint8)
        self.hash = np.zeros(SLOTS, np.uint64)
        self.first = np.zeros(SLOTS, np.int32)
        self.count = np.zeros(SLOTS, np.uint8)
        self.pool = np.zeros(POOL, np.uint16)
        self.used = 0

    def tokens(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(tokens of all texts, how many stand before each text and after the last)."""
        data, offsets = tokens.buffers(texts)
        starts, plain, hashes = self._cut(data, offsets)
        ends = np.append(starts[1:], len(data))
        slot = (hashes & np.uint64(SLOTS - 1)).astype(np.int64)
        first, count = self.first[slot].astype(np.int64), self.count[slot].astype(np.int64)
        unknown = np.flatnonzero((self.hash[slot] != hashes) | (count == 0))
        _, some, which = np.unique(hashes[unknown], return_index=True, return_inverse=True)
        some = unknown[some]
        fresh, sizes = self._learned(data, starts[some], ends[some], plain[some])
        begins = np.cumsum(sizes) - sizes
        first[unknown], count[unknown] = begins[which] + POOL, sizes[which]
        at = _joined(first, count)
        old = at < POOL
        out = np.empty(len(at), np.uint16)
        out[old], out[~old] = self.pool[at[old]], fresh[at[~old] - POOL]
        edges = np.append(0, np.cumsum(count))
        bounds = edges[np.searchsorted(starts, offsets)]
        size = self.size[out]
        if size.sum() != len(data) or not np.array_equal(self.bytes[_joined(self.begin[out], size)], data) \
                or not np.array_equal(np.append(0, np.cumsum(size))[edges[1:]], ends):
            all_ = [self.encode(t) for t in texts.fill_null("").to_pylist()]   # two words of one hash
            return (np.array([x for one in all_ for x in one], np.uint16),
                    np.append(0, np.cumsum([len(one) for one in all_], dtype=np.int64)))
        self._remember(hashes[some], slot[some], fresh, begins, sizes, ends[some] - starts[some] <= WORD_BYTES)
        return out, bounds

    @staticmethod
    def _cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(where words start, whether they may stand beside others, hashes); a word holds the space before it."""
        cut = data == 0x20
        cut[1:] &= ~_SPACE_ENDS[data[:-1]]
        cut[:-1] &= ~_SPACE_BEGINS[data[1:]]
        some = offsets[:-1][offsets[:-1] < offsets[1:]]
        cut[some] = False
        cut[offsets[1:][offsets[:-1] < offsets[1:]] - 1] = False
        start = cut.copy()
        start[some] = True
        starts = np.flatnonzero(start)
        inner = cut[starts]
        plain = inner & np.append(inner[1:], False)[:len(inner)]
        return starts, plain, tokens.stretches(data, starts)

    def _learned(self, data, starts, ends, plain) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, their number) of words: those that may stand beside each other in one call."""
        sizes = np.zeros(len(starts), np.int64)
        beside, alone = np.flatnonzero(plain), np.flatnonzero(~plain)
        size = ends[beside] - starts[beside]
        together = np.array(self.encode(data[_joined(starts[beside], size)].tobytes().decode()), np.uint16)
        edges = np.searchsorted(np.cumsum(self.size[together]), np.cumsum(size)) + 1
        sizes[beside] = np.diff(np.append(0, edges))
        each = [self.encode(data[a:b].tobytes().decode()) for a, b in zip(starts[alone], ends[alone])]
        sizes[alone] = [len(x) for x in each]
        out = np.empty(sizes.sum(), np.uint16)
        owner = np.repeat(plain, sizes)
        out[owner], out[~owner] = together, [x for one in each for x in one]
        return out, sizes

    def _remember(self, hashes, slot, fresh, begins, sizes, short) -> None:
        if self.used + len(fresh) > POOL:
            self.count[:] = 0
            self.used = 0
        if len(fresh) > POOL:
            return
        self.pool[self.used:self.used + len(fresh)] = fresh
        self.hash[slot[short]] = hashes[short]
        self.first[slot[short]] = begins[short] + self.used
        self.count[slot[short]] = sizes[short]
        self.used += len(fresh)


@functools.lru_cache(maxsize=2)
def _words(path: str) -> _Words:
    return _Words(_tokenizer(path))


def _encoded(batches: Iterator[pa.RecordBatch], vocabulary: str):
    """(ids, tokens of all texts, where those of each text begin) of the pieces of a partition."""
    for batch in batches:
        for piece in tokens.pieces(batch, "text", PIECE):
            yield piece.column("doc_id"), *_words(vocabulary).tokens(piece.column("text"))


def part_counts(docs: DataFrame, vocabulary: str, length: int) -> dict[int, int]:
    """Parts of every input partition: one small row per task reaches the driver."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = sum(int((np.diff(bounds) // length + 1).sum()) for _, _, bounds in _encoded(batches, vocabulary))
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()]), pa.array([n])], ["partition", "n"])

    rows = docs.mapInArrow(count, "partition long, n long").collect()
    return {r["partition"]: r["n"] for r in rows}


def slotted(
    docs: DataFrame, vocabulary: str = VOCABULARY, length: int = LENGTH, key: int = KEY,
) -> tuple[DataFrame, int]:
    """(slot, record) of every part, and their number. Records are compressed.

    Both passes read the same input pieces: ``docs`` must be a stored table, as any
    filter or projection of one. A piece that yields another number of parts than
    counted fails its task.
    """
    counts = part_counts(docs, vocabulary, length)
    total = sum(counts.values())
    firsts, before = {}, 0
    for partition in sorted(counts):
        firsts[partition] = before
        before += counts[partition]
    plan = docs.sparkSession.sparkContext.broadcast((firsts, counts))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts, counts = plan.value
        partition = TaskContext.get().partitionId()
        at = firsts.get(partition, 0)
        end = at + counts.get(partition, 0)
        pack, pack_head = zstandard.ZstdCompressor(level=1).compress, struct.Struct("<qii").pack
        for ids, all_, bounds in _encoded(batches, vocabulary):
            records, all_ = [], all_.tobytes()
            for doc_id, a, b in zip(ids.to_pylist(), (2 * bounds[:-1]).tolist(), (2 * bounds[1:]).tolist()):
                whole = all_[a:b] + _END
                for part, start in enumerate(range(0, len(whole), 2 * length)):
                    held = whole[start:start + 2 * length]
                    head = pack_head(NO_ID if doc_id is None else doc_id, part, len(held) // 2)
                    records.append(pack(head + held))
            numbers = np.arange(at, at + len(records))
            at += len(records)
            if at > end:
                break
            yield pa.RecordBatch.from_arrays(
                [pa.array(permuted(numbers, total, key)), pa.array(records, pa.binary())],
                ["slot", "record"])
        if at != end:
            raise RuntimeError(f"input piece {partition} changed between the two passes")

    return docs.mapInArrow(place, "slot long, record binary"), total


def write(
    docs: DataFrame, path: str, id_column: str = "doc_id", text: str = "text",
    vocabulary: str = VOCABULARY, length: int = LENGTH, shard: int = SHARD, key: int = KEY,
) -> int:
    """Write the shards at ``path``; returns the number of records.

    Every shard is one partition of the only shuffle. Its file is numbered by it.
    """
    docs = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"),
                       F.col(f"`{text}`").alias("text"))
    rows, total = slotted(docs, vocabulary, length, key)
    shards = max(1, -(-total // shard))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor().decompress
        size = _HEAD.itemsize + 2 * length
        unused = np.full(length, END, np.uint16).tobytes()
        for batch in batches:
            full = ((open_(r) + unused)[:size] for r in batch.column("record").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(list(full), pa.binary())], ["value"])

    placed = rows.repartitionById(shards, F.floor(F.col("slot") / shard).cast("int"))
    ordered = placed.sortWithinPartitions("slot").mapInArrow(unpack, "value binary")
    # The bytes go through unchanged: a cast to text does not look at them.
    ordered.select(F.col("value").cast("string")).write.option("lineSep", "\n").text(path)
    return total


def read(
    spark: SparkSession, path: str, first: int = 0, length: int = LENGTH, shard: int = SHARD,
) -> DataFrame:
    """slot, shard, doc_id, part, n_tokens, tokens (two bytes each) from slot ``first`` on.

    Only shards that hold such slots are opened; a shard is one row until it is cut
    into records, so memory is bounded by its fixed size.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    number = F.regexp_extract("path", r"part-([0-9]+)-[^/]*$", 1).cast("long")
    wanted = files.select(number.alias("shard"), "content").where(
        (F.col("shard") + 1) * shard > first)
    stride = _HEAD.itemsize + 2 * length + 1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data = np.frombuffer(batch.column("content")[i].as_buffer(), np.uint8)
                number = batch.column("shard")[i].as_py()
                if len(data) % stride:
                    raise ValueError(f"shard {number} is cut off: {len(data)} bytes")
                rows = data.reshape(-1, stride)
                heads = np.ascontiguousarray(rows[:, :_HEAD.itemsize]).view(_HEAD).ravel()
                slots = number * shard + np.arange(len(rows))
                for a in range(0, len(rows), 4096):
                    b = min(a + 4096, len(rows))
                    held = [r[_HEAD.itemsize:_HEAD.itemsize + 2 * int(n)].tobytes()
                            for r, n in zip(rows[a:b], heads["n_tokens"][a:b])]
                    ids = heads["doc_id"][a:b].astype(np.int64)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(slots[a:b]), pa.array(np.full(b - a, number)),
                        pa.array(ids, mask=ids == NO_ID),
                        pa.array(heads["part"][a:b].astype(np.int32)),
                        pa.array(heads["n_tokens"][a:b].astype(np.int32)),
                        pa.array(held, pa.binary())],
                        ["slot", "shard", "doc_id", "part", "n_tokens", "tokens"])

    return wanted.mapInArrow(
        cut, "slot long, shard long, doc_id long, part int, n_tokens int, tokens binary").where(
        F.col("slot") >= first)


def texts(parts: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, text of records read back: the inverse of tokenizing."""
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _tokenizer(vocabulary)
        for batch in batches:
            out = [of.decode(np.frombuffer(x, np.uint16)[:-1].tolist())
                   for x in batch.column("tokens").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "text"])

    whole = parts.groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("part", "tokens"))).alias("p")).select(
        "doc_id", F.concat(F.lit(b""), F.aggregate(
            "p", F.lit(b""), lambda a, x: F.concat(a, x["tokens"]))).alias("tokens"))
    return whole.mapInArrow(decode, "doc_id long, text string")
