"""SentencePiece encoding that keeps the source bytes of every piece, and decoding.

A text is normalised first: at every position the longest key of the compiled
character map (a double array) is replaced, other characters stay, extra spaces go
and spaces become U+2581, as the model file says. Every normalised byte keeps the
offset of the source character it comes from, so a piece, which is a stretch of
normalised bytes, is projected to the source bytes ``begin`` to ``end``. The spans
of a text follow each other without a gap; the marker added in front has no bytes
of its own, and of a character that falls back to bytes the last piece has them all.

Pieces come from the merges of the model: of all neighbours that make a piece, the
pair with the best score is merged first, the leftmost on a tie. Where no piece
goes on from another character into a space, words are merged apart, each distinct
one once (at most ``MEMO`` are remembered); else a text is one word.

A null or empty text has no pieces and decodes to the empty text. Repeated rows are
repeated results, extra columns stay, and a result column replaces an input column
of its name. An empty table gives an empty result. The model file is read where the
job is planned and sent to the tasks; its size bounds what is broadcast. Texts must
be valid UTF-8. Models other than BPE, and those with pieces set by the user, are
refused.
"""

from __future__ import annotations

import functools
import heapq
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwright.llm import tokens

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MEMO = 1 << 17
LONG_WORD = 48         # characters; the merges of a longer word are kept in a heap
PIECE = 1 << 18
SPACE = "▁"
_SPACE = SPACE.encode()
# Kinds of pieces, and the kind of model, in the model file.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
BPE = 2


# --- the model file ------------------------------------------------------------------


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return value
            shift += 7

    while at < len(data):
        number, wire = divmod(varint(), 8)
        if wire == 0:
            yield number, varint()
            continue
        size = varint() if wire == 2 else {1: 8, 5: 4}[wire]
        yield number, data[at:at + size]
        at += size


@dataclass
class Model:
    """What a model file says, and the tables made of it."""

    names: list[str]
    scores: list[float]
    kinds: list[int]
    charsmap: bytes = b""
    prefix: bool = True          # a space is added in front
    squeeze: bool = True         # extra spaces go
    escape: bool = True          # spaces become U+2581
    byte_fallback: bool = False
    unknown_text: str = " ⁇ "
    apart: bool = field(init=False)

    def __post_init__(self):
        self.unknown = self.kinds.index(UNKNOWN) if UNKNOWN in self.kinds else -1
        self.normal = {n: i for i, (n, k) in enumerate(zip(self.names, self.kinds)) if k == NORMAL}
        self.bytes_ = {int(n[3:5], 16): i for i, (n, k) in enumerate(zip(self.names, self.kinds)) if k == BYTE}
        # Words can be merged apart if no piece goes on from a character into a space.
        self.apart = not any(SPACE in n.lstrip(SPACE) for n in self.normal)
        texts = []
        for name, kind in zip(self.names, self.kinds):
            texts.append({
                CONTROL: b"", UNKNOWN: self.unknown_text.encode(),
                BYTE: bytes([int(name[3:5], 16)]) if kind == BYTE else b"",
            }.get(kind, name.replace(SPACE, " ").encode()))
        self.text_bytes = np.frombuffer(b"".join(texts), np.uint8)
        self.text_bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        self.sizes = np.array([len(n.encode()) for n in self.names], np.int32)
        self.is_control = np.array([k == CONTROL for k in self.kinds])
        self.leads = np.array([k == NORMAL and n.startswith(SPACE) for n, k in zip(self.names, self.kinds)])
        self.trie = self.strings = None
        if self.charsmap:
            size = struct.unpack("<I", self.charsmap[:4])[0]
            self.trie = np.frombuffer(self.charsmap[4:4 + size], np.uint32)
            self.strings = self.charsmap[4 + size:]
            if b"  " in self.strings:
                raise ValueError("a character map that writes several spaces is not supported")


def parse(data: bytes) -> Model:
    """A model file as :class:`Model`."""
    names, scores, kinds, options, kind_of_model = [], [], [], {}, 1
    for number, value in _fields(data):
        if number == 1:
            name, score, kind = "", 0.0, NORMAL
            for n, v in _fields(value):
                if n == 1:
                    name = v.decode()
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            names.append(name)
            scores.append(score)
            kinds.append(kind)
        elif number == 2:
            for n, v in _fields(value):
                if n == 3:
                    kind_of_model = v
                elif n == 24 and v:
                    raise ValueError("a model with spaces as suffixes is not supported")
                elif n == 35:
                    options["byte_fallback"] = bool(v)
                elif n == 44:
                    options["unknown_text"] = v.decode()
        elif number == 3:
            for n, v in _fields(value):
                if n in (2, 3, 4, 5):
                    name = {2: "charsmap", 3: "prefix", 4: "squeeze", 5: "escape"}[n]
                    options[name] = v if n == 2 else bool(v)
        elif number == 5 and any(n == 2 and v for n, v in _fields(value)):
            raise ValueError("a model with a map for decoded text is not supported")
    if kind_of_model != BPE or set(kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
        raise ValueError("only BPE models without pieces set by the user are supported")
    return Model(names, scores, kinds, **options)


# --- normalisation -------------------------------------------------------------------


@dataclass
class Normal:
    """Normalised bytes of many texts: those of text ``d`` are ``bounds[d]`` to ``bounds[d + 1]``.

    ``source`` is the offset, in its text, of the character a byte comes from, and
    ``ends`` where the last piece of a text ends there.
    """

    data: np.ndarray
    bounds: np.ndarray
    source: np.ndarray
    ends: np.ndarray


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the bounds of each; null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, places, data = texts.buffers()
    bounds = np.frombuffer(places, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    low, high = int(bounds[0]), int(bounds[-1])
    return (np.frombuffer(data, np.uint8)[low:high] if high > low else np.zeros(0, np.uint8)), bounds - low


def longest_keys(trie: np.ndarray, data: np.ndarray, limits: np.ndarray, starts: np.ndarray):
    """(length, value) of the longest key of the double array at each of ``starts``; length 0 if none.

    All positions go down the array together; those without a further step leave.
    """
    def offset(unit):
        return (unit >> np.uint32(10)) << ((unit & np.uint32(1 << 9)) >> np.uint32(6))

    length, value = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
    alive, depth = np.arange(len(starts)), 0
    node = np.full(len(starts), offset(trie[:1])[0], np.uint32)
    while True:
        alive = alive[starts[alive] + depth < limits[alive]]
        if not len(alive):
            return length, value
        byte = data[starts[alive] + depth].astype(np.uint32)
        to = node[alive] ^ byte
        unit = trie[np.minimum(to, len(trie) - 1)]
        step = (to < len(trie)) & ((unit & np.uint32((1 << 31) | 0xFF)) == byte)
        alive, to, unit = alive[step], to[step], unit[step]
        node[alive] = to ^ offset(unit)
        depth += 1
        ended = (unit >> np.uint32(8)) & np.uint32(1) == 1
        length[alive[ended]] = depth
        value[alive[ended]] = (trie[node[alive[ended]]] & np.uint32((1 << 31) - 1)).astype(np.int64)


def _mapped(model: Model, data: np.ndarray, bounds: np.ndarray):
    """(bytes, bounds, source) after the character map; source counts from the start of ``data``."""
    first = (data & 0xC0) != 0x80
    source = np.maximum.accumulate(np.where(first, np.arange(len(data)), 0)) if len(data) else np.zeros(0, np.int64)
    if model.trie is None:
        return data, bounds, source
    starts = np.flatnonzero(first)
    limits = bounds[np.searchsorted(bounds, starts, "right")]
    length, value = longest_keys(model.trie, data, limits, starts)
    out, origin, at = [], [], 0
    for k in np.flatnonzero(length):
        start = int(starts[k])
        if start < at:
            continue   # inside a longer key that begins before
        out.append(data[at:start])
        origin.append(source[at:start])
        begin = int(value[k])
        new = np.frombuffer(model.strings[begin:model.strings.index(b"\0", begin)], np.uint8)
        out.append(new)
        origin.append(np.full(len(new), start))
        at = start + int(length[k])
    out, origin = np.concatenate([*out, data[at:]]), np.concatenate([*origin, source[at:]])
    return out, np.searchsorted(origin, bounds), origin


def normalise(model: Model, texts: pa.Array) -> Normal:
    data, source_bounds = flat(texts)
    data, bounds, source = _mapped(model, data, source_bounds)
    ends = source_bounds[1:].copy()
    n = len(bounds) - 1
    space = data == 0x20
    if model.squeeze and len(data):
        before = np.concatenate([[True], space[:-1]])
        before[bounds[:-1][bounds[:-1] < len(data)]] = True
        keep = ~(space & before)
        counts = np.concatenate([[0], np.cumsum(keep)])
        data, source, bounds = data[keep], source[keep], counts[bounds]
        last = bounds[1:] - 1
        trailing = np.flatnonzero((np.diff(bounds) > 0) & (data[np.maximum(last, 0)] == 0x20)) if len(data) else []
        if len(trailing):
            ends[trailing] = source[last[trailing]]
            keep = np.ones(len(data), bool)
            keep[last[trailing]] = False
            counts = np.concatenate([[0], np.cumsum(keep)])
            data, source, bounds = data[keep], source[keep], counts[bounds]
    filled = np.flatnonzero(np.diff(bounds))
    if model.prefix and len(filled):
        at = bounds[filled]
        data, source = np.insert(data, at, 0x20), np.insert(source, at, source[at])
        added = np.zeros(n + 1, np.int64)
        added[filled + 1] = 1
        bounds = bounds + np.cumsum(added)
    if model.escape and len(data):
        space = data == 0x20
        size = np.where(space, len(_SPACE), 1)
        begins = np.concatenate([[0], np.cumsum(size)])
        data, source = np.repeat(data, size), np.repeat(source, size)
        for k, byte in enumerate(_SPACE):
            data[begins[:-1][space] + k] = byte
        bounds = begins[bounds]
    source = source - np.repeat(source_bounds[:-1], np.diff(bounds))
    return Normal(data, bounds, source, ends - source_bounds[:-1])


# --- pieces --------------------------------------------------------------------------


class Merges:
    """Which neighbours make a piece: sorted keys of (left, right) and the piece of each."""

    def __init__(self, model: Model):
        self.model = model
        order = sorted({model.scores[i] for i in model.normal.values()}, reverse=True)
        place = {score: k for k, score in enumerate(order)}
        n = len(model.names)
        self.none = len(order)
        self.rank = np.full(n + 1, self.none, np.int32)   # of a piece among the scores; n is no piece
        pairs = {}
        for name, whole in model.normal.items():
            self.rank[whole] = place[model.scores[whole]]
            for cut in range(1, len(name)):
                left, right = model.normal.get(name[:cut]), model.normal.get(name[cut:])
                if left is not None and right is not None:
                    pairs[left * (n + 1) + right] = whole
        self.keys = np.array(sorted(pairs), np.int64)
        self.made = np.array([pairs[k] for k in sorted(pairs)], np.int32)
        self.point = np.full(0x110000, n, np.int32)       # a character as a piece
        for name, whole in model.normal.items():
            if len(name) == 1:
                self.point[ord(name)] = whole
        self.n = n

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece two neighbours make, or ``n``."""
        if not len(self.keys):
            return np.full(len(left), self.n, np.int32)
        key = left.astype(np.int64) * (self.n + 1) + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.made[at], np.int32(self.n))

    def merge(self, points: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, piece, character) of what is left of many words after all merges.

        In a round every word merges its best pair, the leftmost on a tie; words without
        a pair leave. ``character`` is the code point where ``piece`` is none.
        """
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        word = np.repeat(np.arange(len(counts)), counts)
        piece = self.point[points]
        pair = np.full(len(piece), self.n, np.int32)
        inside = np.flatnonzero(word[:-1] == word[1:])
        pair[inside] = self.of(piece[inside], piece[inside + 1])
        while len(word):
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            sizes = np.diff(np.append(starts, len(word)))
            rank = self.rank[pair]
            best = np.minimum.reduceat(rank, starts)
            open_ = best < self.none
            if not open_.all():
                ended = np.repeat(~open_, sizes)
                out.append((word[ended], piece[ended], points[ended]))
                word, piece, points, pair, rank = (x[~ended] for x in (word, piece, points, pair, rank))
                best, sizes = best[open_], sizes[open_]
                if not len(word):
                    break
            found = np.flatnonzero(rank == np.repeat(best, sizes))
            at = found[np.append(True, word[found[1:]] != word[found[:-1]])]
            piece[at] = pair[at]
            keep = np.ones(len(word), bool)
            keep[at + 1] = False
            word, piece, points, pair = (x[keep] for x in (word, piece, points, pair))
            at = at - np.arange(len(at))   # one place left of each was taken out before it
            touched = np.concatenate([at, at[at > 0] - 1])
            follows = touched + 1 < len(word)
            touched, last = touched[follows], touched[~follows]
            same = word[touched] == word[touched + 1]
            pair[last] = self.n
            pair[touched[~same]] = self.n
            touched = touched[same]
            pair[touched] = self.of(piece[touched], piece[touched + 1])
        if not out:
            return (np.zeros(0, np.int64),) * 3
        word, piece, points = (np.concatenate(x) for x in zip(*out))
        order = np.argsort(word, kind="stable")
        return word[order], piece[order], points[order]


def merged(model: Model, word: str) -> list[str]:
    """What is left of one long word after all merges, by a heap of pairs."""
    parts = list(word)
    scores, known = model.scores, model.normal
    # Places stay; a merged place takes the text of its right neighbour.
    right = list(range(1, len(parts) + 1))
    left = list(range(-1, len(parts) - 1))
    heap: list[tuple[float, int, int, str]] = []

    def offer(i: int) -> None:
        j = right[i]
        if j < len(parts):
            whole = parts[i] + parts[j]
            made = known.get(whole)
            if made is not None:
                heapq.heappush(heap, (-scores[made], i, j, whole))

    for i in range(len(parts) - 1):
        offer(i)
    while heap:
        _, i, j, whole = heapq.heappop(heap)
        if not parts[i] or right[i] != j or parts[i] + parts[j] != whole:
            continue
        parts[i], parts[j] = whole, ""
        right[i] = right[j]
        if right[i] < len(parts):
            left[right[i]] = i
        if left[i] >= 0:
            offer(left[i])
        offer(i)
    return [p for p in parts if p]


class Words:
    """Distinct words met so far, each with its ids and their normalised lengths."""

    def __init__(self, model: Model, merges: Merges):
        self.model, self.merges = model, merges
        self.number: dict[bytes, int] = {}
        self.ids, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.bounds = np.zeros(1, np.int64)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of every word; new ones are merged together."""
        held = self.number
        new = [w for w in dict.fromkeys(words) if w not in held]
        if new:
            for k, word in enumerate(new, len(held)):
                held[word] = k
            self._learn([w.decode() for w in new])
        return np.fromiter(map(held.__getitem__, words), np.int64, len(words))

    def _learn(self, new: list[str]) -> None:
        short = [k for k, w in enumerate(new) if len(w) <= LONG_WORD]
        points = np.frombuffer("".join(new[k] for k in short).encode("utf-32-le"), np.uint32)
        counts = np.array([len(new[k]) for k in short], np.int64)
        word, piece, point = self.merges.merge(points, counts)
        parts = [(np.array(short, np.int64)[word], piece, point)]
        for k in sorted(set(range(len(new))) - set(short)):
            left = merged(self.model, new[k])
            known = [self.model.normal.get(p, self.merges.n) for p in left]
            parts.append((np.full(len(left), k), np.array(known, np.int32),
                          np.array([ord(p[0]) for p in left], np.uint32)))
        word, piece, point = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(word, kind="stable")
        word, piece, point = word[order], piece[order], point[order]
        names = self.model.sizes
        size = names[np.minimum(piece, len(names) - 1)]
        lost = np.flatnonzero(piece == self.merges.n)
        if len(lost):
            raw = [chr(c).encode() for c in point[lost].tolist()]
            size[lost] = [len(r) for r in raw]
            if self.model.byte_fallback:
                repeats = np.ones(len(piece), np.int64)
                repeats[lost] = size[lost]
                word, piece, size = (np.repeat(x, repeats) for x in (word, piece, size))
                at = piece == self.merges.n
                piece[at] = [self.model.bytes_[b] for r in raw for b in r]
                size[at] = 1
            else:
                piece[lost] = self.model.unknown
        counts = np.bincount(word, minlength=len(new))
        self.ids = np.concatenate([self.ids, piece.astype(np.int32)])
        self.sizes = np.concatenate([self.sizes, size.astype(np.int32)])
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(counts)])


@dataclass
class Encoded:
    """``ids[bounds[d]:bounds[d + 1]]`` are the pieces of text ``d``, begin and end their source bytes."""

    ids: np.ndarray
    bounds: np.ndarray
    begins: np.ndarray
    ends: np.ndarray


class Encoder:
    def __init__(self, model: Model):
        self.model = model
        self.words: Words | None = None   # a worker that only decodes needs no merges

    def encode(self, texts: pa.Array) -> Encoded:
        normal = normalise(self.model, texts)
        if self.words is None:
            self.words = Words(self.model, Merges(self.model))
        elif len(self.words.number) > MEMO:
            self.words = Words(self.model, self.words.merges)
        data, bounds = normal.data, normal.bounds
        starts = bounds[:-1][np.diff(bounds) > 0]
        if self.model.apart and len(data) > 2:
            mark = np.zeros(len(data), bool)
            mark[:-2] = (data[:-2] == _SPACE[0]) & (data[1:-1] == _SPACE[1]) & (data[2:] == _SPACE[2])
            begun = mark.copy()
            begun[3:] &= ~mark[:-3]
            begun[starts] = True
            starts = np.flatnonzero(begun)
        cuts = np.append(starts, len(data)).tolist()
        blob = data.tobytes()
        words = self.words
        number = words.numbers([blob[a:b] for a, b in zip(cuts, cuts[1:])])
        first, count = words.bounds[number], np.diff(words.bounds)[number]
        take = np.arange(count.sum()) + np.repeat(first - np.cumsum(count) + count, count)
        ids, size = words.ids[take], words.sizes[take].astype(np.int64)
        stops = np.cumsum(size)
        starts = stops - size
        if not self.model.byte_fallback and len(ids):
            # Neighbouring unknown characters of a text are one piece.
            goes_on = (ids[1:] == self.model.unknown) & (ids[:-1] == self.model.unknown) & ~np.isin(starts[1:], bounds)
            ids, starts = ids[np.append(True, ~goes_on)], starts[np.append(True, ~goes_on)]
            stops = np.append(starts[1:], len(data))
        edges = np.searchsorted(starts, bounds)
        ends = np.append(normal.source, 0)[stops]
        filled = np.flatnonzero(np.diff(bounds))
        ends[edges[filled + 1] - 1] = normal.ends[filled]
        return Encoded(ids, edges.astype(np.int64), normal.source[starts].astype(np.int32), ends.astype(np.int32))

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """Texts of lists of ids, the added space taken off again."""
        model = self.model
        shown = ~model.is_control[ids]
        counts = np.concatenate([[0], np.cumsum(shown)])
        ids, bounds = ids[shown], counts[bounds]
        first, size = model.text_bounds[ids], np.diff(model.text_bounds)[ids]
        if model.prefix or model.squeeze:
            cut = bounds[:-1][np.diff(bounds) > 0]
            lead = cut[model.leads[ids[cut]]]
            first[lead] += 1
            size[lead] -= 1
        take = np.arange(size.sum()) + np.repeat(first - np.cumsum(size) + size, size)
        blob = model.text_bytes[take].tobytes()
        cuts = np.concatenate([[0], np.cumsum(size)])[bounds].tolist()
        out = [blob[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:])]
        return [t.lstrip(" ") for t in out] if model.squeeze else out


@functools.lru_cache(maxsize=2)
def encoder(model: bytes) -> Encoder:
    """One encoder per worker and model; words stay known between tasks."""
    return Encoder(parse(model))


def read_model(path: str = MODEL) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, text: str = "text", model: str = MODEL,
           columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``docs`` (all) with ids, and begins and ends of the pieces in the UTF-8 text."""
    held = docs.sparkSession.sparkContext.broadcast(read_model(model))
    encoder(held.value)   # a model that is not supported fails here
    added = ("ids", "begins", "ends")
    columns = [c for c in columns or docs.columns if c.lower() not in added]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = encoder(held.value)
        for batch in batches:
            for piece in tokens.pieces(batch, "__text", PIECE):
                found = of.encode(piece.column("__text"))
                bounds = pa.array(found.bounds.astype(np.int32))
                lists = [pa.ListArray.from_arrays(bounds, pa.array(x))
                         for x in (found.ids, found.begins, found.ends)]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(c) for c in columns] + lists, [*columns, *added])

    fields = [docs.schema[c] for c in columns]
    fields += [T.StructField(c, T.ArrayType(T.IntegerType())) for c in added]
    source = docs.select(*[F.col(f"`{c}`") for c in columns], F.col(f"`{text}`").alias("__text"))
    return source.mapInArrow(work, T.StructType(fields))


def decode(rows: DataFrame, ids: str = "ids", model: str = MODEL) -> DataFrame:
    """``rows`` with the text ``decoded`` of the list ``ids``; null is an empty list."""
    held = rows.sparkSession.sparkContext.broadcast(read_model(model))
    columns = [c for c in rows.columns if c.lower() != "decoded"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = encoder(held.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                piece = batch.slice(start, 256)
                lists = piece.column("__ids")
                sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                bounds = np.concatenate([[0], np.cumsum(sizes)])
                texts = of.decode(lists.flatten().to_numpy().astype(np.int64), bounds)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(c) for c in columns] + [pa.array(texts, pa.string())],
                    [*columns, "decoded"])

    fields = [rows.schema[c] for c in columns] + [T.StructField("decoded", T.StringType())]
    source = rows.select(*[F.col(f"`{c}`") for c in columns], F.col(f"`{ids}`").alias("__ids"))
    return source.mapInArrow(work, T.StructType(fields))
