"""Repair of the structure of conversations by the cheapest edits.

A repaired conversation is empty, or an optional system turn and then pairs of user
and assistant. Rows are kept (cost 0), given the other role (``RENAME``), deleted
(``DELETE``; blank rows and repeats must be), or turns without text are inserted
(``INSERT``). A truncated row that stays costs ``TRUNCATED`` more. Of all cheapest
lists of edits the one whose letters D, I, K, R are least is taken.

The costs of being at each of the four places of the pattern, less their minimum, are
one of a few dozen vectors. A table gives, for every vector and every block of
``BLOCK`` rows, the next vector and what is added (Four Russians), so a conversation
is priced by one lookup per block. Then blocks are expanded backward: the vectors
inside a block come from its first one, and all places on some cheapest path are
marked, not one of them, so ties stay open until the letters are read off forward.

No conversation has to fit a task. Rows are sorted by conversation over all tasks;
one that lies inside a task is finished there. Of the others, every chunk of at most
``CHUNK_ROWS`` rows gives its costs from each place to each, which are small and
combined from the last chunk to the first; then all chunks are traced side by side
from every place, and only their letters and lines pass in order through the digest.

Order: turn, nulls first, then role and digest of role and text. Equal rows of one
turn are counted before anything is shuffled. Nulls in role or text are one space. A
null conversation id is a conversation of its own. Other columns are ignored. An
empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwright.llm.scratch import Scratch

KEEP, RENAME, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
BLOCK = 4
CHUNK_ROWS = 1 << 16
CHUNK_BYTES = 1 << 20
NEVER = 1 << 20          # a cost that nothing reaches
ROLES = {"u": "user", "a": "assistant"}
# Places of the pattern: before all, after a system turn, a user turn, an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (0, NEVER, NEVER, 0)
STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT,
        (ASSISTANT, "u"): USER}
# Symbols of rows: initial of the role (o: any other), upper case if truncated; x must go.
SYMBOLS = "suaoSUAOx"
NUMBER = {s: k for k, s in enumerate(SYMBOLS)}


def _next_role(place: int) -> str:
    """The role that a renamed or inserted turn takes at a place."""
    return "a" if place == USER else "u"


def _row_edits(symbol: str) -> list[list[tuple[str, int, int]]]:
    """For every place: (letter, cost, next place) of what can be done with a row."""
    out = []
    for place in range(4):
        edits = [("D", DELETE, place)]
        if symbol != "x":
            extra = TRUNCATED if symbol.isupper() else 0
            if (place, symbol.lower()) in STEP:
                edits.append(("K", KEEP + extra, STEP[place, symbol.lower()]))
            edits.append(("R", RENAME + extra, STEP[place, _next_role(place)]))
        out.append(edits)
    return out


EDITS = [_row_edits(s) for s in SYMBOLS]
AFTER_INSERT = [STEP[p, _next_role(p)] for p in range(4)]


def _closed(costs: list[int]) -> list[int]:
    """Costs after inserting turns."""
    for _ in range(3):
        for place, to in enumerate(AFTER_INSERT):
            costs[to] = min(costs[to], costs[place] + INSERT)
    return costs


def _normal(costs: list[int]) -> tuple[tuple[int, ...], int]:
    """(costs less their minimum, minimum); places that cannot be on a cheapest path go.

    After a system turn nothing can be done that cannot be done after an assistant turn.
    What starts the pattern saves at most the deletion of one system turn.
    """
    low = min(costs)
    if costs[SYSTEM] > costs[ASSISTANT]:
        costs[SYSTEM] = NEVER
    if costs[START] > costs[ASSISTANT] + DELETE:
        costs[START] = NEVER
    return tuple(NEVER if c >= NEVER else c - low for c in costs), low


class Tables:
    """All normalised vectors, and what a row or a block of rows makes of each."""

    def __init__(self):
        units = [_normal(_closed([0 if p == at else NEVER for p in range(4)]))[0] for at in range(4)]
        self.vectors = list(dict.fromkeys(units))
        number = {v: k for k, v in enumerate(self.vectors)}
        self.unit = [number[u] for u in units]
        to, add = [], []
        for vector in self.vectors:   # grows while it is read
            to.append([])
            add.append([])
            for edits in EDITS:
                costs = [NEVER] * 4
                for place, cost in enumerate(vector):
                    for _, more, then in edits[place]:
                        costs[then] = min(costs[then], cost + more)
                made, low = _normal(_closed(costs))
                if made not in number:
                    number[made] = len(self.vectors)
                    self.vectors.append(made)
                to[-1].append(number[made])
                add[-1].append(low)
        self.row_to, self.row_add = to, add
        one_to, one_add = np.array(to, np.int32), np.array(add, np.int32)
        block_to, block_add = one_to, one_add
        for _ in range(BLOCK - 1):
            # The block grows by a row at its end.
            block_add = (block_add[:, :, None] + one_add[block_to]).reshape(len(to), -1)
            block_to = one_to[block_to].reshape(len(to), -1)
        self.block_to, self.block_add = block_to.tolist(), block_add.tolist()

    def forward(self, symbols: bytes, place: int) -> tuple[list[int], int, int]:
        """(vector before every block and the rest, vector after all rows, cost added)."""
        to, add, vector, total = self.block_to, self.block_add, self.unit[place], 0
        full = len(symbols) // BLOCK
        weights = len(SYMBOLS) ** np.arange(BLOCK - 1, -1, -1)
        codes = np.frombuffer(symbols, np.uint8)[:full * BLOCK].reshape(full, BLOCK) @ weights
        before = []
        for code in codes.tolist():
            before.append(vector)
            total += add[vector][code]
            vector = to[vector][code]
        before.append(vector)
        for symbol in symbols[full * BLOCK:]:
            total += self.row_add[vector][symbol]
            vector = self.row_to[vector][symbol]
        return before, vector, total

    def costs(self, symbols: bytes) -> list[int]:
        """Cost from each place to each (sixteen numbers), inserts on both sides included."""
        out = []
        for place in range(4):
            _, vector, total = self.forward(symbols, place)
            out.extend(NEVER if c >= NEVER else total + c for c in self.vectors[vector])
        return out

    def _marked(self, vector: int, places: int) -> int:
        """``places`` (bits) and those from which an insert leads to them on a cheapest path."""
        costs = self.vectors[vector]
        for _ in range(3):
            for place, to in enumerate(AFTER_INSERT):
                if places >> to & 1 and costs[place] < NEVER and costs[place] + INSERT == costs[to]:
                    places |= 1 << place
        return places

    def _sources(self, vector: int, symbol: int, places: int) -> int:
        """Places before a row on a cheapest path to ``places`` after it."""
        costs, after = self.vectors[vector], self.vectors[self.row_to[vector][symbol]]
        low, found = self.row_add[vector][symbol], 0
        for place, edits in enumerate(EDITS[symbol]):
            if costs[place] < NEVER and any(
                    places >> to & 1 and costs[place] + more == after[to] + low for _, more, to in edits):
                found |= 1 << place
        return self._marked(vector, found)

    def trace(self, symbols: bytes, place: int, after: Iterable[int]) -> tuple[str, int, int] | None:
        """(letters, last place, cost) of the least cheapest edits from ``place``.

        ``after`` is the cost that follows at each place; None if nothing leads to an end.
        """
        before, vector, total = self.forward(symbols, place)
        ends = [min(c, NEVER) + min(a, NEVER) for c, a in zip(self.vectors[vector], after)]
        cheapest = min(ends)
        if cheapest >= NEVER:
            return None
        last = sum(1 << p for p, c in enumerate(ends) if c == cheapest)
        # Backward over the blocks: the vectors inside each, then the marks of its rows.
        marks = [0] * (len(symbols) + 1)
        vectors = [0] * (len(symbols) + 1)
        marks[-1], vectors[-1] = self._marked(vector, last), vector
        for k in range(len(before) - 1, -1, -1):
            low, high = k * BLOCK, min((k + 1) * BLOCK, len(symbols))
            inside = before[k]
            for i in range(low, high):
                vectors[i] = inside
                inside = self.row_to[inside][symbols[i]]
            for i in range(high - 1, low - 1, -1):
                marks[i] = self._sources(vectors[i], symbols[i], marks[i + 1])
        # Forward along the marks, the least letter at every step.
        letters, at = [], place
        for i in range(len(symbols) + 1):
            costs = self.vectors[vectors[i]]
            while True:
                if i == len(symbols) and last >> at & 1:
                    return "".join(letters), at, total + cheapest
                choices = []
                if i < len(symbols):
                    there = self.vectors[vectors[i + 1]]
                    low = self.row_add[vectors[i]][symbols[i]]
                    choices = [(letter, to) for letter, more, to in EDITS[symbols[i]][at]
                               if marks[i + 1] >> to & 1 and costs[at] + more == there[to] + low]
                to = AFTER_INSERT[at]
                if marks[i] >> to & 1 and costs[at] + INSERT == costs[to]:
                    choices.append(("I", to))
                letter, at = min(choices)
                letters.append(letter)
                if letter != "I":
                    break
        raise AssertionError("a marked path has an end")


@functools.lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()


def repaired_lines(letters: str, symbols: bytes, rows: Iterator[tuple[str, str]], place: int) -> Iterator[str]:
    """``role:text`` of the turns that edits make; ``rows`` are (role, text) of those that need not go."""
    gone, numbers = NUMBER["x"], iter(symbols)
    for letter in letters:
        initial = _next_role(place)
        if letter == "I":
            yield ROLES[initial] + ":"
        else:
            if next(numbers) == gone:
                continue
            role, text = next(rows)
            if letter == "D":
                continue
            if letter == "K":
                initial = role[:1]
            else:
                role = ROLES[initial]
            yield f"{role}:{text}"
        place = STEP[place, initial]


# --- rows ----------------------------------------------------------------------------


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies of ``rows`` after the stated damage.

    By the CRC-32 of ``conv_id:turn`` modulo 20 a row is lost (0; ``copies`` is 0), loses its
    text (1), its sentence ends (2), is doubled (3) or gets the role user (4). Nulls in role,
    text and in the key are one space; conv_id and turn are returned as they are.
    """
    space = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space),
                      F.coalesce(F.col("turn").cast("string"), space))
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    kind = F.col("__kind")
    return rows.select("conv_id", "turn", "role", "text", (F.crc32(F.encode(key, "UTF-8")) % 20).alias("__kind")).select(
        "conv_id", "turn",
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, F.lit(0)).when(kind == 3, F.lit(2)).otherwise(F.lit(1)).cast("long").alias("copies"))


def _truncated(text: Column) -> Column:
    return ~text.rlike(r"[.!?][\x20\x09-\x0D]*\z")


def _with_faults(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per equal rows of a turn: conv, turn, role, text, digest, copies, symbol, blank.

    ``symbol`` is that of the first of the equal rows, null where all are lost; the others are
    repeats. A row is a repeat if its role and text stand in an earlier turn.
    """
    held = rows.select(
        F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        F.col("copies").cast("long").alias("copies"))
    lost = F.col("copies") == 0   # only tells that the conversation exists
    held = held.select("conv", F.when(~lost, F.col("turn")).alias("turn"),
                       F.when(~lost, F.col("role")).alias("role"), F.when(~lost, F.col("text")).alias("text"), "copies")
    held = held.groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies")).select(
        "*", F.sha2(F.concat("role", F.lit("\0"), "text"), 256).alias("digest"),
        (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"))
    held = scratch.write(held, "turns")
    # Stored, so that a text with very many turns can be split in the join.
    first = scratch.write(held.where(~F.col("blank")).groupBy("conv", "digest").agg(
        F.max(F.col("turn").isNull()).alias("in_null"), F.min("turn").alias("least")), "first")
    first = first.select(F.col("conv").alias("__conv"), F.col("digest").alias("__digest"), "in_null", "least")
    joined = held.join(first, F.col("conv").eqNullSafe(F.col("__conv")) & (F.col("digest") == F.col("__digest")), "left")
    earlier = F.col("turn").isNotNull() & (F.col("in_null") | (F.col("turn") > F.col("least")))
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("o"))
    symbol = F.when(F.col("text").isNull(), F.lit(None).cast("string")).when(
        F.col("blank") | earlier, F.lit("x")).when(_truncated(F.col("text")), F.upper(known)).otherwise(known)
    return joined.select("conv", "turn", "role", "text", "digest", "copies", "blank", symbol.alias("symbol"))


class _Chunk:
    """Rows of one conversation that follow each other."""

    def __init__(self):
        self.symbols, self.roles, self.texts, self.size = bytearray(), [], [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = None
        self.first = self.last = None

    def full(self) -> bool:
        return len(self.symbols) >= CHUNK_ROWS or self.size >= CHUNK_BYTES

    def add(self, turn, role, text, copies, blank, symbol) -> None:
        if symbol is None:
            return
        initial = role[:1]
        if self.first is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in ("su", "ua", "au")
        self.illegal += copies - 1
        self.last = initial
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.turns += 1
        self.symbols.append(NUMBER[symbol])
        self.symbols.extend(bytes([NUMBER["x"]]) * (copies - 1))
        if blank:
            self.blank += copies
        else:
            self.duplicate += copies - 1 + (symbol == "x")
            self.truncated += symbol.isupper()
        if symbol != "x":
            self.roles.append(role)
            self.texts.append(text)
            self.size += len(role) + len(text)

    def join(self, other: _Chunk) -> None:
        """The figures of a chunk that follows."""
        if other.first is None:
            return
        if self.first is None:
            self.first = other.first
        else:
            self.illegal += self.last + other.first not in ("su", "ua", "au")
        self.last = other.last
        for name in ("blank", "duplicate", "truncated", "illegal", "turns"):
            setattr(self, name, getattr(self, name) + getattr(other, name))
        if other.low is not None:
            self.turns -= other.low == self.high
            self.low = other.low if self.low is None else self.low
            self.high = other.high

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


_FIGURES = ("blank", "duplicate", "truncated", "illegal", "turns")
_REPORT = T.StructType([T.StructField(c, T.LongType()) for c in (
    "gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [
    T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])
_PART = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("chunk", T.IntegerType()),
    T.StructField("symbols", T.BinaryType()), T.StructField("roles", T.ArrayType(T.StringType())),
    T.StructField("texts", T.ArrayType(T.StringType())),
    T.StructField("costs", T.ArrayType(T.IntegerType())),
    T.StructField("first", T.StringType()), T.StructField("last", T.StringType()),
    T.StructField("low", T.LongType()), T.StructField("high", T.LongType())]
    + [T.StructField(f"n_{c}", T.LongType()) for c in _FIGURES])


def _batch(rows: list[dict], schema: T.StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    return pa.RecordBatch.from_pylist(rows, to_arrow_schema(schema))


class _Digest:
    """SHA-256 of lines joined by line feeds."""

    def __init__(self):
        self.hash, self.begun = hashlib.sha256(), False

    def add(self, lines: Iterable[str]) -> None:
        for line in lines:
            if self.begun:
                self.hash.update(b"\n")
            self.begun = True
            self.hash.update(line.encode())


def _report(chunk: _Chunk, cost: int, audit: str, digest: _Digest) -> dict:
    return {"gaps": chunk.gaps(), "blank": chunk.blank, "duplicate": chunk.duplicate,
            "truncated": chunk.truncated, "illegal": chunk.illegal, "cost": cost, "audit": audit,
            "repaired_sha256": digest.hash.hexdigest()}


def _scan(schema: T.StructType):
    """Finished conversations, and chunks of those that may go on in another task."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, part = tables(), TaskContext.get().partitionId()
        current, chunk, number, opening, out, held = None, None, 0, True, [], 0

        def open_part() -> dict:
            return {"conv": current[0], "part": part, "chunk": number, "symbols": bytes(chunk.symbols),
                    "roles": chunk.roles, "texts": chunk.texts, "costs": known.costs(bytes(chunk.symbols)), "first": chunk.first,
                    "last": chunk.last, "low": chunk.low, "high": chunk.high,
                    **{f"n_{c}": getattr(chunk, c) for c in _FIGURES}}

        def closed() -> dict:
            symbols = bytes(chunk.symbols)
            audit, _, cost = known.trace(symbols, START, ENDS)
            digest = _Digest()
            digest.add(repaired_lines(audit, symbols, zip(chunk.roles, chunk.texts), START))
            return {"conv": current[0], **_report(chunk, cost, audit, digest)}

        names = ("turn", "role", "text", "copies", "blank", "symbol")
        for batch in batches:
            convs = batch.column("conv").to_pylist()
            for conv, *values in zip(convs, *(batch.column(c).to_pylist() for c in names)):
                if current is None or conv != current[0]:
                    if current is not None:
                        out.append(open_part() if opening or number else closed())
                        held += chunk.size
                        opening = False
                    current, chunk, number = (conv,), _Chunk(), 0
                elif chunk.full():
                    out.append(open_part())
                    held += chunk.size
                    chunk, number = _Chunk(), number + 1
                chunk.add(*values)
                if len(out) >= 4096 or held >= CHUNK_BYTES:
                    yield _batch(out, schema)
                    out, held = [], 0
        if current is not None:
            out.append(open_part())
        if out:
            yield _batch(out, schema)
    return work


def _by_conversation(parts: DataFrame, *order: Column) -> DataFrame:
    return parts.repartition("conv").sortWithinPartitions("conv", *order)


def _costs_after(schema: T.StructType):
    """What follows every chunk, from the last chunk of a conversation to the first."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, after = None, ENDS
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if current is None or row["conv"] != current[0]:
                    current, after = (row["conv"],), ENDS
                out.append({**{c: row[c] for c in ("conv", "part", "chunk")}, "after": list(after)})
                costs = row["costs"]
                after = [min(NEVER, *(costs[4 * p + q] + after[q] for q in range(4))) for p in range(4)]
            yield _batch(out, schema)
    return work


def _traces(columns: list[str], schema: T.StructType):
    """Letters and last place of every chunk, from each place it can begin at."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tables()
        for batch in batches:
            for row in batch.to_pylist():
                found = [known.trace(row["symbols"], place, row["after"]) for place in range(4)]
                row["letters"] = [f[0] if f else None for f in found]
                row["places"] = [f[1] if f else -1 for f in found]
                row["prices"] = [f[2] if f else NEVER for f in found]
                yield _batch([{c: row[c] for c in columns}], schema)
    return work


def _joined(schema: T.StructType):
    """Conversations from their traced chunks in order: one chunk in memory at a time."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, total, digest, letters, place, cost = None, _Chunk(), _Digest(), [], START, 0

        def done() -> pa.RecordBatch:
            return _batch([{"conv": current[0], **_report(total, cost, "".join(letters), digest)}], schema)

        for batch in batches:
            for row in batch.to_pylist():
                if current is None or row["conv"] != current[0]:
                    if current is not None:
                        yield done()
                    current, total, digest, letters, place = (row["conv"],), _Chunk(), _Digest(), [], START
                    cost = row["prices"][START]
                chunk = _Chunk()
                for name in ("first", "last", "low", "high"):
                    setattr(chunk, name, row[name])
                for name in _FIGURES:
                    setattr(chunk, name, row[f"n_{name}"])
                total.join(chunk)
                found = row["letters"][place]
                digest.add(repaired_lines(found, row["symbols"], zip(row["roles"], row["texts"]), place))
                letters.append(found)
                place = row["places"][place]
        if current is not None:
            yield done()
    return work


def repair(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text, copies).

    ``copies`` says how often a row stands there; 0 tells only that its conversation exists.
    Returned: conv_id, gaps, the numbers of blank, duplicate and truncated rows and of illegal
    neighbours, the cost of the repair, its letters and the SHA-256 of the repaired turns.
    """
    turns = _with_faults(rows, scratch)
    conv = T.StructField("conv", turns.schema["conv"].dataType)
    key = [conv, *_PART.fields[:2]]
    both = T.StructType([conv, *_REPORT.fields, *_PART.fields])
    placed = turns.repartitionByRange("conv", "turn", "role", "digest").sortWithinPartitions(
        "conv", "turn", "role", "digest")
    found = scratch.write(placed.mapInArrow(_scan(both), both), "conversations")
    open_ = found.where(F.col("part").isNotNull()).select("conv", *_PART.names)
    after = T.StructType([*key, T.StructField("after", T.ArrayType(T.IntegerType()))])
    costs = _by_conversation(open_.select("conv", "part", "chunk", "costs"), F.desc("part"), F.desc("chunk"))
    costs = scratch.write(costs.mapInArrow(_costs_after(after), after), "costs")
    costs = costs.select(*[F.col(c).alias(f"__{c}") for c in ("conv", "part", "chunk")], "after")
    match = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in ("conv", "part", "chunk")]
    kept = [f for f in _PART.fields if f.name != "costs"]
    traced = T.StructType([conv, *kept, T.StructField("letters", T.ArrayType(T.StringType())),
                           T.StructField("places", T.ArrayType(T.IntegerType())),
                           T.StructField("prices", T.ArrayType(T.LongType()))])
    chunks = open_.join(costs, match[0] & match[1] & match[2]).mapInArrow(
        _traces(traced.names, traced), traced)
    report = T.StructType([conv, *_REPORT.fields])
    pieced = _by_conversation(chunks, F.col("part"), F.col("chunk")).mapInArrow(_joined(report), report)
    whole = found.where(F.col("part").isNull()).select("conv", *_REPORT.names)
    return whole.unionByName(pieced).withColumnRenamed("conv", "conv_id")
