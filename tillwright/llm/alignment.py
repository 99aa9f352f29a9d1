"""Which tokens of two tokenizers stand for the same bytes.

Tokenizer A is a byte-level BPE (a ``tokenizers`` JSON file) and encodes a space and
the text; tokenizer B is a SentencePiece BPE, which adds the space itself. Both cut
the same bytes. Where tokens of both end at the same byte is a cut: the tokens since
the last cut form a group, and the two tokens that end there are linked.

The ends of all documents of a piece are merged in lockstep. One state vector holds
a pair of pointers per lane; in every step the pointer whose token ends first moves
on, both move where the ends are equal, which emits a link and a cut, and finished
lanes leave the vector. A lane is a document, or ``LANE`` bytes of a long one: an end
is a cut or not whatever lies before it, so a long document does not keep the others
waiting.

Of two linked tokens the shorter is a suffix of the longer. So the two vocabularies
alone say which pairs of ids can be linked (324,298 for the public files),
and that bounds the table of corpus-wide counts, which is sent to all tasks.

Texts that are null or empty, and those whose tokens do not spell the space and the
text (U+2581 in a text is a space to B), have no tokens: zero counts, empty lists and
empty groups. Repeated rows are repeated results and count in the corpus each.
Extra columns stay; a result column replaces an input column of its name. An empty
table gives an empty result. Special tokens in a text are plain text.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwright.llm import sentencepieces, tokens
from tillwright.llm.training_order import PATTERN

BYTE_LEVEL = "/opt/tokenizers/byte_bpe_50k.json"
LANE = 1024
RUN = 100_000
# The characters that are white space in Unicode.
_LONG_RUN = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % RUN)
PIECE = 1 << 19
COUNTS = ("n_a", "n_b", "n_groups", "n_links")
ADDED = (*COUNTS, "groups", "pairs")


# --- the two vocabularies --------------------------------------------------------------


def _byte_of_character() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class ByteLevel:
    """Tokenizer A: its ids and their bytes."""

    def __init__(self, data: bytes):
        import tiktoken

        spec = json.loads(data)
        split = spec["pre_tokenizer"] or {}
        if (spec["model"]["type"] != "BPE" or spec["normalizer"] or split.get("type") != "ByteLevel"
                or split.get("add_prefix_space") or not split.get("use_regex", True)):
            raise ValueError("not a byte-level BPE without normalisation")
        byte = _byte_of_character()
        special = {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(byte[c] for c in name): i
                 for name, i in spec["model"]["vocab"].items() if name not in special}
        # A merge must have the rank of the id it makes; then ids and ranks are the same.
        made = []
        for merge in spec["model"]["merges"]:
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            made.append(ranks[bytes(byte[c] for c in left + right)])
        if made != sorted(made):
            raise ValueError("the merges do not stand in the order of their ids")
        self.encoding = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.names = [b""] * (1 + max(ranks.values()))
        for name, i in ranks.items():
            self.names[i] = name

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self._encoded(t) for t in texts]

    def _encoded(self, text: str) -> np.ndarray:
        # The pattern takes a run of spaces whole, or all but its last before other text. A run
        # that is too long for the stack of the pattern matcher is merged without it.
        parts, at = [], 0
        for run in _LONG_RUN.finditer(text) if len(text) > RUN else ():
            end = run.end() - (run.end() < len(text))
            parts.append(self.encoding.encode_to_numpy(text[at:run.start()], disallowed_special=()))
            parts.append(self.encoding._core_bpe.encode_single_piece(text[run.start():end].encode()))
            at = end
        parts.append(self.encoding.encode_to_numpy(text[at:], disallowed_special=()))
        return parts[0] if len(parts) == 1 else np.concatenate(parts)


class Spelling:
    """Bytes of all ids of a vocabulary, to spell lists of ids."""

    def __init__(self, names: list[bytes]):
        self.data = np.frombuffer(b"".join(names), np.uint8)
        self.size = np.array([len(n) for n in names], np.int64)
        self.first = np.cumsum(self.size) - self.size

    def spell(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        take = np.arange(size.sum()) + np.repeat(self.first[ids] - np.cumsum(size) + size, size)
        return self.data[take]


def possible_pairs(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Rows (id of A, id of B), sorted, of all tokens of which one ends with the other."""
    of_a: dict[bytes, list[int]] = {}
    of_b: dict[bytes, list[int]] = {}
    for names, by_name in ((a, of_a), (b, of_b)):
        for i, name in enumerate(names):
            if name:
                by_name.setdefault(name, []).append(i)
    found = {(i, j) for name, ids in of_a.items() for k in range(len(name))
             for j in of_b.get(name[k:], ()) for i in ids}
    found |= {(i, j) for name, ids in of_b.items() for k in range(len(name))
              for i in of_a.get(name[k:], ()) for j in ids}
    return np.array(sorted(found), np.int64).reshape(-1, 2)


class Both:
    """The two tokenizers and the pairs their tokens can form."""

    def __init__(self, byte_level: bytes, model: bytes):
        self.a = ByteLevel(byte_level)
        self.b = sentencepieces.Encoder(sentencepieces.parse(model))
        names, held = self.b.model, self.b.model.text_bounds
        spelt = [names.text_bytes[x:y].tobytes() for x, y in zip(held[:-1], held[1:])]
        self.spell_a, self.spell_b = Spelling(self.a.names), Spelling(spelt)
        self.pairs = possible_pairs(self.a.names, spelt)
        self.width = len(spelt)
        self.keys = self.pairs[:, 0] * self.width + self.pairs[:, 1]


@functools.lru_cache(maxsize=2)
def both(byte_level: bytes, model: bytes) -> Both:
    return Both(byte_level, model)


# --- merging ---------------------------------------------------------------------------


def lockstep(a_ends: np.ndarray, b_ends: np.ndarray, edges: np.ndarray, lane: int = LANE):
    """Numbers of the tokens of A and B that end together, in order.

    ``a_ends`` and ``b_ends`` rise over all documents on end; ``edges`` are the bounds of
    the documents in bytes.
    """
    per = -(-np.diff(edges) // lane)
    starts = np.repeat(edges[:-1], per) + lane * (np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per))
    stops = np.append(starts[1:], edges[-1:])
    at_a, at_b = (np.searchsorted(x, starts, "right") for x in (a_ends, b_ends))
    to_a, to_b = (np.searchsorted(x, stops, "right") for x in (a_ends, b_ends))
    links_a, links_b = [], []
    while True:
        alive = (at_a < to_a) & (at_b < to_b)
        if not alive.all():
            at_a, at_b, to_a, to_b = at_a[alive], at_b[alive], to_a[alive], to_b[alive]
        if not len(at_a):
            break
        end_a, end_b = a_ends[at_a], b_ends[at_b]
        met = end_a == end_b
        links_a.append(at_a[met])
        links_b.append(at_b[met])
        at_a = at_a + (end_a <= end_b)
        at_b = at_b + (end_b <= end_a)
    if not links_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    links_a, links_b = np.concatenate(links_a), np.concatenate(links_b)
    order = np.argsort(links_a, kind="stable")
    return links_a[order], links_b[order]


_WIDTH = 7
_DIGITS: list[np.ndarray] = []


def _digits(most: int) -> np.ndarray:
    """Decimal digits of all ids below ``most``, left-aligned."""
    if not _DIGITS or len(_DIGITS[0]) < most:
        text = "".join(str(i).ljust(_WIDTH, "\0") for i in range(most))
        _DIGITS[:] = [np.frombuffer(text.encode(), np.uint8).reshape(-1, _WIDTH)]
    return _DIGITS[0]


def group_texts(a: np.ndarray, b: np.ndarray, link_a: np.ndarray, link_b: np.ndarray,
                first_a: np.ndarray, first_b: np.ndarray) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` of every document, whose tokens begin at ``first_a`` and ``first_b``."""
    number_a, number_b = np.arange(len(a)), np.arange(len(b))
    group_a, group_b = np.searchsorted(link_a, number_a), np.searchsorted(link_b, number_b)
    place_a = number_a + np.append(0, link_b + 1)[group_a]
    place_b = number_b + link_a[group_b] + 1
    ids = np.empty(len(a) + len(b), np.int64)
    mark = np.full(len(ids), ord(","), np.uint8)
    ids[place_a], ids[place_b] = a, b
    mark[place_a[link_a]] = ord("|")
    mark[place_b[link_b]] = ord(";")
    text = _digits(int(ids.max(initial=0)) + 1)[ids].copy()
    size = (text != 0).sum(axis=1)
    text[np.arange(len(ids)), size] = mark
    blob = text[text != 0].tobytes().decode("ascii")
    cuts = np.concatenate([[0], np.cumsum(size + 1)])[first_a + first_b].tolist()
    return [blob[x:max(y - 1, x)] for x, y in zip(cuts, cuts[1:])]


@dataclass
class Aligned:
    counts: np.ndarray       # (documents, n_a n_b n_groups n_links)
    groups: list[str]
    pairs: np.ndarray        # numbers of the linked pairs, document by document
    bounds: np.ndarray       # where those of a document begin


def align_texts(texts: pa.Array, of: Both) -> Aligned:
    """The alignment of one piece of documents."""
    data, edges = sentencepieces.flat(texts)
    n = len(texts)
    spaced = np.insert(data, edges[:-1], 0x20) if n else data
    edges = edges + np.arange(n + 1)
    lists = of.a.encode([" " + t for t in texts.fill_null("").to_pylist()])
    a_first = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
    a = np.concatenate([np.zeros(0, np.int64), *lists]).astype(np.int64)
    found = of.b.encode(texts)
    b, b_first = found.ids.astype(np.int64), found.bounds
    filled = np.diff(edges) > 1
    for ids, first, vocabulary in ((a, a_first, of.spell_a), (b, b_first, of.spell_b)):
        sums = np.concatenate([[0], np.cumsum(vocabulary.size[ids])])
        filled &= np.diff(sums[first]) == np.diff(edges)

    def kept(ids: np.ndarray, first: np.ndarray, keep: np.ndarray):
        return ids[np.repeat(keep, np.diff(first))], np.concatenate([[0], np.cumsum(np.diff(first) * keep)])

    # Texts of the right length can still be spelt otherwise.
    a, a_first = kept(a, a_first, filled)
    b, b_first = kept(b, b_first, filled)
    spaced, edges = kept(spaced, edges, filled)
    differs = (of.spell_a.spell(a) != spaced) | (of.spell_b.spell(b) != spaced)
    if differs.any():
        same = np.diff(np.concatenate([[0], np.cumsum(differs)])[edges]) == 0
        a, a_first = kept(a, a_first, same)
        b, b_first = kept(b, b_first, same)
        spaced, edges = kept(spaced, edges, same)
    link_a, link_b = lockstep(np.cumsum(of.spell_a.size[a]), np.cumsum(of.spell_b.size[b]), edges)
    bounds = np.searchsorted(link_a, a_first)
    n_links = np.diff(bounds)
    counts = np.stack([np.diff(a_first), np.diff(b_first), n_links, n_links], axis=1)
    pairs = np.searchsorted(of.keys, a[link_a] * of.width + b[link_b])
    return Aligned(counts, group_texts(a, b, link_a, link_b, a_first, b_first), pairs, bounds)


# --- on tables -------------------------------------------------------------------------


@dataclass
class Tokenizers:
    """Contents of the two files, sent to the tasks; their size bounds what is broadcast."""

    byte_level: bytes
    model: bytes

    @classmethod
    def read(cls, byte_level: str = BYTE_LEVEL, model: str = sentencepieces.MODEL) -> Tokenizers:
        return cls(sentencepieces.read_model(byte_level), sentencepieces.read_model(model))

    def load(self) -> Both:
        return both(self.byte_level, self.model)


def align(docs: DataFrame, files: Tokenizers, text: str = "text",
          columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``docs`` (all) with n_a, n_b, n_groups, n_links, groups and pairs.

    ``groups`` is the alignment as text, ``pairs`` has the number of the pair of every
    link, as :func:`pair_table` numbers them.
    """
    held = docs.sparkSession.sparkContext.broadcast(files)
    columns = [c for c in columns or docs.columns if c.lower() not in ADDED]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = held.value.load()
        for batch in batches:
            for piece in tokens.pieces(batch, "__text", PIECE):
                done = align_texts(piece.column("__text"), of)
                pairs = pa.ListArray.from_arrays(
                    pa.array(done.bounds.astype(np.int32)), pa.array(done.pairs.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [piece.column(c) for c in columns]
                    + [pa.array(np.ascontiguousarray(x)) for x in done.counts.T]
                    + [pa.array(done.groups, pa.string()), pairs], [*columns, *ADDED])

    fields = [docs.schema[c] for c in columns]
    fields += [T.StructField(c, T.LongType()) for c in COUNTS]
    fields += [T.StructField("groups", T.StringType()), T.StructField("pairs", T.ArrayType(T.IntegerType()))]
    source = docs.select(*[F.col(f"`{c}`") for c in columns], F.col(f"`{text}`").alias("__text"))
    return source.mapInArrow(work, T.StructType(fields))


def pair_counts(aligned: DataFrame, files: Tokenizers) -> np.ndarray:
    """How many links of all rows hold each possible pair.

    Every task adds up its own links, so at most one row per task and possible pair is
    shuffled, and at most one per possible pair comes back.
    """
    size = len(files.load().pairs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column("pairs").flatten().to_numpy(), minlength=size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["pair", "n"])

    sums = aligned.select("pairs").mapInArrow(count, "pair long, n long").groupBy("pair").agg(
        F.sum("n").alias("n")).toArrow()
    out = np.zeros(size, np.int64)
    out[sums.column("pair").to_numpy()] = sums.column("n").to_numpy()
    return out


def pair_table(aligned: DataFrame, files: Tokenizers) -> DataFrame:
    """(a_id, b_id, n) of all linked pairs, from the corpus-wide counts."""
    counts, pairs = pair_counts(aligned, files), files.load().pairs
    some = np.flatnonzero(counts)
    rows = pa.table({"a_id": pairs[some, 0], "b_id": pairs[some, 1], "n": counts[some]})
    return aligned.sparkSession.createDataFrame(rows)


def judged(aligned: DataFrame, files: Tokenizers) -> DataFrame:
    """``aligned`` with n_best and count_sum in place of pairs.

    ``n_best`` counts links whose pair is the most frequent one of its id of B in all rows,
    ties included; ``count_sum`` adds up the counts of the pairs of all links. ``aligned``
    is read twice and should be a stored table.
    """
    counts, of_b = pair_counts(aligned, files), files.load().pairs[:, 1]
    best = np.zeros(of_b.max(initial=0) + 1, np.int64)
    np.maximum.at(best, of_b, counts)
    held = aligned.sparkSession.sparkContext.broadcast((counts, counts == best[of_b]))
    columns = [c for c in aligned.columns if c.lower() not in ("pairs", "n_best", "count_sum")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, is_best = held.value
        for batch in batches:
            lists = batch.column("pairs")
            links = lists.flatten().to_numpy()
            cuts = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            sums = [np.diff(np.concatenate([[0], np.cumsum(x[links], dtype=np.int64)])[cuts])
                    for x in (is_best, counts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in columns] + [pa.array(x) for x in sums],
                [*columns, "n_best", "count_sum"])

    fields = [aligned.schema[c] for c in columns]
    fields += [T.StructField(c, T.LongType()) for c in ("n_best", "count_sum")]
    return aligned.mapInArrow(work, T.StructType(fields))
