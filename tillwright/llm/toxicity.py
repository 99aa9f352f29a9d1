"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Examples are labelled texts, at most ``MAX_PER_LABEL`` of each label; copies of
each other all stay. Terms are all their words. A weight falls with the number of
documents of the whole corpus that hold the word; words whose presence goes with
the toxic label far beyond chance have it in full, others a tenth of it, so the cosine is
that of TF-IDF vectors with these factors. The nearest examples come from an inverted index
in blocks: the greatest weights of a block bound its cosines, and a block whose bound is
below the nearest found so far is skipped. Votes weigh by distance, chance matches little,
and a logistic curve, fitted on examples that are scored without themselves, turns a vote
into a probability.

Only the text decides a score. A text without any term, null and empty ones too,
gets the share of toxic texts among examples without a term. Equal texts get equal
scores; extra columns are kept, and a result column replaces an input column of
the same name. Without labelled rows the score is 0.5. An empty table gives an
empty result. Index and terms are bounded by the sample and sent to the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, fields, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwright.llm import tokens
from tillwright.llm.columns import draw_bits
from tillwright.llm.quality_classifier import held_out
from tillwright.llm.scratch import Scratch

MAX_PER_LABEL = 8192
MIN_TOXIC = 4          # toxic examples that must hold a word for its full weight
MIN_SCORE = 15.0       # chi-square of such a word against the label
MIN_LIFT = 3.0         # how much likelier a toxic example holds it
K = 16
OTHER = 0.1            # factor of the weights of all other words
COMMON = 1024          # terms in most examples, kept as a matrix too
TOGETHER = 256         # texts multiplied at once
BLOCK = 64             # examples in a block
AHEAD = 5              # one block in so many is added up before the first floor is known
WHOLE = 1 << 17        # postings of a text up to which they are added up at once
MARGIN = 1e-4          # above the error of a product in single precision
POWER = 2              # of the cosine in a vote
SOFTEN = 0.1           # added to a distance before it divides a vote
ACCEPT = 0.5
PIECE = 1 << 20


def _ranges(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers from ``first`` to before ``last``, and the range that each is of."""
    size = np.subtract(last, first, dtype=np.int64)
    end = np.cumsum(size)
    of = np.repeat(np.arange(len(size)), size)
    out = (first - end + size)[of]
    out += np.arange(len(out))
    return out, of


# --- vectors -----------------------------------------------------------------------


def places(hashes: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """Where hashes stand in the sorted ``terms``, or -1; their leading bits tell where to look."""
    shift = np.uint64(64 - max(len(terms).bit_length(), 1))
    first = np.append(0, np.cumsum(np.bincount((terms >> shift).astype(np.int64), minlength=1 << (64 - int(shift)))))
    bucket = (hashes >> shift).astype(np.int64)
    at, end = first[bucket], first[bucket + 1]
    out = np.full(len(hashes), -1, np.int64)
    open_ = np.flatnonzero(at < end)
    while len(open_):
        here = at[open_]
        hit = terms[here] == hashes[open_]
        out[open_[hit]] = here[hit]
        open_ = open_[~hit]
        at[open_] += 1
        open_ = open_[at[open_] < end[open_]]
    return out


def term_counts(texts: pa.Array, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, occurrences) of the sorted word hashes ``terms``."""
    found = tokens.words(texts, tokens.alphanumeric())
    if not len(terms) or not len(found.hashes):
        return (np.zeros(0, np.int64),) * 3
    at = places(found.hashes, terms)
    known = np.flatnonzero(at >= 0)
    pairs, n = np.unique(found.owners()[known] * len(terms) + at[known], return_counts=True)
    return pairs // len(terms), pairs % len(terms), n


def weights(text: np.ndarray, term: np.ndarray, n: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF weights, every text's vector scaled to length 1."""
    w = (1 + np.log(n)) * idf[term]
    if not len(w):
        return w
    length = np.sqrt(np.bincount(text, w * w))
    return w / length[text]


@dataclass
class Index:
    """Vectors of the examples as postings by term, in blocks of ``BLOCK`` examples.

    Every block of a term has its greatest weight. The terms that most examples hold also lie
    in a matrix in single precision: their part of all cosines is one product for many texts.
    Its greatest value in a block, and the greatest weights of the block for all other terms of
    a text, add up to a bound on the cosines of the block.
    """

    entries: np.ndarray   # where the block entries of a term begin
    block: np.ndarray     # of an entry: the block, its greatest weight, where its postings begin
    most: np.ndarray
    first: np.ndarray
    column: np.ndarray    # of a term in the matrix, or -1
    example: np.ndarray
    weight: np.ndarray
    label: np.ndarray
    prior: np.ndarray     # how many labelled texts an example stands for
    names: np.ndarray     # ids of the examples

    @classmethod
    def build(cls, row, term, weight, n_terms: int, label, prior, names) -> Index:
        """Examples with the same heaviest common term stand together, so that blocks differ."""
        n = len(label)
        held = np.bincount(term, minlength=n_terms)
        common = np.zeros(n_terms, bool)
        common[np.argsort(-held, kind="stable")[:COMMON]] = True
        heaviest = np.full(n, n_terms, np.int64)
        some = np.flatnonzero(common[term])
        some = some[np.lexsort((weight[some], row[some]))]
        heaviest[row[some]] = term[some]   # the last of a row is its heaviest
        by = np.lexsort((names, heaviest))
        place = np.empty(n, np.min_scalar_type(max(n, 1)))
        place[by] = np.arange(n)
        example = place[row]
        del row, some
        order = np.lexsort((example, term))
        term, example, weight = term[order], example[order], weight[order]
        del order
        block = (example // BLOCK).astype(np.min_scalar_type(max(n // BLOCK, 1)))
        new = np.append(True, (term[1:] != term[:-1]) | (block[1:] != block[:-1]))[:len(term)]
        first = np.flatnonzero(new)
        greatest = np.maximum.reduceat(weight, first) if len(first) else weight
        column = np.full(n_terms, -1, np.int32)
        column[common] = np.arange(common.sum())
        return cls(
            np.searchsorted(term[first], np.arange(n_terms + 1)).astype(np.int32), block[first],
            np.nextafter(greatest.astype(np.float32), np.float32(2)),
            np.append(first, len(term)).astype(np.int32), column, example, weight, label[by], prior[by],
            names[by])

    # What follows from the postings is not sent with them; tasks compute it once, the driver never.

    @cached_property
    def blocks(self) -> int:
        return -(-len(self.label) // BLOCK)

    @cached_property
    def common(self) -> np.ndarray:
        """The common terms of all examples, filled up to whole blocks."""
        out = np.zeros((self.blocks * BLOCK, int((self.column >= 0).sum())), np.float32)
        for term in np.flatnonzero(self.column >= 0):   # the postings of a term stand together
            mine = slice(*self.first[self.entries[term:term + 2]])
            out[self.example[mine], self.column[term]] = self.weight[mine]
        return out

    @cached_property
    def own(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same postings by example, for the exact cosines of a few: (edges, term, weight)."""
        by = np.argsort(self.example, kind="stable").astype(np.int32)
        edges = np.searchsorted(self.example[by], np.arange(self.blocks * BLOCK + 1))
        term = np.repeat(np.arange(len(self.column), dtype=np.int32), np.diff(self.first[self.entries]))
        return edges, term[by], self.weight[by]   # side by side: the exact cosines read whole examples

    @cached_property
    def _query(self) -> np.ndarray:
        return np.zeros(len(self.column))

    def __getstate__(self) -> dict:
        return {f.name: getattr(self, f.name) for f in fields(self)}

    def nearest(self, terms: np.ndarray, query: np.ndarray, k: int = K, skip: int = -1):
        """(cosine, example) of the ``k`` nearest, ties by id; example ``skip`` is left out."""
        return self.search(terms, query, k, skip)[:2]

    def common_parts(self, text: np.ndarray, terms: np.ndarray, query: np.ndarray, n: int) -> np.ndarray:
        """Per text and example, the part that common terms have in a cosine, in single precision."""
        column = self.column[terms]
        inside = column >= 0
        many = np.zeros((n, self.common.shape[1]), np.float32)
        many[text[inside], column[inside]] = query[inside]
        return many @ self.common.T

    def search(self, terms: np.ndarray, query: np.ndarray, k: int = K, skip: int = -1,
               common: np.ndarray | None = None):
        """(cosine, example, blocks not looked at): the ``k`` nearest, exactly.

        The blocks with the greatest bounds are looked at first. The ``k``-th cosine found is a
        floor for the others: a block whose bound is below it is skipped. Up to ``WHOLE`` postings
        are added up for all blocks at once, which costs less than to choose those of some. Single
        precision only chooses: the cosines of all examples within its error of the floor are
        computed anew from their own vectors.
        """
        if common is None:
            common = self.common_parts(np.zeros(len(terms), np.int64), terms, query, 1)[0]
        common = common.reshape(-1, BLOCK)
        blocks = len(common)
        others = np.flatnonzero(self.column[terms] < 0)
        entry, of = _ranges(self.entries[terms[others]], self.entries[terms[others] + 1])
        factor = query[others][of]
        block = self.block[entry]
        bounds = np.bincount(block, factor * self.most[entry], blocks) + common.max(axis=1)
        open_ = np.flatnonzero(bounds > 0)
        open_ = open_[np.argsort(-bounds[open_], kind="stable")]
        about = np.zeros((blocks, BLOCK))
        sums = self._sums(terms[others], query[others])
        looked, floor = 0, 0.0
        for ahead in (-(-blocks // AHEAD), len(open_)):
            some = open_[looked:max(ahead, looked)]
            some = some[bounds[some] >= floor - 2 * MARGIN]
            if not len(some):
                break
            if sums is None:
                self._add(about, entry, factor, block, some)
                about[some] += common[some]
            else:
                about[some] = sums[some] + common[some]
            if skip >= 0:
                about[skip // BLOCK, skip % BLOCK] = 0
            looked += len(some)
            best = about[open_[:looked]].ravel()
            floor = np.partition(best, len(best) - k)[len(best) - k] if len(best) > k else 0.0
        near = np.flatnonzero(about.ravel() >= max(floor - 2 * MARGIN, np.finfo(float).tiny))
        scores = self.cosines(near, terms, query)
        order = np.lexsort((self.names[near], -scores))[:k]
        return scores[order], near[order], blocks - looked

    def _sums(self, terms: np.ndarray, query: np.ndarray) -> np.ndarray | None:
        """All postings of ``terms`` added up, or None if they are many: those of a term stand together."""
        first, last = self.first[self.entries[terms]], self.first[self.entries[terms + 1]]
        if (last - first).sum(dtype=np.int64) > WHOLE:
            return None
        posting, of = _ranges(first, last)
        added = query[of]
        added *= self.weight[posting]
        return np.bincount(self.example[posting], added, self.blocks * BLOCK).reshape(-1, BLOCK)

    def _add(self, scores, entry, factor, block, some) -> None:
        """Add the postings of ``entry`` in the blocks ``some``, times ``factor``."""
        chosen = np.zeros(len(scores), bool)
        chosen[some] = True
        mine = np.flatnonzero(chosen[block])
        entry = entry[mine]
        posting, of = _ranges(self.first[entry], self.first[entry + 1])
        added = factor[mine][of]
        added *= self.weight[posting]
        scores += np.bincount(self.example[posting], added, scores.size).reshape(scores.shape)

    def cosines(self, examples: np.ndarray, terms: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Exact cosines of a few examples; equal vectors are added up in one order."""
        edges, own_term, own_weight = self.own
        posting, of = _ranges(edges[examples], edges[examples + 1])
        self._query[terms] = query
        parts = self._query[own_term[posting]] * own_weight[posting]
        self._query[terms] = 0
        return np.bincount(of, parts, len(examples))

    def vote(self, cosine: np.ndarray, example: np.ndarray, base: float) -> float:
        """Distance-weighted share of toxic neighbours, drawn towards ``base``.

        The power of the cosine leaves little weight to texts that are near by chance.
        """
        cosine = np.minimum(cosine, 1)
        w = self.prior[example] * cosine ** POWER / (SOFTEN + 1 - cosine)
        return float((w @ self.label[example] + base) / (w.sum() + 1))


@dataclass
class Model:
    terms: np.ndarray
    idf: np.ndarray
    index: Index | None
    base: float
    without: float        # toxic share of examples without a term
    slope: float = 1.0
    offset: float = 0.0
    held: Broadcast | None = None   # the model without its curve, as tasks already have it

    def __getstate__(self) -> dict:
        return {**self.__dict__, "held": None}

    def probability(self, vote: float) -> float:
        vote = min(max(vote, 1e-6), 1 - 1e-6)
        return float(1 / (1 + np.exp(-(self.offset + self.slope * np.log(vote / (1 - vote))))))

    def neighbours(self, texts: pa.Array, names: np.ndarray | None = None):
        """(text, cosine, example, blocks skipped) of the texts that hold a term.

        ``names`` are the ids of examples that are not to find themselves.
        """
        text, term, n = term_counts(texts, self.terms)
        w = weights(text, term, n, self.idf)
        found = np.unique(text)
        edges = np.searchsorted(text, np.append(found, len(texts)))
        own = np.full(len(found), -1)
        if names is not None:
            order = np.argsort(self.index.names, kind="stable")
            own = order[np.searchsorted(self.index.names, names[found], sorter=order)]
        for low in range(0, len(found), TOGETHER):
            high = min(low + TOGETHER, len(found))
            a, b = edges[low], edges[high]
            parts = self.index.common_parts(
                np.repeat(np.arange(high - low), np.diff(edges[low:high + 1])), term[a:b], w[a:b], high - low)
            for j in range(low, high):
                mine = slice(edges[j], edges[j + 1])
                yield int(found[j]), *self.index.search(term[mine], w[mine], skip=int(own[j]), common=parts[j - low])

    def score(self, texts: pa.Array) -> tuple[np.ndarray, list[list], np.ndarray]:
        """Score, the ids of the nearest examples, and the blocks skipped, of every text."""
        scores, evidence = np.full(len(texts), self.without), [[] for _ in range(len(texts))]
        skipped = np.zeros(len(texts), np.int32)
        for i, cosine, example, blocks in self.neighbours(texts) if self.index else ():
            skipped[i] = blocks
            if len(example):
                scores[i] = self.probability(self.index.vote(cosine, example, self.base))
                evidence[i] = self.index.names[example].tolist()
        return scores, evidence, skipped


# --- fitting -----------------------------------------------------------------------


def examples(docs: DataFrame, labels: DataFrame, label: str, key: str, text: str, most: int,
             scratch: Scratch) -> DataFrame:
    """(id, text, label, prior) of labelled rows that are not held out, copies included.

    ``prior`` is the number of labelled rows that one of them stands for. An id counts once: of
    rows that repeat it, the one with the smallest label, then the smallest text.
    """
    usable = labels.select(F.col(f"`{key}`").alias("id"), F.col(f"`{label}`").cast("int").alias("label")).where(
        F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("id"))).distinct()
    counts = {r["label"]: r["n"] for r in usable.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = {k: min(1.0, most / n) for k, n in counts.items()}
    limit = F.when(F.col("label") == 1, F.lit(int(share.get(1, 1) * (1 << 52)))).otherwise(
        F.lit(int(share.get(0, 1) * (1 << 52))))
    prior = F.when(F.col("label") == 1, F.lit(1 / share.get(1, 1))).otherwise(F.lit(1 / share.get(0, 1)))
    chosen = usable.where(draw_bits(F.col("id"), F.lit("examples")) < limit)
    found = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).join(
        F.broadcast(chosen), F.col("doc_id") == F.col("id"))
    rows = found.groupBy("id").agg(F.min(F.struct("label", "text", prior.alias("prior"))).alias("r")).select(
        "id", "r.text", "r.label", "r.prior")
    return scratch.write(rows, "examples")


def select_terms(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """All word hashes of the examples, sorted, and the factor of each word's weight."""
    def distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in tokens.pieces(batch, "text", PIECE):
                found = tokens.words(piece.column("text"), tokens.alphanumeric())
                label = piece.column("label").to_numpy()
                kept = [np.unique(found.hashes[a:b])
                        for a, b in zip(found.bounds[:-1], found.bounds[1:])]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate(kept).view(np.int64)),
                    pa.array(np.repeat(label, [len(x) for x in kept]).astype(np.int64)),
                ], ["term", "label"])

    total = rows.agg(F.count("*").alias("n"), F.sum("label").alias("t")).first()
    n, toxic = float(total["n"]), float(total["t"] or 0)
    held = rows.select("text", "label").mapInArrow(distinct_words, "term long, label long").groupBy(
        "term").agg(F.sum("label").cast("int").alias("a"), F.count("*").cast("int").alias("h")).toArrow()
    terms = held.column("term").to_numpy().view(np.uint64)
    order = np.argsort(terms)
    a, h = (held.column(c).to_numpy()[order].astype(float) for c in ("a", "h"))
    factor = np.full(len(terms), OTHER)
    if 0 < toxic < n:
        clean_rate = (h - a + 0.5) / (n - toxic + 1)
        some = (a >= MIN_TOXIC) & (h < n) & (a / toxic > MIN_LIFT * clean_rate)
        a, h = a[some], h[some]
        chi = n * (a * n - h * toxic) ** 2 / (h * (n - h) * toxic * (n - toxic))
        factor[np.flatnonzero(some)[chi >= MIN_SCORE]] = 1.0
    return terms[order], factor


def document_frequencies(docs: DataFrame, text: str, terms: np.ndarray) -> tuple[np.ndarray, int]:
    """In how many documents of the whole corpus each term stands, and their number."""
    held = docs.sparkSession.sparkContext.broadcast(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(len(held.value), np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for piece in tokens.pieces(batch, "text", PIECE):
                _, term, _ = term_counts(piece.column("text"), held.value)
                total += np.bincount(term, minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.append(some, -1)), pa.array(np.append(total[some], rows))], ["term", "n"])

    sums = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(count, "term long, n long").groupBy(
        "term").agg(F.sum("n").alias("n")).toArrow()
    by_term = np.zeros(len(terms) + 1, np.int64)  # the number of documents stands last
    by_term[sums.column("term").to_numpy()] = sums.column("n").to_numpy()
    held.unpersist()
    return by_term[:-1], int(by_term[-1])


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id",
    text: str = "text", most: int = MAX_PER_LABEL,
) -> Model:
    scratch = Scratch(docs.sparkSession, "toxicity")
    rows = examples(docs, labels, label, key, text, most, scratch)
    terms, factor = select_terms(rows)
    shares = rows.groupBy("label").agg(F.sum("prior").alias("n")).collect()
    by_label = {r["label"]: r["n"] for r in shares}
    base = by_label.get(1, 0.0) / sum(by_label.values()) if by_label else 0.5
    if not len(terms):
        scratch.close()
        return Model(terms, np.zeros(0), None, base, base)
    df, n_docs = document_frequencies(docs, text, terms)
    idf = (np.log((1 + n_docs) / (1 + df)) + 1) * factor
    model = _indexed(rows, terms, idf, base)
    scratch.close()
    return model


def _indexed(rows: DataFrame, terms: np.ndarray, idf: np.ndarray, base: float) -> Model:
    """The bounded sample of examples as vectors, which tasks compute; their texts stay there."""
    held = rows.sparkSession.sparkContext.broadcast((terms, idf))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, idf = held.value
        for batch in batches:
            for piece in tokens.pieces(batch, "text", PIECE):
                text, term, n = term_counts(piece.column("text"), terms)
                cuts = pa.array(np.searchsorted(text, np.arange(piece.num_rows + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    piece.column("id"), piece.column("label"), piece.column("prior"),
                    pa.ListArray.from_arrays(cuts, pa.array(term.astype(np.int32))),
                    pa.ListArray.from_arrays(cuts, pa.array(weights(text, term, n, idf))),
                ], ["id", "label", "prior", "term", "weight"])

    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(
        vectors, f"id {kind}, label int, prior double, term array<int>, weight array<double>").toArrow()
    names, label, prior = (found.column(c).to_numpy() for c in ("id", "label", "prior"))
    names, label = (names.astype(str) if names.dtype == object else names), label.astype(float)
    sizes = pc.list_value_length(found.column("term")).to_numpy()
    none, some = sizes == 0, np.flatnonzero(sizes)
    # One text counts as unseen evidence either way, so no share is exactly 0 or 1.
    without = float((prior[none] @ label[none] + base) / (prior[none].sum() + 1))
    if not len(some):
        return Model(terms, idf, None, base, without)
    row = np.repeat(np.arange(len(some), dtype=np.int32), sizes[some])
    term, weight = (pc.list_flatten(found.column(c)).to_numpy() for c in ("term", "weight"))
    postings = [weight, term, row]
    del found, row, term, weight
    pa.default_memory_pool().release_unused()
    # Handed over: the driver is to hold one copy while it sorts.
    index = Index.build(postings.pop(), postings.pop(), postings.pop(), len(terms), label[some], prior[some],
                        names[some])
    model = Model(terms, idf, index, base, without)
    held.unpersist()
    model.held = rows.sparkSession.sparkContext.broadcast(model)
    model.slope, model.offset = _calibrated(rows, model)
    return model


def _calibrated(rows: DataFrame, model: Model) -> tuple[float, float]:
    """Logistic curve over the votes of examples, each scored without itself, by tasks."""
    held = model.held

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            for piece in tokens.pieces(batch, "text", PIECE):
                names = piece.column("id").to_numpy(zero_copy_only=False)
                names = names.astype(str) if names.dtype == object else names
                places, logits = [], []
                for i, cosine, example, _ in model.neighbours(piece.column("text"), names):
                    vote = model.index.vote(cosine, example, model.base) if len(example) else model.base
                    places.append(i)
                    logits.append(np.log(max(vote, 1e-6) / max(1 - vote, 1e-6)))
                kept = piece.take(pa.array(places, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [kept.column("id"), kept.column("label"), kept.column("prior"), pa.array(logits, pa.float64())],
                    ["id", "label", "prior", "x"])

    kind = rows.schema["id"].dataType.simpleString()
    # Spread: the sample may lie in one file, and every example is a search.
    found = rows.repartition(rows.sparkSession.sparkContext.defaultParallelism * 2, "id").mapInArrow(
        votes, f"id {kind}, label int, prior double, x double").toArrow().sort_by("id")
    x, y, p = (found.column(c).to_numpy().astype(float) for c in ("x", "label", "prior"))
    # Two pseudo-examples hold the slope near 1 where all votes agree.
    slope, offset = 1.0, 0.0
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(offset + slope * x, -30, 30)))
        g = np.array([(p * (y - q) * x).sum() - (slope - 1), (p * (y - q)).sum() - offset])
        v = p * q * (1 - q)
        h = np.array([[(v * x * x).sum() + 1, (v * x).sum()], [(v * x).sum(), v.sum() + 1]])
        step = np.linalg.solve(h, g)
        slope, offset = slope + step[0], offset + step[1]
        if np.abs(step).max() < 1e-8:
            break
    return (float(slope), float(offset)) if np.isfinite(slope) and slope > 0 else (1.0, 0.0)


# --- scoring -----------------------------------------------------------------------


def classify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with score, predicted, evidence (ids of the nearest examples) and blocks_skipped."""
    held = model.held or docs.sparkSession.sparkContext.broadcast(model)
    slope, offset = model.slope, model.offset
    columns = [c for c in docs.columns if c.lower() not in ("score", "evidence", "predicted", "blocks_skipped")]
    kind = T.LongType() if model.index is None or model.index.names.dtype.kind in "iu" else T.StringType()
    arrow = pa.int64() if isinstance(kind, T.LongType) else pa.string()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = replace(held.value, slope=slope, offset=offset)
        for batch in batches:
            for piece in tokens.pieces(batch, "__text", PIECE):
                scores, evidence, skipped = model.score(piece.column("__text"))
                yield pa.RecordBatch.from_arrays(
                    [piece.column(c) for c in columns]
                    + [pa.array(scores), pa.array(evidence, pa.list_(arrow)), pa.array(skipped)],
                    columns + ["score", "evidence", "blocks_skipped"])

    fields = [docs.schema[c] for c in columns]
    schema = T.StructType(fields + [T.StructField("score", T.DoubleType()),
                                    T.StructField("evidence", T.ArrayType(kind)),
                                    T.StructField("blocks_skipped", T.IntegerType())])
    source = docs.select(*[F.col(f"`{c}`") for c in columns], F.col(f"`{text}`").alias("__text"))
    return source.mapInArrow(score, schema).withColumn(
        "predicted", (F.col("score") >= ACCEPT).cast("int"))
