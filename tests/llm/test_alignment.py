"""Alignment of two tokenizers against a plain computation, and its counts."""

import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillwright.llm import alignment, sentencepieces
from tillwright.llm.scratch import Scratch

LETTERS = "aAbeu é▁ß😀\x00\n\t  中文　\xa0<s></s><|endoftext|>the tion"


@pytest.fixture(scope="module")
def files():
    return alignment.Tokenizers.read()


@pytest.fixture(scope="module")
def of(files):
    return files.load()


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(alignment.BYTE_LEVEL)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=sentencepieces.MODEL)


def plain(text, libraries, of):
    """(n_a, n_b, groups, links) with the libraries' own encoders and sets of ends."""
    none = (0, 0, "", [])
    if not text:
        return none
    first, second = libraries
    a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
    whole = (" " + text).encode()

    def spelt(i):
        name = second.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if second.is_byte(i) else name.replace("▁", " ").encode()

    parts_a, parts_b = [of.a.names[i] for i in a], [spelt(i) for i in b]
    if b"".join(parts_a) != whole or b"".join(parts_b) != whole:
        return none
    ends_a, ends_b = (np.cumsum([len(p) for p in parts]).tolist() for parts in (parts_a, parts_b))
    groups, links, low = [], [], 0
    for cut in sorted(set(ends_a) & set(ends_b)):
        own_a = [i for i, e in zip(a, ends_a) if low < e <= cut]
        own_b = [i for i, e in zip(b, ends_b) if low < e <= cut]
        groups.append(",".join(map(str, own_a)) + "|" + ",".join(map(str, own_b)))
        links.append((own_a[-1], own_b[-1]))
        low = cut
    return len(a), len(b), ";".join(groups), links


def some_texts(n=300):
    rng = random.Random(1)
    texts = ["", " ", None, "a", "▁", "x ▁ y", "<s>hello<|endoftext|>world\n", "x" * 100 + " " + "aeiou" * 40,
             "é" * 60, "😀" * 70 + " a", "the thing of it, " * 300]
    return texts + ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 90))) for _ in range(n)]


def test_alignment(of, libraries):
    texts = some_texts()
    got = alignment.align_texts(pa.array(texts), of)
    for k, text in enumerate(texts):
        n_a, n_b, groups, links = plain(text, libraries, of)
        assert got.counts[k].tolist() == [n_a, n_b, len(links), len(links)], text
        assert got.groups[k] == groups
        own = of.pairs[got.pairs[got.bounds[k]:got.bounds[k + 1]]]
        assert [tuple(p) for p in own.tolist()] == links


def test_first_tokenizer_is_the_file(of, libraries):
    """The merges of A, where characters of any kind meet, are those of its own library."""
    points = [chr(c) for c in range(0x110000) if (c < 0x3200 or c % 37 == 0) and not 0xD800 <= c < 0xE000]
    for k in range(0, len(points), 2000):
        texts = ["a{0}b {0}1{0}{0} {0}\n{0} '{0}s  {0}.".format(c) for c in points[k:k + 2000]]
        want = [e.ids for e in libraries[0].encode_batch(texts, add_special_tokens=False)]
        assert [x.tolist() for x in of.a.encode(texts)] == want
    n = alignment.RUN
    for text in ("a " + " " * (n + 5) + "b", " " * (n + 10), "\n" * (n + 1) + "a", "x" + "　" * n + "\n"):
        assert of.a.encode([text])[0].tolist() == libraries[0].encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("lane", [1, 3, 7, 1000])
def test_lockstep(lane):
    rng = np.random.default_rng(lane)
    sizes = rng.integers(1, 60, 40)
    edges = np.concatenate([[0], np.cumsum(sizes)])
    a, b = (np.union1d(np.flatnonzero(rng.random(edges[-1]) < 0.4) + 1, edges[1:]) for _ in range(2))
    link_a, link_b = alignment.lockstep(a, b, edges, lane)
    both = np.intersect1d(a, b)
    assert a[link_a].tolist() == b[link_b].tolist() == both.tolist()


def test_counts_over_all_rows(spark, files, of, libraries):
    texts = some_texts(60) + ["the end", "the end", "the end of"]
    rows = [(i if i % 9 else None, t, "x", "y") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, pairs string, N_A string").repartition(5)
    scratch = Scratch(spark, "alignment-test")
    stored = scratch.write(alignment.align(df, files), "aligned")
    assert stored.columns == ["doc_id", "text", *alignment.COUNTS, "groups", "pairs"]
    got = alignment.judged(stored, files).collect()
    assert len(got) == len(rows)
    found = [plain(t, libraries, of) for t in texts]
    count, best = {}, {}
    for _, _, _, links in found:
        for link in links:
            count[link] = count.get(link, 0) + 1
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    want = sorted((str(t), n_a, n_b, g, sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links))
                  for t, (n_a, n_b, g, links) in zip(texts, found))
    assert sorted((str(r["text"]), r["n_a"], r["n_b"], r["groups"], r["n_best"], r["count_sum"])
                  for r in got) == want
    pairs = {(r["a_id"], r["b_id"]): r["n"] for r in alignment.pair_table(stored, files).collect()}
    assert pairs == count
    nothing = scratch.write(alignment.align(df.limit(0), files), "nothing")
    assert alignment.judged(nothing, files).count() == 0
    assert alignment.judged(stored.where(F.col("n_a") == 0), files).agg(F.sum("count_sum")).first()[0] == 0


def test_pairs_are_suffixes(of):
    a = of.a.names
    spelt = [of.b.model.text_bytes[x:y].tobytes() for x, y in zip(of.b.model.text_bounds, of.b.model.text_bounds[1:])]
    some = of.pairs[:: max(1, len(of.pairs) // 3000)]
    assert all(a[i].endswith(spelt[j]) or spelt[j].endswith(a[i]) for i, j in some.tolist())
