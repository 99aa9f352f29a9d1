"""Shards of token ids: a bijection, an exact round trip, resumable reads."""

import numpy as np
import pyarrow as pa
import pytest

from tillwright.llm import training_order as order


@pytest.mark.parametrize("size", [1, 2, 3, 17, 1000, 4097])
def test_permutation(size):
    slots = order.permuted(np.arange(size), size)
    assert sorted(slots.tolist()) == list(range(size))
    if size > 100:
        assert (slots != np.arange(size)).mean() > 0.9
        assert (order.permuted(np.arange(size), size, key=5) != slots).any()


def docs(spark):
    long = "the quick brown fox\njumps over 12 dogs; " * 400
    rows = [(1, "hello world", "x"), (2, "", "x"), (3, None, "x"), (4, long, "y"),
            (5, "été ñandú 😀\r\n\t", "y"), (6, long, "z")]
    rows += [(i, f"text number {i} " * (i % 9), None) for i in range(10, 60)]
    return spark.createDataFrame(rows, "doc_id long, text string, slot string"), rows


def test_round_trip(spark, folder):
    df, rows = docs(spark)
    path = f"{folder}/shards"
    stored = f"{folder}/docs"
    df.repartition(3).write.parquet(stored)
    total = order.write(spark.read.parquet(stored), path, length=32, shard=50)
    back = order.read(spark, path, length=32, shard=50).cache()
    slots = sorted(r["slot"] for r in back.select("slot").collect())
    assert slots == list(range(total))
    got = {r["doc_id"]: r["text"] for r in order.texts(back).collect()}
    assert got == {i: t or "" for i, t, _ in rows}
    # A resumed read continues where an earlier one stopped, with the same records.
    whole = {r["slot"]: tuple(r) for r in back.collect()}
    later = {r["slot"]: tuple(r) for r in order.read(spark, path, 77, 32, 50).collect()}
    assert later == {s: r for s, r in whole.items() if s >= 77}


def test_reruns_agree(spark, folder):
    df, _ = docs(spark)
    df.repartition(3).write.parquet(f"{folder}/docs")
    runs = []
    for name in "ab":
        order.write(spark.read.parquet(f"{folder}/docs"), f"{folder}/{name}", length=32, shard=50)
        runs.append(sorted(map(tuple, order.read(spark, f"{folder}/{name}", 0, 32, 50).collect())))
    assert runs[0] == runs[1]


def test_empty_and_null_ids(spark, folder):
    schema = "doc_id long, text string"
    assert order.write(spark.createDataFrame([], schema), f"{folder}/none") == 0
    spark.createDataFrame([(None, "a b"), (None, "a b")], schema).write.parquet(f"{folder}/nulls")
    assert order.write(spark.read.parquet(f"{folder}/nulls"), f"{folder}/two") == 2
    assert [r["doc_id"] for r in order.read(spark, f"{folder}/two").collect()] == [None, None]


def test_remembered_words_give_the_tokens_of_whole_texts():
    tokenizer = order._tokenizer(order.VOCABULARY)
    rng = np.random.default_rng(1)
    marks = list(" \t\n\r\x1c\x1f\x85\xa0    　​'stdllàA1½!?,😀日\x00́") + ["  ", "'s ", " é"]
    texts = ["".join(rng.choice(marks, n)) for n in rng.integers(0, 15, 4000)] + [None, "", " ", "a b " * 900]
    words = order._Words(tokenizer)
    for given in (texts, texts[::-1], [], [None]):
        all_, bounds = words.tokens(pa.array(given, pa.string()))
        got = [all_[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
        assert got == [tokenizer.encode_ordinary(t or "") for t in given]


def test_words_are_tokenized_once_and_compared_with_the_text():
    words = order._Words(order._tokenizer(order.VOCABULARY))
    texts = pa.array(["unheard words are learned", "once, unheard words"])
    first, encode, calls = words.tokens(texts)[0].tolist(), words.encode, []
    words.encode = lambda t: calls.append(t) or encode(t)
    assert words.tokens(texts)[0].tolist() == first and set(calls) <= {""}
    words.pool[:] = words.pool[::-1].copy()   # as if other words had these hashes
    assert words.tokens(texts)[0].tolist() == first
