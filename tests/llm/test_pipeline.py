"""Every stage of the pipeline against a plain computation of the same, on its own input."""

import os
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_edges import GAP, brute_components, brute_hits, brute_targets

import corpus_pipeline
from tillwright.llm import quality_classifier

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows of the input and of every stage's result, each stage reading the one before."""
    base = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [(docs.columns, docs.collect())]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
        out.append((docs.columns, docs.collect()))
    return out


def ids(rows):
    return Counter(r["doc_id"] for r in rows)


def test_columns(stages):
    assert all(columns == stages[0][0] for columns, _ in stages[:-1])


def test_quality(spark, stages):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    model = quality_classifier.fit(docs, labels)
    scored = quality_classifier.classify(docs, model).select("doc_id", "predicted")
    assert ids(stages[1][1]) == ids(scored.where("predicted = 1").collect())
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    left = ids(stages[1][1])
    good = [i for i, q in truth.items() if q == 1]
    assert sum(i in left for i in good) >= 0.97 * len(good)


def test_near_duplicates(stages):
    before = [(r["doc_id"], r["text"], None) for r in stages[1][1]]
    want = brute_components(before, 5, 80)
    assert ids(stages[2][1]) == Counter(i for i, (_, c) in want.items() if i == c)


def test_decontamination(spark, stages):
    items = [(r["item_id"], r["text"]) for r in
             spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    want = [r["doc_id"] for r in stages[2][1] if not brute_hits(r["text"], items, 10)[2]]
    assert ids(stages[3][1]) == Counter(want)
    assert len(want) < len(stages[2][1])


def test_mixing(stages):
    before, after = stages[3][1], ids(stages[4][1])
    words = {r["doc_id"]: len(re.findall(GAP, r["text"] or "")) for r in before}
    sizes, taken = Counter(), Counter()
    for r in before:
        sizes[r["source"]] += words[r["doc_id"]]
        taken[r["source"]] += words[r["doc_id"]] * after[r["doc_id"]]
    assert set(after) <= set(words) and max(after.values()) <= 3
    for source, target in brute_targets(dict(sizes)).items():
        # No choice of documents after the whole passes comes nearer.
        passes = min(3, int(target // sizes[source]))
        sums = {0}
        for r in before:
            if r["source"] == source:
                sums |= {x + words[r["doc_id"]] for x in sums}
        best = min(abs(passes * sizes[source] + x - target) for x in sums)
        assert abs(taken[source] - target) <= best + 1, source


def test_sharding(stages):
    before, after = stages[4][1], stages[5][1]
    assert ids(before) == ids(after)
    by_shard = {}
    for r in after:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
    assert set(by_shard) <= set(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert len({(r["doc_id"], r["shard"]) for r in after}) == len({r["doc_id"] for r in after})


def test_run_is_the_stages_in_a_row(spark, stages):
    got = corpus_pipeline.run(spark, SF_DIR).select("doc_id", "shard", "slot", F.md5("text")).collect()
    want = [(r["doc_id"], r["shard"], r["slot"]) for r in stages[-1][1]]
    assert sorted((r[0], r[1], r[2]) for r in got) == sorted(want)
