"""What a load leaves on disk, and what it shuffles, while it compares whole rows."""

import contextlib
import random
import time
from datetime import date

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import rows
from test_growth import plan, raw, tables  # noqa: F401
from tillwright.operators import incremental
from tillwright.plans import bridge, denormalise, standardize
from tillwright.sources import commits, workspace

ROW = "id string, day date, who long, price double, note string"
FREES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffled(spark):
    """Names of the shuffle files on this machine's disks."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {n for n in manager.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in n}


def test_shuffle_files_go_with_the_job_that_wrote_them(spark):
    before = shuffled(spark)
    with workspace.freeing(spark):
        stored = workspace.materialize(spark.range(1000).repartition(3, "id"), "freed")
        assert spark.conf.get(FREES) == "true"
    until = time.monotonic() + 10
    while shuffled(spark) - before and time.monotonic() < until:
        time.sleep(0.1)
    assert not shuffled(spark) - before and stored.count() == 1000


@pytest.mark.parametrize("setting", ["true", "false"])
def test_the_setting_of_the_session_is_put_back(spark, setting):
    was = spark.conf.get(FREES, None)
    try:
        spark.conf.set(FREES, setting)
        with contextlib.suppress(InterruptedError), workspace.freeing(spark), workspace.freeing(spark):
            raise InterruptedError
        assert spark.conf.get(FREES) == setting
    finally:
        spark.conf.set(FREES, was) if was is not None else spark.conf.unset(FREES)


def test_a_first_load_shuffles_wide_rows_once(spark):
    batch = spark.createDataFrame([("a", date(2024, 1, 1), 1, 1.0, "x")] * 2, ROW)
    days = incremental.counted(batch, "id", "day", "month")
    made = incremental.sift(batch, "id", "day", "month", days)
    assert plan(made.new).count("Exchange hashpartitioning") == 1
    assert made.new.count() == 1 and (made.rows_in, made.set_aside) == (2, 0)


@pytest.mark.parametrize("sent", [0, 100])
@pytest.mark.parametrize("near", [(), ("who",)])
def test_a_day_cut_into_pieces_compares_the_same_rows(spark, folder, monkeypatch, near, sent):
    """Copies, zeros of both signs, nulls and changed rows, whatever the pieces and the join."""
    monkeypatch.setattr(incremental, "PIECE", 3)
    monkeypatch.setattr(incremental, "ROWS", 5)
    monkeypatch.setattr(incremental, "SENT", sent)
    rng = random.Random(1)
    made = [(rng.choice([None, "a", "b", "c", "d"]), rng.choice([None, date(2024, 1, 1), date(2024, 1, 2)]),
             rng.choice([None, 1, 2]), rng.choice([0.0, -0.0, 1.5]), rng.choice([None, ""])) for _ in range(200)]
    batch = spark.createDataFrame(made, ROW).repartition(5)
    stored = spark.createDataFrame([r for r in made if r[0] in ("a", "b")][:30], ROW).distinct()
    known = lambda keys: stored.select("id").join(keys, "id", "left_semi").distinct()
    days = incremental.counted(batch, "id", "day", "day")
    got = incremental.sift(batch, "id", "day", "day", days, stored, known, near)
    old = {r[0] for r in stored.select("id").collect()}
    kept = {r for r in made if r[0] is not None} - {tuple(r) for r in stored.collect()}
    assert set(map(tuple, got.new.collect())) == {r for r in kept if r[0] not in old}
    assert got.new.count() == len({r for r in kept if r[0] not in old})
    aside = got.aside.groupBy(incremental.REASON).agg(F.sum("copies"), F.count("*"))
    no_id, changed = ([r for r in made if r[0] is None], [r for r in made if r[0] in old and r in kept])
    assert rows(aside) == sorted([(incremental.CHANGED, len(changed), len(set(changed))),
                                  (incremental.NO_ID, len(no_id), len(set(no_id)))])
    assert (got.rows_in, got.set_aside, got.dealt) == (200, len(no_id) + len(changed), sent > 0)


def test_channels_of_a_large_batch_take_turns(spark, folder, monkeypatch):
    monkeypatch.setattr(denormalise, "BESIDE", 0)
    at_work, most = [], []
    real = incremental.sift

    def sift(*args, **how):
        at_work.append(1)
        most.append(len(at_work))
        time.sleep(0.2)
        try:
            return real(*args, **how)
        finally:
            at_work.pop()
    monkeypatch.setattr(incremental, "sift", sift)
    cleaned = standardize.standardize(raw(spark).unionAll(raw(spark).withColumn("is_online", F.lit("no"))))
    loads = denormalise.load(*[standardize.channel(cleaned, c) for c in ("online", "offline")], folder)
    assert most == [1, 1] and [x.stored for x in loads.values()] == [1, 1]


def test_a_load_that_ends_leaves_no_intermediate_tables(spark, folder, monkeypatch):
    made = []
    real = workspace.materialize
    monkeypatch.setattr(workspace, "materialize", lambda df, name: made.append(real(df, name)) or made[-1])
    batches = [standardize.channel(standardize.standardize(raw(spark)), c) for c in ("online", "offline")]
    denormalise.load(*batches, folder)

    def ends(*args, **how):
        raise InterruptedError
    monkeypatch.setattr(commits.Load, "write", ends)
    made.clear()
    with pytest.raises(InterruptedError):
        denormalise.load(*batches, folder)
    files = spark._jvm.org.apache.hadoop.fs.Path
    for path in {f.rsplit("/", 1)[0] for t in made for f in t.inputFiles()}:
        assert not files(path).getFileSystem(spark._jsc.hadoopConfiguration()).exists(files(path))
    assert made


def test_lines_meet_parts_while_they_are_narrow(spark, tables):  # noqa: F811
    text = bridge.raw_transactions(spark, tables)._jdf.queryExecution().analyzed().toString().splitlines()
    at = {k: next(i for i, line in enumerate(text) if k in line) for k in ("RepartitionByExpression", "p_partkey#")}
    below = [line for line in text[at["RepartitionByExpression"]:] if "Relation" in line][:3]
    assert any("p_partkey" in line for line in below) and not any("c_custkey" in line for line in below)


@pytest.mark.parametrize("name", ["interrupted_load", "denormalised_append", "replaced_load", "load_balance"])
def test_cleaned_rows_go_when_the_loads_are_done(spark, tables, monkeypatch, name):  # noqa: F811
    made = []
    real = workspace.materialize

    def kept(df, label):
        out = real(df, label)
        made.append(out.inputFiles()) if label == "cleaned" else None
        return out
    monkeypatch.setattr(workspace, "materialize", kept)
    found = entry._QUERIES[name](spark, tables).collect()
    assert found and len(made) == 1 and made[0]
    path = spark._jvm.org.apache.hadoop.fs.Path(made[0][0])
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def test_what_ended_loads_left_is_swept_after_the_repeat(spark, tables, monkeypatch):  # noqa: F811
    swept = []
    real = commits.Log.sweep
    monkeypatch.setattr(commits.Log, "sweep", lambda log: swept.append(real(log)) or swept[-1])
    assert entry._QUERIES["interrupted_load"](spark, tables).count() == 1
    assert len(swept) == 2 and all(swept)


def test_raw_rows_go_when_they_are_standardized(spark, tables, monkeypatch):  # noqa: F811
    seen = []
    real = denormalise.run

    def run(*args, **how):
        path = spark._jvm.org.apache.hadoop.fs.Path(raw_at[0])
        seen.append(path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path))
        return real(*args, **how)
    raw_at = []
    layer = entry._raw_layer
    monkeypatch.setattr(entry, "_raw_layer", lambda *a: (
        raw_at.append((made := layer(*a)).inputFiles()[0].rsplit("/", 1)[0]), made)[1])
    monkeypatch.setattr(denormalise, "run", run)
    assert entry._QUERIES["pipeline_category_sales"](spark, tables).count() == 1
    assert seen == [False]
