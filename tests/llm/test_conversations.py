"""Repair of conversations against plain dynamic programming, row by row."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from tillwright.llm import conversations
from tillwright.llm.scratch import Scratch

STEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
WORD = r"[^\x20\x09-\x0D]"


def cheapest(rows):
    """(cost, letters, turns) of the least cheapest repair; rows are (role, text, must go, truncated)."""
    far = (10 ** 9, "~", [])
    after = {p: (0, "", []) if p in ("", "a") else far for p in ("", "s", "u", "a")}

    def inserted(costs):
        for _ in range(6):
            for place in costs:
                for role in ("user", "assistant"):
                    if (place, role[0]) in STEP:
                        c, letters, turns = costs[STEP[place, role[0]]]
                        costs[place] = min(costs[place], (c + 2, "I" + letters, [f"{role}:", *turns]))
        return costs

    after = inserted(after)
    for role, text, gone, cut in reversed(rows):
        now = {}
        for place in after:
            c, letters, turns = after[place]
            ways = [(c + 3, "D" + letters, turns)]
            if not gone:
                for to, cost, letter in ((role, 0, "K"), ("user", 2, "R"), ("assistant", 2, "R")):
                    if (place, to[:1]) in STEP:
                        c, letters, turns = after[STEP[place, to[:1]]]
                        ways.append((c + cost + cut, letter + letters, [f"{to}:{text}", *turns]))
            now[place] = min(ways)
        after = inserted(now)
    return after[""]


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def plain(rows):
    """{conversation: report}, with every fault found by reading the rows in order."""
    out = {}
    kept = damaged(rows)
    for conv in {r[0] for r in rows}:
        own = [r for r in kept if r[0] == conv]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2],
                                hashlib.sha256(f"{r[2]}\0{r[3]}".encode()).hexdigest()))
        seen, faults = set(), []
        for _, _, role, text in own:
            if not re.search(WORD, text):
                faults.append("blank")
            elif (role, text) in seen:
                faults.append("duplicate")
            elif re.findall(WORD, text)[-1] not in ".!?":
                faults.append("truncated")
            else:
                faults.append("")
            seen.add((role, text))
        turns = [r[1] for r in own if r[1] is not None]
        cost, letters, lines = cheapest([(r[2], r[3], f in ("blank", "duplicate"), f == "truncated")
                                         for r, f in zip(own, faults)])
        illegal = sum((a[2][:1] + b[2][:1]) not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"),
                     faults.count("duplicate"), faults.count("truncated"), illegal, cost, letters,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def report(spark, rows, parts=3):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(parts)
    got = conversations.repair(conversations.damaged(df), Scratch(spark, "turns-test")).collect()
    assert len({r["conv_id"] for r in got}) == len(got)
    return {r["conv_id"]: tuple(r)[1:] for r in got}


def some_rows(seed, convs, longest):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "What? ", "cut of", "", " \n", "Yes.", "a b. c", "x.\t"]
    rows = []
    for conv in range(convs):
        n = rng.randint(1, longest)
        for turn in range(n):
            if rng.random() < 0.1:
                continue
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", None, ""])
            text = rng.choice([*texts, None, f"text {turn}."])
            rows.append((conv if conv else None, turn if rng.random() > 0.05 else None, role, text))
    return rows


def test_tables_are_exact():
    known = conversations.tables()
    rng = random.Random(2)
    words = ["".join(w) for n in range(4) for w in itertools.product(conversations.SYMBOLS, repeat=n)]
    words += ["".join(rng.choice("suaoSUAOxxuaua") for _ in range(rng.randint(4, 30))) for _ in range(1500)]
    for word in words:
        symbols = bytes(conversations.NUMBER[c] for c in word)
        letters, _, cost = known.trace(symbols, conversations.START, conversations.ENDS)
        roles = {"s": "system", "u": "user", "a": "assistant", "o": "tool", "x": "user"}
        want = cheapest([(roles[c.lower()], "", c == "x", c.isupper()) for c in word])
        assert (cost, letters) == want[:2], word
    assert len(known.vectors) < 100


def test_conversations(spark):
    rows = some_rows(1, 60, 12)
    assert report(spark, rows) == plain(rows)


def test_long_ones_over_many_tasks(spark, monkeypatch):
    """One conversation with most rows, cut into chunks and spread over tasks."""
    monkeypatch.setattr(conversations, "CHUNK_ROWS", 7)
    rng = random.Random(5)
    rows = some_rows(2, 6, 9)
    rows += [(77, t, rng.choice(["user", "assistant"]), rng.choice([f"t {t}.", "Yes.", "cut"])) for t in range(700)]
    rows += [(78, None, "user", "Same."), (78, None, "user", "Same."), (78, 3, "user", "Same.")] * 20
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert report(spark, rows) == plain(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_edges(spark):
    # Conversation 0 loses its only row where the key says so; others are blank or null throughout.
    lost = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    rows = [(5, lost, "user", "Gone."), (6, None, None, None), (7, 1, "user", "a" * 200_000 + "."),
            (7, 2, "assistant", "ok."), (None, None, "assistant", "x")]
    assert report(spark, rows) == plain(rows)
    empty = hashlib.sha256(b"").hexdigest()
    assert report(spark, rows[:1]) == {5: (0, 0, 0, 0, 0, 0, "", empty)}
    assert report(spark, rows, 1) == plain(rows)
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string, conv string, copies int")
    assert conversations.repair(conversations.damaged(df), Scratch(spark, "none")).count() == 0


@pytest.mark.parametrize("kind", ["string", "int"])
def test_other_types_and_extra_columns(spark, kind):
    rows = [("1", 0, "user", "Hi.", "x"), ("1", 1, "assistant", "Yes.", "y"), ("2", 0, "user", "Hi.", "z")]
    df = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string, symbol string")
    df = df.withColumn("conv_id", df["conv_id"].cast(kind))
    got = conversations.repair(conversations.damaged(df), Scratch(spark, "types"))
    assert got.count() == 2 and dict(got.dtypes)["conv_id"] == kind
