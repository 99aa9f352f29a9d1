"""Archives: exact round trip, magic inside payloads, splits anywhere, broken chains."""

import glob

import pytest
from pyspark.sql import functions as F

from tillwright.llm import warc

FAKE = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: {n}\r\n\r\n"


def tricky():
    texts = [
        "", None, "short", "x" * 99, "y" * 100, "y" * 100, "x" * 99,
        "ends with a line end\r\n", "ends with two\r\n\r\n", "ends with three\r\n\r\n\r\n",
        "ends oddly\r\n\r", "\r\nbegins with one", "\r\n\r\nbegins with two",
        "a\r\n\r\n" + FAKE.format(n=5) + "hello\r\n\r\nrest",
        "b\r\n\r\n" + FAKE.format(n=0), FAKE.format(n=3) + "abc\r\n\r\n",
        "c\r\n\r\n" + FAKE.format(n=99999999), "d\r\n\r\n" + FAKE.format(n="x"),
        "é€😀" * 50, "é€😀" * 50, "z\r\n\r\n" * 2000,
    ]
    # A fake whose successor is a true record start: its payload ends where the record ends.
    tail = "\r\n\r\n" + FAKE.format(n=7) + "1234567"
    texts.append("e" + tail)
    return [(i, f"http://h/{i}\r\nX-Evil: 1", t) for i, t in enumerate(texts)]


def expected(rows):
    first = {}
    for i, _, t in sorted(rows, key=lambda r: r[0]):
        first.setdefault((t or "").encode(), i)
    out = []
    for i, _, t in rows:
        b = (t or "").encode()
        copy = len(b) >= 100 and first[b] != i
        out.append((i, len(b), "revisit" if copy else "response", first[b] if copy else None))
    return sorted(out)


@pytest.mark.parametrize("split", ["700", "4096", "128m"])
def test_round_trip(spark, folder, split):
    rows = tricky()
    path = f"{folder}/warc"
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write(df.coalesce(2), path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        back = warc.pages(spark, path).collect()
        bodies = warc.records(spark, path).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    got = sorted((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in back)
    assert got == expected(rows)
    texts = {i: (t or "").encode() for i, _, t in rows}
    assert all(r["intact"] is (True if r["record_type"] == "response" else None) for r in back)
    for r in bodies:
        head, _, payload = bytes(r["body"]).partition(b"\r\n\r\n")
        page = int(r["header"].split("<urn:page:")[1].split(">")[0])
        assert payload == (texts[page] if "WARC-Type: response" in r["header"] else b"")
        assert head.endswith(f"Content-Length: {len(texts[page])}".encode())


def test_record_bytes(spark, folder):
    path = f"{folder}/one"
    warc.write(spark.createDataFrame([(7, None, "hi")], "page_id long, url string, html string"), path)
    data = b"".join(open(f, "rb").read() for f in glob.glob(f"{path}/part-*"))
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n")
    assert data.endswith(b"Content-Length: 2\r\n\r\nhi\r\n\r\n")


def test_empty_table_and_null_ids(spark, folder):
    schema = "page_id long, html string, url string, offset string"
    warc.write(spark.createDataFrame([], schema), f"{folder}/none")
    assert warc.pages(spark, f"{folder}/none").count() == 0
    rows = [(None, "n" * 200, None, "a"), (None, "n" * 200, None, "b"), (3, "n" * 200, None, "c"),
            (3, "n" * 200, None, "d"), (4, "n" * 200, None, "e")]
    warc.write(spark.createDataFrame(rows, schema), f"{folder}/nulls")
    got = sorted(((r["page_id"], r["record_type"], r["refers_to"])
                  for r in warc.pages(spark, f"{folder}/nulls").collect()), key=str)
    assert got == sorted([(None, "response", None)] * 2 + [(3, "response", None)] * 2
                         + [(4, "revisit", 3)], key=str)


def test_broken_archive(spark, folder):
    path = f"{folder}/warc"
    rows = spark.createDataFrame([(1, "u", "one"), (2, "u", "two")], "page_id long, url string, html string")
    warc.record_text(warc.decide(rows)).select(F.regexp_replace("value", "two$", "twoX").alias("value")) \
        .coalesce(1).write.option("lineSep", warc.GAP).text(path)
    with pytest.raises(ValueError, match="records end"):
        warc.pages(spark, path)
