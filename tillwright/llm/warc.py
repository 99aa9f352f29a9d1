"""WARC archives: writing page records, and reading archives of any split.

Writing. A record is one row of text; the blank line pair that ends a record is
the line separator of Spark's text writer, so archives are plain files that any
file system of Spark can take. Of pages with equal payloads of at least
``MIN_DEDUP`` bytes, the smallest id is stored, and the others point to it.

Reading. Archives are cut into chunks at ``CRLF CRLF WARC/1.``, in as many tasks as
their size asks for; the byte offset of a chunk follows from the lengths before it
and from the sums of the splits before its own. (No end of that mark is its own
beginning, so every split finds the same marks.) A chunk is only a candidate for a
record: a payload may hold the same bytes. Every candidate names the
offset where its successor must begin. From the first byte of each file, pointer
jumping reaches 2, 4, 8, ... records per round; candidates that are never reached
lie inside payloads and are rejected. Chunks are then joined to the record they
lie in.

Null payloads are empty records. Page ids may repeat: equal ids share a fate, and
a page without an id neither points nor is pointed to. Extra columns are not read.
An empty table writes an archive folder without records and reads as no rows. A
file whose chain breaks off before its end raises an error in :func:`records`
unless ``strict`` is off. Splits must be longer than records: Spark's text reader
loses a line that is longer than its split and ends in the last bytes of it, which
the check of the chain finds.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwright.llm.scratch import Scratch

MIN_DEDUP = 100
#: Of about 100 bytes each.
BROADCAST_DIGESTS = 100_000
GAP = "\r\n\r\n"
MAGIC = "WARC/1."
MARK = GAP + MAGIC
DATE = "2024-07-12T00:00:00Z"

# --- writing -----------------------------------------------------------------------


def decide(pages: DataFrame, key: str = "page_id", payload: str = "html", url: str = "url") -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to.

    Groups of equal payloads are found by digest, pre-aggregated in the tasks. Only
    digests with copies go into the join: a bounded number of them is broadcast, so
    that payloads do not move, more are joined by shuffle.
    """
    text = F.coalesce(F.col(f"`{payload}`"), F.lit(""))
    rows = pages.select(
        F.col(f"`{key}`").alias("page_id"),
        (F.col(f"`{url}`") if url in pages.columns else F.lit(None)).alias("url"),
        text.alias("payload"), F.octet_length(text).cast("long").alias("payload_bytes"),
        F.sha2(F.encode(text, "UTF-8"), 256).alias("payload_digest"))
    big = F.col("payload_bytes") >= MIN_DEDUP
    groups = rows.where(big).groupBy("payload_digest").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    if groups.count() <= BROADCAST_DIGESTS:
        groups = F.broadcast(groups)
    joined = rows.join(groups.withColumnRenamed("payload_digest", "__digest"),
                       big & (F.col("payload_digest") == F.col("__digest")), "left")
    revisit = F.coalesce(F.col("page_id") > F.col("first"), F.lit(False))
    return joined.select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first")).alias("refers_to"))


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null; line ends inside a value are spaces."""
    clean = F.regexp_replace(value.cast("string"), r"[\r\n]+", " ")
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")), F.lit(""))


def record_text(decided: DataFrame) -> DataFrame:
    """One column ``value``: the records without the blank line pair that ends them.

    The block of a record is an HTTP header with the length of the full payload,
    followed by the payload; a revisit has the header alone.
    """
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(GAP))
    block = F.concat(http, F.when(F.col("record_type") == "response", F.col("payload")).otherwise(""))
    digest = F.concat(F.lit("sha256:"), F.col("payload_digest"))
    header = F.concat(
        F.lit("WARC/1.1\r\n"), _line("WARC-Type", F.col("record_type")),
        _line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col("page_id"), F.lit(">"))),
        _line("WARC-Date", F.lit(DATE)), _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", digest),
        _line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to"), F.lit(">"))),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(GAP))
    return decided.select(F.concat(header, block).alias("value"))


def write(pages: DataFrame, path: str, **columns) -> None:
    """Archives of ``pages`` at ``path``, one file per task."""
    record_text(decide(pages, **columns)).write.option("lineSep", GAP).text(path)


# --- reading -----------------------------------------------------------------------


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", MARK).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"), "value")


SCAN = ("file string, split long, at long, size long, header string, length long, "
        "payload_bytes long, sha256 string, whole boolean")
_START = re.compile(rb"WARC/1\.[01]\r\n")
_LENGTH = re.compile(rb"\r\nContent-Length:[ \t]*([0-9]{1,18})[ \t]*(?:\r\n|$)", re.IGNORECASE)


def scan(spark: SparkSession, path: str) -> DataFrame:
    """One row per chunk that begins like a record, and one per split with its size.

    ``at`` is the place within the split, ``size`` the bytes of the header or, where
    that is null, of the split. A record that lies in its chunk is digested on the
    way, so payloads are read once and never moved.
    """
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, at = None, 0
        for batch in batches:
            out = []
            for file, split, value in zip(*[c.to_pylist() for c in batch.columns]):
                if now != (file, split):
                    if now:
                        out.append((*now, at, at, None, None, None, None, None))
                    now, at = (file, split), 0
                found = _candidate(value, split == 0 and at == 0)
                if found:
                    out.append((file, split, at, *found))
                at += len(value) + len(MARK)
            yield _rows(out)
        if now:
            yield _rows([(*now, at, at, None, None, None, None, None)])

    return _read(spark, path).withColumn("value", F.col("value").cast("binary")).mapInArrow(look, SCAN)


def _rows(rows: list) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(),
             pa.string(), pa.bool_()]
    columns = list(zip(*rows)) or [()] * len(kinds)
    names = [field.split()[0] for field in SCAN.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _candidate(value: bytes, first: bool):
    """(header bytes, header, length, payload bytes, digest, whole) or None.

    A header ends at the first blank line; one that ends with its chunk is followed
    by a payload that begins with the magic.
    """
    gap = value.find(GAP.encode())
    head = value if gap < 0 else value[:gap]
    header = head if first else MAGIC.encode() + head
    length = _LENGTH.search(header)
    if not _START.match(header) or not length:
        return None
    n, start = int(length[1]), len(head) + len(GAP)
    whole = gap >= 0 and start + n <= len(value)
    stated = digest = None
    if whole:
        block = value[start:start + n]
        cut = block.find(GAP.encode())
        told = _LENGTH.search(block[:cut]) if cut >= 0 else None
        stated = int(told[1]) if told else None
        digest = hashlib.sha256(block[cut + len(GAP):] if cut >= 0 else block).hexdigest()
    return len(head), header.decode("utf-8", "replace"), n, stated, digest, whole


def _split_starts(scanned: DataFrame) -> DataFrame:
    """file, split, start, end of each split's chunks: sums over small rows, one per split."""
    before = Window.partitionBy("file").orderBy("split")
    return scanned.where("header IS NULL").select("file", "split", (
        F.sum("size").over(before) - F.col("size")).alias("start"), "size")


def candidates(scanned: DataFrame) -> DataFrame:
    """The records that chunks may be: file, split, chunk, offset, header, length, successor, ...

    ``chunk`` is the offset of the chunk, ``offset`` that of the magic before it.
    """
    placed = scanned.where("header IS NOT NULL").join(
        _split_starts(scanned).drop("size"), ["file", "split"]).withColumn(
        "chunk", F.col("start") + F.col("at"))
    return placed.select(
        "file", "split", "chunk",
        F.when(F.col("chunk") == 0, 0).otherwise(F.col("chunk") - len(MAGIC)).alias("offset"),
        "header", "length",
        (F.col("chunk") + F.col("size") + F.col("length") + 2 * len(GAP)).alias("successor"),
        "payload_bytes", "sha256", "whole")


def chunks(spark: SparkSession, path: str, scanned: DataFrame) -> DataFrame:
    """file, split, offset, value: the chunks with the offset of their bytes."""
    read = _read(spark, path).withColumn("place", F.monotonically_increasing_id())
    in_split = Window.partitionBy("file", "split").orderBy("place").rowsBetween(
        Window.unboundedPreceding, -1)
    size = F.octet_length("value") + F.lit(len(MARK))
    return read.withColumn("__in", F.coalesce(F.sum(size).over(in_split), F.lit(0))).join(
        _split_starts(scanned).drop("size"), ["file", "split"]).select(
        "file", "split", (F.col("start") + F.col("__in")).alias("offset"), "value")


def runs(found: DataFrame) -> DataFrame:
    """``found`` with the run of each candidate, named by its first offset.

    Neighbours of one split, each of which names the next as its successor, form a
    run: whoever reaches one of them reaches all after it. Jumping from run to run
    takes far fewer steps than from record to record.
    """
    in_split = Window.partitionBy("file", "split").orderBy("offset")
    follows = F.coalesce(F.lag("successor").over(in_split) == F.col("offset"), F.lit(False))
    headed = found.withColumn("__head", F.when(~follows, F.col("offset")))
    return headed.withColumn("run", F.last("__head", ignorenulls=True).over(
        in_split.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("__head")


def true_records(found: DataFrame, scratch: Scratch) -> DataFrame:
    """The candidates on the chain from the first byte of each file."""
    placed = scratch.write(runs(found), "runs")
    tails = placed.groupBy("file", "run").agg(F.max_by("successor", "offset").alias("successor"))
    entries = placed.select("file", F.col("offset").alias("successor"), F.col("run").alias("to"))
    links = scratch.write(tails.join(entries, ["file", "successor"], "left").select(
        "file", "run", "successor", "to"), "links")
    reached = reachable(links.select("file", F.col("run").alias("offset"), F.col("to").alias("successor")),
                        scratch).select("file", F.col("offset").alias("run"))
    # The chain enters a run once, at the successor of the run before it.
    entered = links.join(reached, ["file", "run"], "left_semi").where("`to` IS NOT NULL").select(
        "file", F.col("to").alias("run"), F.col("successor").alias("entry")).unionAll(
        reached.where("run = 0").select("file", "run", F.lit(0).cast("long").alias("entry")))
    return placed.join(entered, ["file", "run"]).where("offset >= entry").drop("run", "entry")


def reachable(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(file, offset) on the chain from offset 0 of each file, by pointer jumping.

    Round k knows the places within 2**k steps and, for every place, the one 2**k
    steps on: as many rounds as the longest chain has binary digits.
    """
    nodes = links.select("file", "offset")
    jumps = scratch.write(links.select("file", "offset", F.col("successor").alias("to")), "jumps")
    reached = scratch.write(jumps.where("offset = 0").select("file", "offset"), "reached")
    known = reached.count()
    while known:
        step = reached.join(jumps, ["file", "offset"]).select("file", F.col("to").alias("offset"))
        there = step.join(nodes, ["file", "offset"], "left_semi")
        more = scratch.write(reached.unionAll(there).distinct(), "reached")
        now = more.count()
        if now == known:
            return more
        far = jumps.select("file", F.col("offset").alias("to"), F.col("to").alias("farther"))
        longer = scratch.write(jumps.join(far, ["file", "to"]).select(
            "file", "offset", F.col("farther").alias("to")), "jumps")
        scratch.drop(jumps, reached)
        jumps, reached, known = longer, more, now
    return reached


def found_records(
    spark: SparkSession, path: str, scratch: Scratch, strict: bool = True
) -> tuple[DataFrame, DataFrame]:
    """The true records of the archives at ``path``, without bodies, and the scan they are from."""
    scanned = scratch.write(scan(spark, path), "scan")
    true = scratch.write(true_records(candidates(scanned), scratch), "records")
    if strict:
        _check_ends(scanned, true)
    return true, scanned


def records(
    spark: SparkSession, path: str, scratch: Scratch | None = None, strict: bool = True,
) -> DataFrame:
    """file, offset, header, length, body of every record of the archives at ``path``."""
    true, scanned = found_records(spark, path, scratch or Scratch(spark, "warc"), strict)
    return _with_bodies(chunks(spark, path, scanned), true)


def _check_ends(scanned: DataFrame, true: DataFrame) -> None:
    """Every chain must end with its file, whose last chunk has no mark behind it."""
    ends = _split_starts(scanned).groupBy("file").agg(
        (F.max(F.col("start") + F.col("size")) - len(MARK)).alias("end"))
    last = true.groupBy("file").agg(F.max("successor").alias("last"))
    broken = ends.join(last, "file", "left").where("last IS NULL OR last <> end").first()
    if broken:
        raise ValueError(f"{broken['file']}: the records end at {broken['last']} of {broken['end']}")


def _with_bodies(pieces: DataFrame, true: DataFrame) -> DataFrame:
    """Every true record with its own chunk and those that its payload was cut into.

    Within a split, the last record that begins before a chunk is its record; for
    the first chunks of a split it is the last one of the splits before. The
    largest group is one record.
    """
    starts = true.select("file", F.col("chunk").alias("offset"), F.col("offset").alias("record"))
    marked = pieces.join(starts, ["file", "offset"], "left")
    upto = Window.partitionBy("file", "split").orderBy("offset").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    inside = marked.withColumn("__own", F.last("record", ignorenulls=True).over(upto))
    carried = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    last = marked.groupBy("file", "split").agg(F.max("record").alias("__last")).withColumn(
        "__carried", F.max("__last").over(carried)).drop("__last")
    placed = inside.join(last, ["file", "split"]).withColumn(
        "record", F.coalesce("__own", "__carried"))
    gathered = placed.groupBy("file", "record").agg(
        F.sort_array(F.collect_list(F.struct("offset", "value"))).alias("parts")).select(
        "file", F.col("record").alias("offset"),
        F.concat_ws(MARK, F.transform("parts", lambda p: p["value"])).alias("joined"))
    # The magic is not part of a chunk, but for the first of a file.
    head = F.octet_length("header") - F.when(F.col("offset") == 0, 0).otherwise(len(MAGIC))
    return true.join(gathered, ["file", "offset"]).select(
        "file", "offset", "header", "length", F.substring(
            F.col("joined").cast("binary"), (head + len(GAP) + 1).cast("int"),
            F.col("length").cast("int")).alias("body"))


def _header(name: str, of: str = "header") -> Column:
    value = F.regexp_extract(of, rf"(?i)\r\n{name}:[ \t]*([^\r\n]*)", 1)
    return F.when(value != "", value)


def pages(
    spark: SparkSession, path: str, kind: str = "bigint", scratch: Scratch | None = None,
    strict: bool = True,
) -> DataFrame:
    """What the archives tell of each page; the digest of stored payloads is checked.

    ``intact`` is null for a revisit, which has no payload of its own. Payloads that
    hold a mark were cut into several chunks; only they are put together again.
    """
    true, scanned = found_records(spark, path, scratch or Scratch(spark, "warc"), strict)
    cut = true.where("NOT whole")
    told = true.where("whole").select("header", "payload_bytes", "sha256")
    if cut.first():
        pieces = chunks(spark, path, scanned).join(cut.select("file").distinct(), "file", "left_semi")
        bodies = _with_bodies(pieces, true).join(cut.select("file", "offset"), ["file", "offset"], "left_semi")
        text = F.col("body").cast("string")
        payload = F.substring(F.col("body"), F.instr(text, GAP) + len(GAP), F.octet_length("body"))
        told = told.unionByName(bodies.select(
            "header", F.regexp_extract(text, r"(?i)\r\nContent-Length:[ \t]*([0-9]+)", 1)
            .cast("long").alias("payload_bytes"), F.sha2(payload, 256).alias("sha256")))
    page = F.regexp_extract(_header("WARC-Record-ID"), "<urn:page:(.*)>", 1)
    target = F.regexp_extract(_header("WARC-Refers-To"), "<urn:page:(.*)>", 1)
    parsed = told.select(
        F.when(page != "", page).try_cast(kind).alias("page_id"), "payload_bytes",
        F.regexp_extract(_header("WARC-Payload-Digest"), "sha256:([0-9a-f]*)", 1).alias("payload_digest"),
        _header("WARC-Type").alias("record_type"),
        F.when(target != "", target).try_cast(kind).alias("refers_to"),
        _header("WARC-Target-URI").alias("url"), "sha256")
    stored = F.col("sha256") == F.col("payload_digest")
    return parsed.withColumn(
        "intact", F.when(F.col("record_type") == "response", stored)).drop("sha256")
