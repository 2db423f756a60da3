"""WARC archives of web pages, written and read back in parallel.

``write`` makes plain WARC 1.1 files: each record is a row of text, and the line separator is the
blank line that ends a record. Of equal payloads of a size or more one is kept, as a response; the
others are revisit records that refer to it.

``read`` verifies the chain of record boundaries. Spark's text reader cuts the files at the magic
word wherever a split begins, so also at a magic word inside a payload. Each task therefore emits
candidates: the offset of every magic word that a readable header follows, and the offset of its
successor, which the header's length gives. Chains are first shortened inside a split, to the offset
at which a candidate's chain leaves it; pointer jumping from the start of each file then finds at
which offset the true chain enters each split, in as many rounds as the number of splits has binary
digits. A second scan follows the chain from there: magic words that it does not reach are payload.

Results for edge cases of ``write``: null html is the empty payload; a null url is a record without a
target; repeated rows of the response's page_id are responses too; a null page_id is never referred
to, and a row without one refers to the response like any other; with no rows there is no record. Of
``read``: what follows a broken boundary in its file, bytes before the first record, and a last record
that its file cuts off are not records. Other columns of the pages are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from drumlin.llm.common import staged
from drumlin.session import scratch

#: Fixed values of the format.
MAGIC = "WARC/1."
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RESPONSE, REVISIT = "response", "revisit"
#: Names of pages, as record ids.
NAME = "urn:page:"
#: Splits of 128 MB come to some 200 TB; a split's row has about 100 bytes.
MOST_SPLITS = 1_600_000
#: Payloads of so many bytes are kept once.
LEAST = 1000

HEAD = re.compile(rb"\d+\r\n")
LENGTH = re.compile(rb"\r\ncontent-length:[ \t]*(\d{1,18})[ \t]*(?=\r\n|$)", re.IGNORECASE)


def _payload(html: Column) -> Column:
    return F.coalesce(html, F.lit(""))


def decided(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """page_id, url, payload, its digest, and ``refers_to``: the response's page_id, of those that revisit it.

    Only digests are grouped, and combined before the shuffle; those that repeat are written to scratch.
    Spark broadcasts them if they are small, so that payloads are not shuffled. Otherwise a page with many
    copies is one row there, and the join can split its copies over many tasks.
    """
    rows = pages.select("page_id", "url", _payload(F.col("html")).alias("payload")).withColumn("same", F.unhex(F.sha2("payload", 256)))
    repeated = (
        rows.where(F.octet_length("payload") >= least).groupBy("same")
        .agg(F.max("page_id").alias("top"), F.count("*").alias("copies")).where("copies > 1 and top is not null").drop("copies")
    )
    again = rows.join(staged(repeated, "warc-repeated"), "same", "left")
    other = F.col("top").isNotNull() & ~F.col("top").eqNullSafe(F.col("page_id"))
    return again.select(
        "page_id", "url", "payload", F.sha1(F.col("payload").cast("binary")).alias("digest"), F.when(other, F.col("top")).alias("refers_to")
    )


def _lines(*parts: Column) -> Column:
    """Header lines; a null one is left out."""
    return F.concat_ws("\r\n", *parts)


def _name(page_id: Column) -> Column:
    return F.concat(F.lit(f"<{NAME}"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def records(rows: DataFrame, date: str) -> DataFrame:
    """One WARC record for each decided row, without the blank line that ends it."""
    again = F.col("refers_to").isNotNull()
    body = F.when(again, "").otherwise(F.col("payload"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length("payload"), F.lit(END)
    )
    # A line break in an address would end its header line.
    address = F.regexp_replace("url", r"[\r\n]+", "%0A")
    head = _lines(
        F.lit(f"{MAGIC}1"),
        F.when(again, f"WARC-Type: {REVISIT}").otherwise(f"WARC-Type: {RESPONSE}"),
        F.concat(F.lit("WARC-Record-ID: "), _name(F.col("page_id"))),
        F.concat(F.lit("WARC-Target-URI: "), address),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(again, F.concat(F.lit("WARC-Refers-To: "), _name(F.col("refers_to")))),
        F.when(again, f"WARC-Profile: {PROFILE}"),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(http) + F.octet_length(body)),
    )
    return rows.select(F.concat(head, F.lit(END), http, body).alias("value"))


def write(pages: DataFrame, path: str, *, date: str = "2024-01-01T00:00:00Z", least: int = LEAST) -> None:
    records(decided(pages, least), date).write.option("lineSep", END).text(path)


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """What stands between magic words, with the file and split it begins in, in order within a split."""
    lines = spark.read.option("lineSep", MAGIC).text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        (F.col("_metadata.file_block_start") + F.col("_metadata.file_block_length")).alias("stop"),
        F.col("value").cast("binary").alias("value"),
    )


def _pinned(spark: SparkSession) -> None:
    """Files are split by the number of cores unless a setting says otherwise; it must not change
    between the two scans, as when an executor is lost."""
    key = "spark.sql.files.minPartitionNum"
    if spark.conf.get(key, None) in (None, "None"):
        spark.conf.set(key, str(spark.sparkContext.defaultParallelism))


def _need(head: bytes | None) -> int | None:
    """Bytes from a record's magic word to its successor's, by its header; None if that is no header."""
    if head is None or not HEAD.match(head):
        return None
    found = LENGTH.search(head)
    return len(MAGIC) + len(head) + len(END) + int(found[1]) + len(END) if found else None


def _runs(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, int, int, list, list]]:
    """Each split's sizes and heads of its segments, in order."""
    held: tuple[str, int, int, list, list] | None = None
    for batch in batches:
        for file, split, stop, size, head in zip(*(batch[c] for c in ("file", "split", "stop", "size", "head")), strict=True):
            if held is None or held[:2] != (file, split):
                if held is not None:
                    yield held
                held = (file, split, stop, [], [])
            held[3].append(size)
            held[4].append(head)
    if held is not None:
        yield held


CANDIDATES = "file string, split long, stop long, begin long, out long, last long, open long"


def _candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each split a row with its bytes (out), its last segment (last) and how many candidates go beyond
    their segment (open), and one for each candidate: where it is, where its chain leaves the split, and
    the last record before. Offsets count from the split's first segment."""
    for file, split, stop, sizes, heads in _runs(batches):
        at, place = 0, []
        for size in sizes:
            place.append(at)  # a segment begins right after its magic word
            at += size + len(MAGIC)
        leaves: dict[int, tuple[int, int]] = {}
        beyond = 0
        for start, size, head in zip(*map(reversed, (place, sizes, heads)), strict=True):
            need = _need(head)
            if need is not None:
                begin = start - len(MAGIC)
                beyond += need > size + len(MAGIC)
                leaves[begin] = leaves.get(begin + need, (begin + need, begin))
        rows = [(None, at, place[-1], beyond), *((begin, *out, None) for begin, out in leaves.items())]
        found = pd.DataFrame(rows, columns=["begin", "out", "last", "open"]).astype("Int64")
        yield found.assign(file=file, split=split, stop=stop)[["file", "split", "stop", "begin", "out", "last", "open"]]


def _bases(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one file, a row for each split: the offset of its first segment.

    A split has the segments whose magic word begins before it stops. Where bytes that only look like the
    beginning of a magic word stand at its stop, the reader also gives it the first one of the next split.
    """
    rows, base, bases = rows.sort_values("split"), 0, []
    for stop, total, last in zip(rows["stop"], rows["out"], rows["last"], strict=True):
        bases.append(base)
        base += last if base + last - len(MAGIC) >= stop else total
    return rows[["file", "split", "stop"]].assign(base=bases)


def _head(text: Column) -> Column:
    """Header lines: what stands before the first blank line, null if there is none."""
    return F.when(F.contains(text, F.lit(END)), F.substring_index(text, END, 1))


def candidates(segments: DataFrame) -> DataFrame:
    narrow = segments.select(
        "file", "split", "stop", F.octet_length("value").alias("size"), _head(F.col("value").cast("string")).cast("binary").alias("head")
    )
    return narrow.mapInPandas(_candidates, CANDIDATES)


def entries(found: DataFrame) -> DataFrame:
    """For each split of a file: base, the offset of its first segment; at, the record that began in an
    earlier split and may go on; and due, the offset at which the next record has to begin."""
    # One row for each split of a file: groups and windows are as small as a file has splits.
    totals = found.where("begin is null").select("file", "split", "stop", "out", "last")
    bases = staged(totals.groupBy("file").applyInPandas(_bases, "file string, split long, stop long, base long"), "warc-bases")
    links = staged(
        found.where("begin is not null").join(bases, ["file", "split", "stop"]).selectExpr(
            "xxhash64(file) as file", "split", "base + begin as at", "base + out as out", "base + last as last", "stop"
        ).where("at < stop").drop("stop"),
        "warc-links",
    )
    names, ids = bases.agg(F.count_distinct("file"), F.count_distinct(F.xxhash64("file"))).first()
    if names != ids:
        raise ValueError("two paths have the same hash: read the files apart")
    most = bases.groupBy("file").count().agg(F.max("count")).first()[0] or 1
    reached = links.where("at = 0").select("file", "at")
    jumps = links.select("file", "at", "out")
    for _ in range((most - 1).bit_length()):
        # What the chain has reached doubles, and so does the length of the jumps.
        further = reached.join(jumps, ["file", "at"]).select("file", F.col("out").alias("at"))
        reached = staged(reached.union(further).distinct(), "warc-reached")
        ahead = jumps.select("file", F.col("at").alias("out"), F.col("out").alias("next"))
        jumps = staged(jumps.join(ahead, ["file", "out"], "left").select("file", "at", F.coalesce("next", "out").alias("out")), "warc-jumps")
    # A split is entered once, as offsets only grow.
    entered = links.join(reached, ["file", "at"], "left_semi").select("file", "split", "last", "out")
    earlier = "over (partition by file order by split rows between unbounded preceding and 1 preceding)"
    placed = bases.withColumnRenamed("file", "path").withColumn("file", F.xxhash64("path")).join(entered, ["file", "split"], "left")
    return placed.drop("file").withColumnRenamed("path", "file").selectExpr(
        "file", "split", "base", f"last_value(last) ignore nulls {earlier} as at", f"coalesce(last_value(out) ignore nulls {earlier}, 0) as due"
    )


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Follows the chain through each split: the segments of its records, with the record's offset and,
    for the first one, its bytes."""
    place = None
    at, due, record = 0, 0, None
    for batch in batches:
        columns = {name: batch.column(name) for name in batch.schema.names}
        files, splits, stops, bases, ats, dues, sizes, heads = (
            columns[c].to_pylist() for c in ("file", "split", "stop", "base", "at", "due", "size", "head")
        )
        kept: list[tuple[int, int, int, int | None]] = []
        for i in range(batch.num_rows):
            if (files[i], splits[i]) != place:
                if bases[i] is None:
                    raise RuntimeError(f"{files[i]} is split otherwise than before: set spark.sql.files.minPartitionNum")
                place, at, record, due = (files[i], splits[i]), bases[i], ats[i], dues[i]
            begin = at - len(MAGIC)
            if begin >= stops[i]:  # the next split has it, too
                continue
            if begin == due and (need := _need(heads[i])) is not None:
                record, due = begin, begin + need
                kept.append((i, record, at, need))
            elif record is not None and begin < due:
                kept.append((i, record, at, None))
            at += sizes[i] + len(MAGIC)
        if kept:
            rows, begins, starts, needs = zip(*kept, strict=True)
            taken = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [columns["file"].take(taken), *(pa.array(x, pa.int64()) for x in (begins, starts, needs)), columns["value"].take(taken)],
                names=["file", "at", "start", "need", "value"],
            )


def _pieces(spark: SparkSession, known: DataFrame, path: str) -> DataFrame:
    # The join has to keep the order of a split's segments, so it is a broadcast: of a narrow row a split.
    placed = _segments(spark, path).join(F.broadcast(known), ["file", "split"], "left")
    return placed.select(
        "file", "split", "stop", "base", "at", "due", F.octet_length("value").alias("size"),
        _head(F.col("value").cast("string")).cast("binary").alias("head"), "value",
    ).mapInArrow(_chained, "file string, at long, start long, need long, value binary")


def read(spark: SparkSession, path: str) -> DataFrame:
    """file, at (offset), head (header lines) and block (bytes) of every record."""
    _pinned(spark)
    found = staged(candidates(_segments(spark, path)), "warc-candidates")
    known = staged(entries(found), "warc-entries")
    if (splits := known.count()) > MOST_SPLITS:
        raise ValueError(f"{splits} splits are too many to broadcast: raise spark.sql.files.maxPartitionBytes")
    # Most records are one segment and go no further.
    whole = F.coalesce(F.col("need") <= F.octet_length("value") + len(MAGIC), F.lit(False))
    records_ = _pieces(spark, known, path).where(whole).select("file", "at", "need", F.col("value").cast("string").alias("text"))
    # A record with magic words inside is put together, by another scan if there may be such.
    if not found.where("begin is null and open > 0").isEmpty():
        parts = F.transform(F.sort_array(F.collect_list(F.struct("start", "value"))), lambda x: x["value"].cast("string"))
        joined = (
            _pieces(spark, known, path).where(~whole).groupBy("file", "at")
            .agg(F.max("need").alias("need"), F.array_join(parts, MAGIC).alias("text"))
            .where(F.col("need") <= F.octet_length("text") + len(MAGIC) + len(END))
        )
        records_ = records_.unionByName(joined)
    both = records_.withColumn("head", F.substring_index("text", END, 1))
    skipped = F.octet_length("head") + len(END)
    length = F.col("need") - skipped - len(MAGIC) - len(END)
    return both.select("file", "at", "head", F.substring(F.col("text").cast("binary"), skipped + 1, length.cast("int")).alias("block"))


def field(head: str, name: str) -> Column:
    """A header line's value; null if there is no such line."""
    return F.nullif(F.regexp_extract(head, rf"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*)", 1), F.lit(""))


def pages(found: DataFrame) -> DataFrame:
    """What the records say of their pages: page_id, url, record_type, refers_to, payload_bytes,
    payload_digest and the payload (null for a revisit). Bytes and digest of a response are those of the
    payload as read, those of a revisit are what its header says of the payload it refers to."""

    def page(name: str) -> Column:
        return F.nullif(F.regexp_extract(field("head", name), rf"<{NAME}(-?\d+)>", 1), F.lit("")).cast("long")

    rows = found.withColumn("http", F.substring_index(F.col("block").cast("string"), END, 1)).withColumn("record_type", field("head", "WARC-Type"))
    kept = F.col("record_type") == RESPONSE
    payload = F.substring(F.col("block"), F.octet_length("http") + len(END) + 1, F.octet_length("block"))
    rows = rows.withColumn("payload", F.when(kept, payload))
    return rows.select(
        page("WARC-Record-ID").alias("page_id"),
        field("head", "WARC-Target-URI").alias("url"),
        "record_type",
        page("WARC-Refers-To").alias("refers_to"),
        F.when(kept, F.octet_length("payload")).otherwise(field("http", "Content-Length").cast("int")).cast("long").alias("payload_bytes"),
        F.when(kept, F.sha1("payload")).otherwise(F.regexp_extract(field("head", "WARC-Payload-Digest"), "^sha1:(.*)$", 1)).alias("payload_digest"),
        "payload",
    )


def registered(rows: DataFrame) -> DataFrame:
    spark = rows.sparkSession
    path = scratch(spark, "warc")
    write(rows, path)
    return pages(read(spark, path)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
