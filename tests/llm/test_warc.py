"""WARC archives: round trips, also of payloads full of magic words, over splits of any size."""

import hashlib

import duckdb
import pytest

from drumlin.llm import warc
from drumlin.session import scratch

SCHEMA = "page_id long, url string, html string"
TRAP = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:666>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"


@pytest.fixture()
def splits(spark):
    def size(limit):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(limit))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield size
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def rows():
    long = "Grüße " * 150
    found = [(i, f"http://h{i % 3}/ü?{i}", f"<p>{'x' * (337 * i % 900)}</p>") for i in range(12)]
    found += [(100 + i, "http://copy/", long) for i in range(5)]
    found += [(200, "http://trap/", TRAP), (201, None, "a" * 50 + TRAP * 9 + "z"), (202, "u\r\nv", "WARC/1."), (203, "u", "WARC/1.1\r\n\r\n\r\n")]
    found += [(204, "u", None), (205, "u", ""), (None, "u", long), (None, "u", "b" * 2000), (None, "u", "b" * 2000), (104, "twice", long)]
    return found


def expected(found):
    by_payload = {}
    for page_id, _, html in found:
        if page_id is not None:
            by_payload[html or ""] = max(page_id, by_payload.get(html or "", page_id))
    out = []
    for page_id, _, html in found:
        payload = (html or "").encode()
        top = by_payload.get(html or "")
        again = len(payload) >= 1000 and top is not None and top != page_id
        out.append((page_id, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if again else "response", top if again else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("limit", [499, 1 << 20])
def test_round_trip(spark, splits, limit):
    frame = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    path = scratch(spark, "test-warc")
    warc.write(frame, path)
    splits(limit)
    got = warc.pages(warc.read(spark, path)).collect()
    keys = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[k] for k in keys) for r in got), key=repr) == expected(rows())
    for r in got:  # nothing is lost of a payload, and a revisit has none
        assert (r.payload is None) == (r.record_type == "revisit")
        if r.payload is not None:
            assert hashlib.sha1(r.payload).hexdigest() == r.payload_digest and len(r.payload) == r.payload_bytes
    texts = {r.page_id: bytes(r.payload).decode() for r in got if r.payload is not None and r.page_id in (200, 201, 202)}
    assert texts == {200: TRAP, 201: "a" * 50 + TRAP * 9 + "z", 202: "WARC/1."}
    assert {r.url for r in got if r.page_id in (201, 202)} == {None, "u%0Av"}


def record(name, body, length=None):
    return f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{name}>\r\nContent-Length: {length or len(body)}\r\n\r\n{body}\r\n\r\n"


@pytest.mark.parametrize("limit", [130, 1 << 20])
def test_broken_files(spark, splits, folder, limit):
    """Chains end at a wrong length, at the end of a cut file and at bytes before the first record."""
    files = {
        "wrong": record(1, "one") + record(2, "two", 5) + record(3, "three"),
        "cut": record(4, "four") + record(5, "x" * 500)[:300],
        "late": "junk" + record(6, "six"),
        "good": record(7, TRAP * 3) + record(8, "") + record(9, "nine")[:-4],
        "empty": "",
    }
    for name, text in files.items():
        with open(f"{folder}/{name}.warc", "wb") as out:
            out.write(text.encode())
    splits(limit)
    rows_ = warc.read(spark, folder).select(warc.field("head", "WARC-Record-ID").alias("name"), "block").collect()
    got = {r.name: bytes(r.block).decode() for r in rows_}
    assert got == {"<urn:page:1>": "one", "<urn:page:2>": "two\r\n", "<urn:page:4>": "four", "<urn:page:7>": TRAP * 3, "<urn:page:8>": "", "<urn:page:9>": "nine"}


def test_edge_cases(spark):
    frame = spark.createDataFrame(rows(), SCHEMA).selectExpr("*", "'x' as digest", "1 as refers_to", "2 as file", "3 as same", "4 as value")
    keys = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    got = warc.registered(frame)
    assert got.columns == list(keys)
    assert sorted(map(tuple, got.collect()), key=repr) == expected(rows())
    assert warc.registered(frame.limit(0)).collect() == []


def test_sql_on_the_same_rows(spark):
    from drumlin.llm.queries import ORACLE

    con = duckdb.connect()
    con.execute("create table pages (page_id bigint, url varchar, html varchar)")
    con.executemany("insert into pages values (?, ?, ?)", rows())
    assert sorted(con.execute(ORACLE["op11_warc"]).fetchall(), key=repr) == expected(rows())
