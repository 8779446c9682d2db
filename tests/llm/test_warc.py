from __future__ import annotations

import base64
import gzip
import hashlib

import pytest

from logscore.llm import warc
from logscore.session import scratch_folder

PAGES = "page_id bigint, url string, html string, payload string"


def digest(text: str | None) -> str:
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def captures(spark, pages, **options):
    df = spark.createDataFrame([(*p, "x") for p in pages], PAGES).repartition(3)
    found = warc.assemble(warc.read_records(spark, warc.write_pages(df, **options)))
    fields = found["metadata"][0]["payload"]
    return found.select(
        "*",
        warc.field(fields, "page-id").cast("bigint").alias("page_id"),
        warc.field(fields, "refers-to-page-id").cast("bigint").alias("refers_to"),
    ).collect()


def test_round_trip(spark):
    tricky = "WARC/1.1\r\nContent-Length: 9\r\n\r\nnot a record\r\n\r\nWARC/1.1\r\n\r\n"
    pages = [
        (5, "http://a/é?x", "<p>ü</p>"), (3, "http://b/", "<p>ü</p>"), (9, "http://c", "<p>ü</p>"),
        (1, None, None), (2, "odd\r\nX: y", ""), (4, "http://d", tricky), (6, "http://e", "z" * 300_000),
    ]
    rows = {r.page_id: r for r in captures(spark, pages)}
    assert set(rows) == {p[0] for p in pages}
    for page_id, _, html in pages:
        r = rows[page_id]
        assert (r.payload_bytes, r.payload_digest) == (len((html or "").encode()), digest(html))
        assert len(r.requests) == len(r.metadata) == 1 and not r.others
        assert bytes(r.payload) == ((html or "").encode() if r.type == "response" else b"")
    assert {i: (r.type, r.refers_to) for i, r in rows.items()} == {
        3: ("response", None), 5: ("revisit", 3), 9: ("revisit", 3), 1: ("response", None),
        2: ("revisit", 1), 4: ("response", None), 6: ("response", None),
    }
    assert rows[5].target_uri == "http://a/é?x"
    assert b"GET /?x" not in bytes(rows[5].requests[0].payload or b"")


def test_repeated_rows_nulls_and_small_payloads(spark):
    pages = [(1, "u", "aa"), (1, "u", "aa"), (2, "u", "aa"), (None, "u", "aa"), (None, "v", "b"), (7, "w", "b")]
    kinds = sorted((r.page_id or 0, r.type, r.refers_to or 0) for r in captures(spark, pages))
    assert kinds == [
        (0, "revisit", 1), (0, "revisit", 7), (1, "response", 0), (1, "response", 0),
        (2, "revisit", 1), (7, "response", 0),
    ]
    assert {r.type for r in captures(spark, pages, least_bytes=3)} == {"response"}
    assert captures(spark, []) == []


def record(kind: str, name: str, *concurrent: str, block: bytes = b"x") -> bytes:
    head = [b"WARC/1.0", b"WARC-Type: " + kind.encode(), b"warc-record-id: " + name.encode()]
    head += [b"WARC-Concurrent-To: " + c.encode() for c in concurrent]
    head += [b"X-Long: one", b" two", b"Content-Length: %d" % len(block)]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def archive(spark, content: bytes):
    import os

    folder = scratch_folder(spark, "archive").removeprefix("file:")
    os.makedirs(folder)
    with open(f"{folder}/a.warc.gz", "wb") as file:
        file.write(content)
    return warc.read_records(spark, folder)


def test_assembly_in_either_direction(spark):
    parts = [
        record("warcinfo", "i"), record("response", "r1", "q1"), record("request", "q1"),
        record("metadata", "m1", "q1"), record("metadata", "m2", "r1"), record("conversion", "c1", "r1", "r1"),
        record("resource", "r2"), record("request", "lost", "nowhere"),
    ]
    content = b"".join(map(gzip.compress, parts))  # a member for each record
    rows = {r.record_id: r for r in warc.assemble(archive(spark, content)).collect()}
    assert set(rows) == {"r1", "r2", "lost"}
    ids = {k: [[x.record_id for x in rows[k][c]] for c in ("requests", "metadata", "others")] for k in rows}
    assert ids == {"r1": [["q1"], ["m1", "m2"], ["c1"]], "r2": [[], [], []], "lost": [["lost"], [], []]}
    assert rows["lost"].type is None
    assert dict(map(tuple, rows["r1"].headers))["x-long"] == "one two"


@pytest.mark.parametrize("content", [record("request", "q")[:-8], b"no archive\r\n\r\n", gzip.compress(record("a", "b"))[:-9]])
def test_broken_archives_fail(spark, content):
    with pytest.raises(Exception, match="archive ends|record begins"):
        archive(spark, content).collect()
