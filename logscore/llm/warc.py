"""WARC archives: writing captures, reading records, putting transactions together.

Writing: each page becomes a request, a response (or a revisit, when an earlier page has an equal
payload) and a metadata record, tied by WARC-Concurrent-To. Records are built by column expressions
and written by Spark's text writer with the record separator of the format as its line separator, so
files are committed like any output of Spark. They are gzip files of bounded record counts.

Reading: files are read as bytes and cut into records by their Content-Length.

Assembly: request and metadata records name the record they belong to, or another record that does,
by WARC-Concurrent-To, or are named by it. Each capture (a response, revisit or resource record)
becomes one row with its requests and metadata nested.
"""

from __future__ import annotations

import hashlib
import zlib
from base64 import b32encode
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logscore.llm.stored import stored
from logscore.session import scratch_folder

VERSION = "WARC/1.1"
#: Payloads of fewer bytes are always stored in full.
LEAST_BYTES = 0
#: Captures of one file; each makes three records.
CAPTURES_PER_FILE = 2000

_CRLF = "\r\n"
_CAPTURE_TYPES = ("response", "revisit", "resource")
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: str) -> Column:
    """Upper-case base32 of the SHA-1 of a binary column: 40 hex digits, five to four at a time."""
    return _base32(F.sha1(payload))


def _base32(digest: Column) -> Column:
    parts = [
        F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)
    ]
    digits, letters = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    return F.translate(F.upper(F.concat(*parts)), digits, letters)


def _record(kind: str | Column, headers: list[tuple[str, Column | str]], block: Column) -> Column:
    """A record without the separator that ends it. Headers with a null value are left out."""
    lines = [F.lit(VERSION)]
    for name, value in [("WARC-Type", kind), *headers]:
        value = F.lit(value) if isinstance(value, str) else value
        lines.append(F.concat(F.lit(f"{name}: "), value))
    size = F.octet_length(block).cast("string")
    lines.append(F.concat(F.lit("Content-Length: "), size))
    return F.concat(F.concat_ws(_CRLF, *lines), F.lit(_CRLF * 2), block)


def _urn(*parts: Column | str) -> Column:
    digest = F.md5(F.concat_ws("|", *parts))
    cuts = [("<urn:uuid:", 1, 8), ("-", 9, 4), ("-5", 14, 3), ("-8", 18, 3), ("-", 21, 12)]
    texts = (x for lead, at, size in cuts for x in (F.lit(lead), F.substring(digest, at, size)))
    return F.concat(*texts, F.lit(">"))


def write_pages(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> str:
    """Write `page_id`, `url`, `html` rows as an archive; returns its folder.

    Of rows with equal payloads of at least `least_bytes` bytes, those with the smallest page_id are
    responses, the others revisit it; rows that repeat that page_id as well are responses too. A null
    html is an empty payload, a null url an empty one. A null page_id is never the smallest unless
    all of a group are null; then all are responses. Other columns are not touched, an empty table
    gives an empty archive, and a long page is written by the one task that reads it.

    Only digests and ids are shuffled to find the groups, summed up map-side first. The digests of two
    rows or more are written as a table of their own, which the pages meet: where Spark broadcasts it,
    pages go from their scan to the archive.
    """
    text = F.coalesce("html", F.lit("")).alias("html")
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), text)
    rows = rows.select(
        "*", F.octet_length("html").cast("bigint").alias("bytes"), F.sha1("html").alias("sha1")
    )
    least = rows.where(F.col("bytes") >= least_bytes).groupBy("sha1", "bytes")
    least = least.agg(
        F.min_by(F.struct("page_id", "url"), "page_id").alias("least"), F.count("*").alias("rows")
    )
    least = stored(least.where("rows > 1").drop("rows"), "repeated")
    joined = rows.join(least, ["sha1", "bytes"], "left")
    first = F.col("least.page_id")
    revisit = first.isNotNull() & ~first.eqNullSafe(F.col("page_id"))
    shown = F.regexp_replace("url", "[\\r\\n]", "")
    numbered = joined.select(
        "page_id",
        shown.alias("url"),
        "html",
        "bytes",
        F.concat(F.lit("sha1:"), _base32(F.col("sha1"))).alias("digest"),
        revisit.alias("revisit"),
        first.alias("refers_to"),
        F.regexp_replace("least.url", "[\\r\\n]", "").alias("refers_to_url"),
        # A repeated row has ids of its own.
        F.monotonically_increasing_id().alias("number"),
    )
    kinds = ("request", "response", "metadata")
    named = (F.coalesce(F.col("page_id").cast("string"), F.lit("")), "url", "number")
    # Worked out here, so that each is worked out once.
    numbered = numbered.withColumns({f"{x}_id": _urn(*named, F.lit(x)) for x in kinds})
    folder = scratch_folder(pages.sparkSession, "warc")
    records = numbered.select(F.explode(_records(*(F.col(f"{x}_id") for x in kinds))).alias("value"))
    writer = records.write.option("lineSep", _CRLF * 2).option("compression", "gzip")
    writer.option("maxRecordsPerFile", 3 * CAPTURES_PER_FILE).text(folder)
    return folder


def _records(request: Column, response: Column, metadata: Column) -> Column:
    date = "2024-01-01T00:00:00Z"
    path = F.regexp_replace("url", "^[a-z]+://[^/]*", "")
    host = F.regexp_extract("url", "^[a-z]+://([^/]*)", 1)
    asked = F.concat(
        F.lit("GET "), F.when(path == "", "/").otherwise(path), F.lit(" HTTP/1.1\r\nHost: "), host,
        F.lit(_CRLF * 2),
    )
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"),
        F.lit(_CRLF * 2),
    )
    is_revisit = F.col("revisit")
    block = F.when(is_revisit, head).otherwise(F.concat(head, F.col("html")))
    known = F.when(is_revisit, F.col("refers_to").cast("string"))
    fields = F.concat_ws(
        _CRLF,
        F.concat(F.lit("page-id: "), F.col("page_id").cast("string")),
        F.concat(F.lit("refers-to-page-id: "), known),
        F.lit(""),
    )
    common = [("WARC-Date", date), ("WARC-Target-URI", F.col("url"))]
    return F.array(
        _record(
            "request",
            [
                ("WARC-Record-ID", request),
                *common,
                ("WARC-Concurrent-To", response),
                ("Content-Type", "application/http; msgtype=request"),
            ],
            asked,
        ),
        _record(
            F.when(is_revisit, "revisit").otherwise("response"),
            [
                ("WARC-Record-ID", response),
                *common,
                ("WARC-Payload-Digest", F.col("digest")),
                ("WARC-Profile", F.when(is_revisit, _PROFILE)),
                ("WARC-Refers-To-Target-URI", F.when(is_revisit, F.col("refers_to_url"))),
                ("WARC-Refers-To-Date", F.when(is_revisit, date)),
                ("Content-Type", "application/http; msgtype=response"),
            ],
            block,
        ),
        _record(
            "metadata",
            [
                ("WARC-Record-ID", metadata),
                *common,
                ("WARC-Concurrent-To", response),
                ("Content-Type", "application/warc-fields"),
            ],
            fields,
        ),
    )


def _cut(data: Iterator[bytes]) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
    """Headers and block of each record of a stream."""
    held = bytearray()
    ended = False

    def fill(size: int) -> bool:
        nonlocal ended
        while len(held) < size and not ended:
            piece = next(data, None)
            if piece is None:
                ended = True
            else:
                held.extend(piece)
        return len(held) >= size

    while True:
        while fill(2) and held[:2] == b"\r\n":
            del held[:2]
        if not held:
            return
        at, seen = -1, 0
        while (at := held.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
            seen = len(held)
            if not fill(seen + 1):
                raise ValueError("an archive ends within the headers of a record")
        lines = bytes(held[:at]).decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"a record begins with {lines[0][:40]!r}")
        headers: list[tuple[str, str]] = []
        for line in lines[1:]:
            if line[:1] in " \t" and headers:  # goes on from the line before
                headers[-1] = (headers[-1][0], f"{headers[-1][1]} {line.strip()}")
            elif ":" in line:
                name, value = line.split(":", 1)
                headers.append((name.strip().lower(), value.strip()))
        size = int(dict(headers).get("content-length", 0))
        if not fill(at + 4 + size):
            raise ValueError("an archive ends within the block of a record")
        block = bytes(held[at + 4 : at + 4 + size])
        del held[: at + 4 + size]
        yield headers, block


def _unzipped(content: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """The bytes of a file; of gzip members one after the other."""
    if content[:2] != b"\x1f\x8b":
        yield content
        return
    left = content
    while left:
        member = zlib.decompressobj(wbits=31)
        while not member.eof:
            piece = member.decompress(left, step)
            left = member.unconsumed_tail if not member.eof else member.unused_data
            if piece:
                yield piece
            elif not left and not member.eof:
                raise ValueError("an archive ends within a gzip member")


RECORDS = (
    "record_id string, type string, date string, target_uri string, concurrent_to array<string>, "
    "headers array<struct<name:string,value:string>>, http_headers string, payload binary, "
    "payload_bytes bigint, payload_digest string"
)
_HEADERS = pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))
_KINDS = [
    *[pa.string()] * 4, pa.list_(pa.string()), _HEADERS, pa.string(), pa.binary(), pa.int64(),
    pa.string(),
]


def _row(headers: list[tuple[str, str]], block: bytes) -> tuple:
    values = dict(headers)
    kind = values.get("warc-type")
    http, payload = None, block
    if values.get("content-type", "").startswith("application/http"):
        head, found, rest = block.partition(b"\r\n\r\n")
        if found:
            http, payload = head.decode("utf-8", "replace"), rest
    size, digest = len(payload), b32encode(hashlib.sha1(payload).digest()).decode()
    if kind == "revisit":  # its payload is elsewhere; the headers tell of it
        lines = (line.partition(":") for line in (http or "").split("\r\n"))
        sizes = [v.strip() for name, _, v in lines if name.strip().lower() == "content-length"]
        size = int(sizes[0]) if sizes and sizes[0].isdigit() else None
        digest = values.get("warc-payload-digest", "").removeprefix("sha1:") or None
    concurrent = [value for name, value in headers if name == "warc-concurrent-to"]
    named = [{"name": name, "value": value} for name, value in headers]
    return (
        values.get("warc-record-id"), kind, values.get("warc-date"), values.get("warc-target-uri"),
        concurrent, named, http, payload, size, digest,
    )


def read_records(spark: SparkSession, folder: str, batch_bytes: int = 4 << 20) -> DataFrame:
    """One row per record of the archive files in a folder, plain or gzip.

    The payload is the block without HTTP headers. Its size and digest are worked out from the bytes;
    for a revisit they are those its headers state of the full payload. Rows are handed on in batches
    of about `batch_bytes`.
    """

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        names = [x.split(" ")[0] for x in RECORDS.split(", ")]
        columns = zip(*rows, strict=True)
        arrays = [pa.array(list(x), kind) for x, kind in zip(columns, _KINDS, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for files in batches:
            for content in files.column("content"):
                rows, size = [], 0
                for headers, block in _cut(_unzipped(content.as_py())):
                    rows.append(_row(headers, block))
                    size += len(block) + 1000
                    if size >= batch_bytes:
                        yield batch(rows)
                        rows, size = [], 0
                if rows:
                    yield batch(rows)

    files = spark.read.format("binaryFile").load(folder).select("content")
    return files.mapInArrow(work, RECORDS)


def assemble(
    records: DataFrame, nested: tuple[str, ...] = ("record_id", "date", "payload")
) -> DataFrame:
    """One row per capture: its columns, and `requests`, `metadata` and `others` nested.

    A side record belongs to the capture that its WARC-Concurrent-To names, else to the one whose
    WARC-Concurrent-To names it, else to that of a side record it names. Records that belong to none
    are not lost: each is a row of its own with a null `type` and itself nested. Nested records are
    in order of their id; repeated concurrent-to values count once. Extra columns of the records stay
    with the captures; no records give no rows. Only side records are grouped; they are summed up
    map-side by capture, and the captures with their payloads are joined once.
    """
    is_capture = F.coalesce(F.col("type").isin(*_CAPTURE_TYPES), F.lit(False))
    side = F.when(~is_capture, F.struct(*nested))
    # All but the captures' payloads, written once, so that records are read twice and no more.
    links = records.where(is_capture | ~F.col("type").eqNullSafe(F.lit("warcinfo")))
    links = links.select("record_id", "type", "concurrent_to", is_capture.alias("is_capture"), side.alias("side"))
    links = stored(links, "links")
    captures = links.where("is_capture")
    sides = links.where("NOT is_capture")
    ids = captures.select(F.col("record_id").alias("capture"))
    named = sides.select("record_id", F.explode("concurrent_to").alias("other"))
    forward = named.join(ids, F.col("other") == F.col("capture")).select("record_id", "capture")
    naming = captures.select(
        F.explode("concurrent_to").alias("record_id"), F.col("record_id").alias("capture")
    )
    direct = forward.union(naming).groupBy("record_id").agg(F.min("capture").alias("capture"))
    through = named.join(direct.withColumnRenamed("record_id", "other"), "other")
    through = through.groupBy("record_id").agg(F.min("capture").alias("far"))
    placed = sides.join(direct, "record_id", "left").join(through, "record_id", "left")
    capture = F.coalesce("capture", "far", "record_id")

    def listed(condition: Column) -> Column:
        return F.array_sort(F.collect_list(F.when(condition, F.col("side"))))

    grouped = placed.groupBy(capture.alias("record_id")).agg(
        listed(F.col("type") == "request").alias("requests"),
        listed(F.col("type") == "metadata").alias("metadata"),
        listed(~F.coalesce(F.col("type").isin("request", "metadata"), F.lit(False))).alias("others"),
    )
    joined = records.where(is_capture).join(grouped, "record_id", "full")
    empty = F.array().cast(grouped.schema["requests"].dataType)
    filled = {x: F.coalesce(x, empty) for x in ("requests", "metadata", "others")}
    return joined.withColumns(filled)


def field(block: Column, name: str) -> Column:
    """A field of an `application/warc-fields` block, null if absent."""
    found = F.regexp_extract(block.cast("string"), f"(?m)^{name}: (.*?)\\r?$", 1)
    return F.when(found != "", found)
