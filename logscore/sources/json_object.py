"""A file that is one JSON object, read by many tasks.

Such a file has no lines to split it at. It is read in byte ranges whose records end in a closing brace
instead. What a brace or comma means depends on whether the range begins within a string and how deep,
which only the ranges before tell. So each range is first summarised for both cases: the quotes in it,
by how much it goes deeper, its commas by depth. The summaries, one row for each range, are added up
along the file; with its beginning known, each range then cuts its own members. Those that cross
ranges are put together from their fragments.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_ESCAPE = re.compile(rb"\\.", re.DOTALL)
_STRING_REST = re.compile(rb"(?:[^\"\\]|\\.)*", re.DOTALL)
_TOKEN = re.compile(rb"\"(?:[^\"\\]|\\.)*(\"?)|[{}\[\],]", re.DOTALL)
_NOT_STRUCTURE = bytes(sorted(set(range(256)) - set(b"{}[],")))
_DEEPER = {ord("{"): 1, ord("["): 1, ord("}"): -1, ord("]"): -1}


def _summary(segments: Iterator[bytes]) -> list:
    """Quotes, then for a range that begins outside and one that begins within a string: how much
    deeper it ends, and its commas by depth."""
    quotes, depth, commas = 0, [0, 0], [Counter(), Counter()]
    for segment in segments:
        if b"\\" in segment:
            segment = _ESCAPE.sub(b"", segment)
        parts = (segment + b"}").split(b'"')
        for case in (0, 1):
            for part in parts[(case + quotes) % 2 :: 2]:
                for token in part.translate(None, _NOT_STRUCTURE):
                    change = _DEEPER.get(token)
                    if change is None:
                        commas[case][depth[case]] += 1
                    else:
                        depth[case] += change
        quotes += len(parts) - 1
    return [quotes, *depth, *(list(c.items()) for c in commas)]


_RANGES = (
    "file string, block bigint, size bigint, bytes bigint, last binary, quotes bigint, "
    "deeper_out bigint, deeper_in bigint, commas_out map<bigint, bigint>, commas_in map<bigint, bigint>"
)


def _ranges_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[bytes]]]:
    """The records of each byte range of a task, which come one range after the other."""
    rows = (
        row
        for batch in batches
        for row in zip(*(batch.column(c).to_pylist() for c in batch.schema.names), strict=True)
    )
    ahead = next(rows, None)
    while ahead is not None:
        head = ahead

        def of_range(head=head) -> Iterator[bytes]:
            nonlocal ahead
            while ahead is not None and ahead[1:3] == head[1:3]:
                segment = ahead[0]
                ahead = next(rows, None)
                yield segment

        segments = of_range()
        yield head[1:], segments
        for _ in segments:
            pass


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (file, block, size), segments in _ranges_of(batches):
        bytes_, last = 0, b""

        def counted(segments=segments) -> Iterator[bytes]:
            nonlocal bytes_, last
            for last in segments:
                bytes_ += len(last) + 1
                yield last

        quotes, out, within, *commas = _summary(counted())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([file]), pa.array([block]), pa.array([size]), pa.array([bytes_]),
                pa.array([last.strip()[:1]], pa.binary()), pa.array([quotes]),
                pa.array([out]), pa.array([within]),
                *(pa.array([c], pa.map_(pa.int64(), pa.int64())) for c in commas),
            ],
            names=[part.split()[0] for part in re.split(r", (?=[a-z_]+ )", _RANGES)],
        )


_MEMBERS = "file string, member bigint, block bigint, text binary, stray boolean"


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members that a range has, or its fragments of them."""
    for (file, block, inside, depth, member), segments in _ranges_of(batches):
        held, rows = [], []

        def out(text: bytes, stray: bool = False) -> None:
            rows.append((file, member, block, text, stray))

        for segment in segments:
            text, at = segment + b"}", 0
            if inside:
                at = _STRING_REST.match(text).end()
                inside = at == len(text)
                at += not inside
            start = 0
            for token in _TOKEN.finditer(text, at) if not inside else ():
                kind = text[token.start()]
                if kind == ord('"'):
                    inside = not token[1]
                elif kind == ord(","):
                    if depth == 1:
                        out(b"".join([*held, text[start : token.start()]]))
                        held, start, member = [], token.end(), member + 1
                else:
                    depth += _DEEPER[kind]
                    if depth == 1 and _DEEPER[kind] > 0:
                        before = b"".join([*held, text[start : token.start()]])
                        if before.strip() or kind != ord("{"):
                            out(before, stray=True)
                        held, start = [], token.end()
                    elif depth == 0 and _DEEPER[kind] < 0:
                        out(b"".join([*held, text[start : token.start()]]))
                        held, start = [], token.end()
            held.append(text[start:])
            if len(rows) >= 1000:
                yield _batch(rows)
                rows.clear()
        # What is left goes on in the next range; behind the object it is checked as a whole.
        left = b"".join(held)
        if depth > 0:
            out(left)
        elif depth == 0 and left.strip():
            out(left, stray=True)
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 5
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.bool_()]
    names = [part.split()[0] for part in _MEMBERS.split(", ")]
    arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def json_members(spark: SparkSession, path: str) -> DataFrame:
    """The members of files that each are one JSON object: `file`, `member` (its number in the file)
    and `text`, a member's key and value as they stand.

    A file that is not one whole object gives a row with a NULL `text`.
    """
    segments = spark.read.option("lineSep", "}").text(path).select(
        F.col("value").cast("binary").alias("segment"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"),
    )
    ranges = segments.mapInArrow(_summaries, _RANGES)
    along = Window.partitionBy("file").orderBy("block")  # one row for each byte range
    before = along.rowsBetween(Window.unboundedPreceding, -1)

    def earlier(column: str):
        return F.coalesce(F.sum(column).over(before), F.lit(0))

    ranges = ranges.withColumn("inside", earlier("quotes") % 2 == 1)
    ranges = ranges.withColumn("deeper", F.expr("if(inside, deeper_in, deeper_out)"))
    ranges = ranges.withColumn("depth", earlier("deeper"))
    here = F.expr("coalesce(try_element_at(if(inside, commas_in, commas_out), 1 - depth), 0L)")
    ranges = ranges.withColumn("commas", here).withColumn("member", earlier("commas"))
    starts = ranges.select("file", "block", "inside", "depth", "member")
    # The last record ends in a brace if the file does; else it is the blank text behind the object.
    ends = ranges.groupBy("file").agg(
        F.max("size").alias("size"),
        F.sum("bytes").alias("bytes"),
        (F.sum("quotes") % 2 == 0).alias("outside"),
        F.sum("deeper").alias("deeper"),
        F.max_by("last", "block").alias("last"),
    )
    braced = (F.col("bytes") == F.col("size")) & (F.col("deeper") == 0)
    blank = (F.col("bytes") > F.col("size")) & (F.col("deeper") == -1) & (F.col("last") == F.lit(b""))
    ends = ends.select("file", (F.col("outside") & (braced | blank)).alias("closed"))
    cut = (
        segments.drop("size")
        .join(F.broadcast(starts), ["file", "block"])  # one row for each byte range
        .select("segment", "file", "block", "inside", "depth", "member")
        .mapInArrow(_members, _MEMBERS)
    )
    parts = F.sort_array(F.collect_list(F.struct("block", "text")))  # one for most members
    text = F.aggregate("parts", F.lit(b""), lambda joined, part: F.concat(joined, part["text"]))
    members = cut.groupBy("file", "member", "stray").agg(parts.alias("parts"))
    members = members.select("file", "member", "stray", text.cast("string").alias("text"))
    sound = F.col("closed") & ~F.col("stray")
    return members.join(F.broadcast(ends), "file").select(  # one row for each file
        "file", "member", F.when(sound, F.col("text")).alias("text")
    )
