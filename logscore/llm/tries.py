"""Prefix trie of conversations, its totals rolled up by bands of depth.

A node is a sequence of turns with which conversations begin; the smallest conversation that does is
its name, so (depth, name) identifies it. Totals of subtrees come in two movements. Within a band of
`BAND` depths each node is added to its ancestors in the band, at most `BAND` rows a node. The roots of the
bands then form a trie of their own, `BAND` times less deep, which is rolled up in the same way; its
completed totals are handed down to the ancestors in the band above. So a trie of depth d takes
log d / log `BAND` rounds and no row is copied more than `BAND` times in one.

A conversation with very many turns and a prefix that very many conversations share are both spread
over tasks: turns are numbered by ranges, members are counted map-side.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logscore.llm.scan import running
from logscore.llm.stored import stored

BAND = 16
#: A conversation's first turns are those of the first conversation of its block of ids.
BLOCK = 20
MOST_SHARED = 3
#: Conversation ids that are hashed from one row.
IDS_PER_ROW = 4096

_WORDS = r"[^\x20\x09-\x0D]+"
_NODE = ["depth", "conv_id"]


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """`conv_id`, `i` (from 1), `digest` and `n_words` of each turn.

    A null turn comes first, turns with the same number by the digest of role and text.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.sha2(whole, 256).alias("digest"),
        F.regexp_count(text, F.lit(_WORDS)).cast("bigint").alias("n_words"),
    )
    return running(turns, "conv_id", ["turn", "digest"], number="i").drop("turn")


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations, each with its `n_turns` once rebuilt, and their rebuilt turns by `depth`.

    The first h turns of conversation c come from c - c % 20, where h is the CRC-32 of c in decimal
    modulo 4; its own turns follow from the one after h on.
    """
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("n_own"))
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_SHARED + 1)
    convs = convs.withColumns({"base": F.expr(f"conv_id - conv_id % {BLOCK}"), "h": shared})
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n_own").alias("n_base"))
    convs = convs.join(bases, "base", "left")
    convs = convs.withColumn("n_taken", F.least("h", F.coalesce("n_base", F.lit(0))))
    n_turns = F.col("n_taken") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))
    convs = stored(
        convs.select("conv_id", "base", "h", "n_taken", n_turns.alias("n_turns")), "conversations"
    )
    own = turns.join(convs, "conv_id").where("i > h")
    own = own.withColumn("depth", F.expr("n_taken + i - h"))
    heads = turns.where(f"i <= {MOST_SHARED}").withColumnRenamed("conv_id", "base")
    taken = heads.join(convs, "base").where("i <= h").withColumn("depth", F.col("i"))
    columns = ["conv_id", "depth", "digest", "n_words", "n_turns"]
    return convs.select("conv_id", "n_turns"), own.select(columns).union(taken.select(columns))


def _members(convs: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes, and each conversation's nodes by depth: `member`, `depth` and `conv_id`, the name."""
    marks = {
        "a": F.xxhash64("digest", "depth"),
        "b": F.xxhash64("depth", "digest"),
    }
    marked = turns.withColumns(marks).drop("digest")
    paths = running(marked, "conv_id", ["depth"], number="place", xors=["a", "b"]).drop("place")
    paths = paths.withColumnRenamed("conv_id", "member")
    paths = stored(paths.withColumn("last", F.expr("depth = n_turns")).drop("n_turns"), "paths")
    nodes = paths.groupBy("depth", "a", "b").agg(
        F.min("member").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.count_if("last").alias("n_ends"),
        F.min("n_words").alias("n_words"),
    )
    nodes = stored(nodes, "nodes")
    paths = paths.join(nodes.select("depth", "a", "b", "conv_id"), ["depth", "a", "b"])
    root = convs.agg(
        F.lit(0).cast("bigint").alias("depth"),
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.count_if(F.col("n_turns") == 0).alias("n_ends"),
        F.lit(0).cast("bigint").alias("n_words"),
    ).where("n_convs > 0")
    top = root.first()
    rooted = convs.select(
        F.col("conv_id").alias("member"),
        F.lit(0).cast("bigint").alias("depth"),
        F.lit(top["conv_id"] if top else None).cast("bigint").alias("conv_id"),
        (F.col("n_turns") == 0).alias("last"),
    )
    columns = ["member", "depth", "conv_id", "last"]
    return nodes.drop("a", "b").unionByName(root), rooted.unionByName(paths.select(columns))


def _bands(paths: DataFrame, band: int) -> DataFrame:
    """For each node its ancestors in its band, the node last, as `ups`; the root of a band also
    (`below`) with those in the band above."""
    level = F.expr(f"depth div {band}")
    own = paths.withColumn("band", level)
    roots = paths.where(f"depth % {band} = 0 AND depth > 0").withColumn("band", level - 1)
    both = own.select("member", "depth", "conv_id", "band").union(
        roots.select("member", "depth", "conv_id", "band")
    )
    grouped = both.groupBy("member", "band").agg(
        F.sort_array(F.collect_list(F.struct("depth", "conv_id"))).alias("path")  # band + 1 at most
    )
    # Whoever names a node names all below it on its own path.
    named = grouped.where(F.element_at("path", -1)["conv_id"] == F.col("member"))
    at = named.select("member", "band", "path", F.posexplode("path").alias("place", "node"))
    at = at.where("node.conv_id = member")
    ups = F.slice("path", F.lit(1), F.col("place") + 1)
    below = F.col("node.depth") == (F.col("band") + 1) * band
    return at.select("node.depth", "node.conv_id", below.alias("below"), ups.alias("ups"))


def _spread(ups: DataFrame, values: DataFrame, sums: list[str]) -> DataFrame:
    """The values of nodes added up over the nodes in their `ups`."""
    rows = ups.join(values, _NODE).select(F.explode("ups").alias("up"), *sums)
    return rows.groupBy(
        F.col("up.depth").alias("depth"), F.col("up.conv_id").alias("conv_id")
    ).agg(*(F.sum(c).alias(c) for c in sums))


def subtree_totals(paths: DataFrame, values: DataFrame, sums: list[str], band: int = BAND) -> DataFrame:
    """`values` (one row for each node, columns `sums`) added up over the subtree of each node.

    `paths` has, for each conversation (`member`), the name `conv_id` of its node at each `depth`.
    """
    top = paths.agg(F.max("depth")).first()[0]
    bands = stored(_bands(paths, band), "bands")
    within = _spread(bands.where("NOT below").drop("below"), values, sums)
    if top is None or top < band:
        return within
    within = stored(within, "within")
    roots = f"depth % {band} = 0"
    higher = F.expr(f"depth div {band}").alias("depth")
    completed = subtree_totals(
        paths.where(roots).select("member", higher, "conv_id"),
        within.where(roots).select(higher, "conv_id", *sums),
        sums,
        band,
    )
    completed = completed.where("depth > 0").withColumn("depth", F.col("depth") * band)
    above = F.filter("ups", lambda up: up["depth"] < F.col("depth"))
    handed = _spread(bands.where("below").drop("below").withColumn("ups", above), completed, sums)
    return within.unionByName(handed).groupBy(*_NODE).agg(*(F.sum(c).alias(c) for c in sums))


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows in, up to `IDS_PER_ROW` ids of a node in a row out."""
    held: list[int] = []
    node = None

    def row() -> pa.RecordBatch:
        ids = ",".join(map(str, held))
        return pa.RecordBatch.from_pylist(
            [{"depth": node[0], "conv_id": node[1], "first": held[0], "ids": ids}]
        )

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("depth", "conv_id", "member"))
        for depth, conv_id, member in zip(*columns, strict=True):
            if held and (node != (depth, conv_id) or len(held) == IDS_PER_ROW):
                yield row()
                held = []
            node = (depth, conv_id)
            held.append(member)
    if held:
        yield row()


def _hashed_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of each node's ids, row by row, so that a task holds no more than a batch."""
    state, node = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(
            [{"depth": node[0], "conv_id": node[1], "ends_sha256": state.hexdigest()}]
        )

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("depth", "conv_id", "ids"))
        for depth, conv_id, ids in zip(*columns, strict=True):
            if node != (depth, conv_id):
                if node is not None:
                    yield row()
                state, node = hashlib.sha256(), (depth, conv_id)
                state.update(ids.encode())
            else:
                state.update(b"," + ids.encode())
    if node is not None:
        yield row()


def _ends(paths: DataFrame) -> DataFrame:
    """`ends_sha256` of the nodes at which conversations end."""
    by = [*_NODE, "member"]
    rows = paths.where("last").select(*by).repartitionByRange(*by).sortWithinPartitions(*by)
    joined = rows.mapInArrow(
        _joined_ids, "depth bigint, conv_id bigint, first bigint, ids string"
    )
    dealt = joined.withColumn("_dealt_by", F.xxhash64(*_NODE)).repartition("_dealt_by")
    return (
        dealt.sortWithinPartitions(*_NODE, "first")
        .drop("_dealt_by")
        .mapInArrow(_hashed_ids, "depth bigint, conv_id bigint, ends_sha256 string")
    )


def trie(conversations: DataFrame, band: int = BAND) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations.

    Reads `conv_id`, `turn`, `role` and `text`; other columns are not touched. A null role or text
    counts as empty, a null turn comes first; turns that share a number are in the order of the
    SHA-256 of `<bytes of role>:<role><text>`, so repeated rows are as many turns. Rows without a
    conv_id belong to no conversation. Texts enter whole, by that digest and their number of words.
    An empty table gives no node, not even a root. Sequences are told apart by 128 bits.

    Columns: `conv_id` (the smallest member), `depth`, `parent_conv_id`, `n_convs`, `n_children`,
    `n_leaves`, `saved_tokens`, `ends_sha256`; the node's turns are those of `rebuilt_turns`, at
    depths 1 to `depth` of conversation `conv_id`.
    """
    convs, turns = rebuilt_turns(ordered_turns(conversations))
    nodes, paths = _members(convs, turns)
    nodes, paths = stored(nodes, "nodes"), stored(paths, "paths")
    values = nodes.select(
        *_NODE,
        (F.col("n_ends") == F.col("n_convs")).cast("bigint").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("n_words")).alias("saved_tokens"),
    )
    totals = subtree_totals(paths, values, ["n_leaves", "saved_tokens"], band)
    lists = _bands(paths, band).where(F.size("ups") > 1)
    parents = lists.select(*_NODE, F.element_at("ups", -2)["conv_id"].alias("parent_conv_id"))
    parents = stored(parents, "parents")
    children = parents.groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("parent_conv_id").alias("conv_id")
    ).agg(F.count("*").alias("n_children"))
    found = nodes.join(totals, _NODE).join(parents, _NODE, "left").join(children, _NODE, "left")
    found = found.join(_ends(paths), _NODE, "left")
    return found.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
    )
