"""Conversation prefix trie by van Emde Boas recursion.

A trie of sequences of up to 2^k turns is cut at half depth. The first halves
are an upper trie; each distinct first half that goes on is a cut prefix with a
name, and the second halves under one name are a lower trie. Both kinds are cut
again in the same way, all tries of one size in the same job, until each is one
turn deep. So there are as many steps as the depth has binary digits, and no
step looks at a conversation or a trie as a whole:

1. Upwards, turns are joined two and two to named segments of 2^j turns.
2. Downwards, each cut prefix is named by the name above it and the segment
   after it. The last step has named every prefix: the nodes.
3. Upwards again, the totals of each lower trie are grafted onto the nodes of
   the upper trie that lie on the way to its cut prefix.

Names are 128-bit digests of the names or turns that they join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhawk.llm.common import saved
from tallyhawk.operators.ranking import exclusive_prefix, range_bucket

#: ids in one text when the members that end at a node are listed
CHUNK_IDS = 4096
NO_IDS = hashlib.sha256(b"").hexdigest()


def _name(*parts: Column) -> Column:
    return F.unhex(F.md5(F.concat(*parts)))


def turns_of(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
             role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv, pos (from 0, in the order of the turn numbers, null first), name
    (of role and text) and bytes (of the text) of every turn.

    Null roles and texts are empty. Rows that share a turn number are ordered
    by the digest of role and text; rows without a conversation id are left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    length = F.octet_length(role).cast("string")
    turns = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
        _name(length.cast("binary"), F.lit(b":"), role.cast("binary"), text.cast("binary")).alias("name"),
        F.octet_length(text).cast("long").alias("bytes"))
    placed = range_bucket(turns, [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("name")], "bucket")
    placed = exclusive_prefix(placed, [F.col("turn").asc_nulls_first(), F.col("name")], "bucket",
                              {"pos": F.lit(1).cast("long")}, ["conv"])
    return saved(placed.select("conv", "pos", "name", "bytes"), "turns")


def with_heads(turns: DataFrame, source: Column, most: Column, limit: int) -> tuple[DataFrame, DataFrame]:
    """(turns, members) where each conversation begins with the first ``most``
    turns (fewer than ``limit``; an expression on ``conv``) of conversation
    ``source`` (all if it has fewer, none if there is none) and goes on with
    its own turns after its first ``most``."""
    sizes = turns.groupBy("conv").agg(F.count("*").alias("size"))
    plan = sizes.select("conv", source.alias("source"), most.cast("long").alias("most"))
    plan = saved(plan.join(sizes.select(F.col("conv").alias("source"), "size"), "source", "left")
                 .select("conv", "source", "most", F.least("most", F.coalesce("size", F.lit(0))).alias("taken")), "heads")
    first = turns.where(F.col("pos") < limit).withColumnRenamed("conv", "source")
    head = first.join(plan, "source").where("pos < most").select("conv", "pos", "name", "bytes")
    tail = (turns.join(plan, "conv").where("pos >= most")
            .select("conv", (F.col("taken") + F.col("pos") - F.col("most")).alias("pos"), "name", "bytes"))
    return saved(head.unionByName(tail), "rebuilt-turns"), plan.select("conv")


def _half(n: Column | str) -> Column:
    return F.shiftright(n, 1)


def prefixes(turns: DataFrame, members: DataFrame, levels: int) -> DataFrame:
    """(conv, depth, size: turns of the conversation, name) of every prefix."""
    segments = [turns.select("conv", F.col("pos").alias("at"), "name")]
    for _ in range(levels - 1):
        pairs = (segments[-1].groupBy("conv", _half("at").alias("at"))
                 .agg(F.min_by("name", "at").alias("left"), F.max_by("name", "at").alias("right"), F.count("*").alias("n")))
        segments.append(saved(pairs.where("n = 2").select("conv", "at", _name(F.col("left"), F.col("right")).alias("name")),
                              "segments"))
    sizes = turns.groupBy("conv").agg(F.count("*").alias("size"))
    cuts = members.join(sizes, "conv", "left").select(
        "conv", F.lit(0).cast("long").alias("at"), F.coalesce("size", F.lit(0).cast("long")).alias("size"),
        F.lit(b"").alias("name"))
    for segment in reversed(segments):
        after = segment.where("at % 2 = 0").select("conv", _half("at").alias("at"), F.col("name").alias("next"))
        both = F.array_compact(F.array(
            F.struct((F.col("at") * 2).alias("at"), "name"),
            F.when(F.col("next").isNotNull(), F.struct((F.col("at") * 2 + 1).alias("at"), _name(F.col("name"), F.col("next")).alias("name")))))
        cuts = saved(cuts.join(after, ["conv", "at"], "left").select("conv", "size", F.explode(both).alias("cut"))
                     .select("conv", "cut.at", "size", "cut.name"), "cut-prefixes")
    return cuts.withColumnRenamed("at", "depth")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (name, conv) to (name, first, ids: some of its ids in a text)."""
    name, ids, out = None, [], []
    for batch in batches:
        for own, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if ids and (own != name or len(ids) == CHUNK_IDS):
                out.append((name, ids[0], ",".join(map(str, ids))))
                ids = []
            name = own
            ids.append(conv)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["name", "first", "ids"])
            out = []
    if ids:
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([ids[0]]), pa.array([",".join(map(str, ids))])],
                                         ["name", "first", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (name, first, ids) to (name, digest); holds one hash."""
    name, digest = None, None
    for batch in batches:
        names, digests = [], []
        for own, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if own != name or digest is None:
                if digest is not None:
                    names.append(name)
                    digests.append(digest.hexdigest())
                name, digest = own, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        if names:
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(digests)], ["name", "ends"])
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([digest.hexdigest()])], ["name", "ends"])


def end_digests(ends: DataFrame) -> DataFrame:
    """(name, ends): digest of the ascending ids of the conversations that end
    at a node, joined by commas. Ids are put into texts in a range sort, so the
    task that hashes a very common end reads one row for many ids."""
    chunks = (ends.repartitionByRange("name", "conv").sortWithinPartitions("name", "conv")
              .mapInArrow(_chunks, "name binary, first long, ids string"))
    return (chunks.repartition("name").sortWithinPartitions("name", "first")
            .mapInArrow(_digests, "name binary, ends string"))


def grafted(nodes: DataFrame, paths: DataFrame, levels: int) -> DataFrame:
    """``nodes`` (name, conv, depth, parent, saved, leaves: each node's own)
    with the totals of whole subtrees in ``saved`` and ``leaves``.

    Before step j a node holds the total of its block of 2^j depths. Then, for
    every node w at the last depth of an upper block, the totals of its children
    (the lower trie under w) go to all nodes of that block that lie on the way
    to w: they are the prefixes of any of its members.
    """
    paths = paths.where("depth > 0").select("conv", "name", "depth")
    for j in range(levels):
        block = F.shiftright(F.col("depth") - 1, j)
        at_cut = (F.col("depth") > 1) & (F.pmod(block, F.lit(2)) == 1) & ((F.col("depth") - 1) % (1 << j) == 0)
        lower = nodes.where(at_cut).groupBy("parent").agg(F.min("conv").alias("conv"), F.first(block).alias("block"),
                                                          F.sum("saved").alias("more"), F.sum("leaves").alias("tips"))
        way = lower.select("conv", (F.col("block") - 1).alias("block"), "more", "tips").join(
            paths.withColumn("block", block), ["conv", "block"])
        more = way.groupBy("name").agg(F.sum("more").alias("more"), F.sum("tips").alias("tips"))
        nodes = saved(nodes.join(more, "name", "left").select(
            "name", "conv", "depth", "parent", (F.col("saved") + F.coalesce("more", F.lit(0))).alias("saved"),
            (F.col("leaves") + F.coalesce("tips", F.lit(0))).alias("leaves")), "grafted")
    return nodes


def prefix_trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """One row per distinct prefix of the conversations ``members`` (conv:
    unique, not null) with ``turns`` (conv, pos from 0 without gaps, name,
    bytes): conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.

    Conversations without turns are members of the root alone. The root has
    no text and no parent. No members give no nodes.
    """
    deepest = turns.agg(F.max("pos")).first()[0]
    levels = 0 if deepest is None else (deepest + 1).bit_length()
    if levels:
        paths = prefixes(turns, members, levels)
    else:
        zero = F.lit(0).cast("long")
        paths = saved(members.select("conv", zero.alias("depth"), zero.alias("size"), F.lit(b"").alias("name")), "cut-prefixes")
    nodes = paths.groupBy("name").agg(F.min("conv").alias("conv"), F.first("depth").alias("depth"), F.count("*").alias("n_convs"))
    above = (paths.select("conv", "depth", F.col("name").alias("parent"))
             .join(turns.select("conv", F.col("pos").alias("depth"), "bytes"), ["conv", "depth"])
             .select("conv", (F.col("depth") + 1).alias("depth"), "parent", "bytes"))
    nodes = saved(nodes.join(above, ["conv", "depth"], "left"), "trie-nodes")
    below = nodes.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("name")).agg(F.count("*").alias("n_children"))
    nodes = saved(nodes.join(below, "name", "left").fillna({"n_children": 0}), "trie-nodes")
    own = nodes.where("depth > 0").select(
        "name", "conv", "depth", "parent", ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
        (F.col("n_children") == 0).cast("long").alias("leaves"))
    totals = grafted(own, paths, levels)
    top = totals.where("depth = 1").groupBy("parent").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
    totals = totals.select("name", "saved", "leaves").unionByName(top.withColumnRenamed("parent", "name"))
    ends = end_digests(paths.where("depth = size").select("name", "conv"))
    parents = nodes.select(F.col("name").alias("parent"), F.col("conv").alias("parent_conv_id"))
    return (nodes.join(totals, "name", "left").join(ends, "name", "left").join(parents, "parent", "left").select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children",
        F.coalesce("leaves", F.lit(1).cast("long")).alias("n_leaves"),
        F.coalesce("saved", F.lit(0).cast("long")).alias("saved_tokens"),
        F.coalesce("ends", F.lit(NO_IDS)).alias("ends_sha256")))
