"""Chat formatting as a prefix tree.

Conversations that begin with the same turns share them: every distinct prefix
is one node, its formatted turn is emitted once, and the nodes of a tree (one
tree per distinct first turn) are laid out depth-first in one packed sequence.
A node carries its place in that sequence, its position ids (which go on from
its parent, not from its neighbour in the sequence), the intervals of the
sequence that it may attend to (its ancestors and itself) and the span of the
loss. Units are characters (code points).

Prefixes are recognised by running sums of two 64-bit hashes of (place, role,
text) along a conversation. Runs of nodes without a branch are laid out as one
segment, so the sort key of a node grows with the branches above it, not with
its depth. Places in a tree come from a two-level running sum over range
partitions, so a tree that holds a third of all turns is no single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhawk.llm.common import saved

OPEN, COLON, CLOSE = "### ", ": ", "</turn>\n"
#: (plain, escaped); the first has to be first when escaping and last when undoing it
ESCAPES = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"))
ROLE_ESCAPES = (*ESCAPES, (":", "\\c"))
TRAINED_ROLE = "assistant"


def escape(c: Column, pairs=ESCAPES) -> Column:
    """Without ``#`` and ``<`` no control string can occur; each backslash of
    the result is followed by the letter that tells what it stands for."""
    for plain, coded in pairs:
        c = F.replace(c, F.lit(plain), F.lit(coded))
    return c


def unescape(c: Column, pairs=ESCAPES) -> Column:
    for plain, coded in reversed(pairs):
        c = F.replace(c, F.lit(coded), F.lit(plain))
    return c


def header(role: Column) -> Column:
    return F.concat(F.lit(OPEN), escape(role, ROLE_ESCAPES), F.lit(COLON))


def read_turn(content: Column) -> tuple[Column, Column]:
    """(role, text) of a formatted turn."""
    inner = F.substr(content, F.lit(len(OPEN) + 1), F.length(content) - len(OPEN) - len(CLOSE))
    role = F.substring_index(inner, COLON, 1)
    return (unescape(role, ROLE_ESCAPES),
            unescape(F.substr(inner, F.length(role) + len(COLON) + 1)))


def _merged(spans: Column) -> Column:
    """Sorted intervals with those that touch joined."""
    def add(done, x):
        last = F.element_at(done, -1)
        joined = F.concat(F.slice(done, F.lit(1), F.size(done) - 1),
                          F.array(F.struct(last["start"].alias("start"), x["end"].alias("end"))))
        return F.when((F.size(done) > 0) & (F.get(done, F.size(done) - 1)["end"] == x["start"]), joined).otherwise(
            F.concat(done, F.array(x)))
    return F.aggregate(spans, F.slice(spans, 1, 0), add)


def format_chats(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(nodes, members).

    nodes: tree_id, node_id, parent_id, depth, content, start, end (places in
    the tree's packed sequence), position (of the first character), attention
    (array of {start, end}), loss_start, loss_end (null unless the role is
    assistant). members: conv_id, turn (1, 2, ... in the order of the turns),
    node_id, one row per row of ``conversations``.

    Null texts and roles count as empty. Turns of a conversation are ordered
    by turn number, then role, then text, nulls first; repeated rows are turns
    like any other. Rows without a conversation id form one conversation with
    a null id. Other columns are not read. No rows give no nodes.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    turns = conversations.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    body = escape(F.col("text"))
    turns = turns.withColumn("idx", F.row_number().over(order))
    by_idx = Window.partitionBy("conv_id").orderBy("idx")
    upto = by_idx.rowsBetween(Window.unboundedPreceding, 0)
    exact = lambda h: F.sum(h.cast("decimal(20,0)")).over(upto)
    turns = (turns
             .withColumn("a", exact(F.xxhash64("idx", "role", "text")))
             .withColumn("b", exact(F.xxhash64(F.lit("second"), F.col("text"), F.col("role"), F.col("idx"))))
             .withColumn("node_id", F.md5(F.concat_ws(":", "idx", "a", "b")))
             .withColumn("content", F.concat(header(F.col("role")), body, F.lit(CLOSE)))
             .withColumn("len", F.length("content").cast("long"))
             .withColumn("head_len", F.length(header(F.col("role"))).cast("long"))
             .select("conv_id", "idx", "node_id", F.lag("node_id").over(by_idx).alias("parent_id"),
                     F.first("node_id").over(upto).alias("tree_id"), "content", "len",
                     F.when(F.col("role") == TRAINED_ROLE, F.col("head_len")).alias("head_len"),
                     (F.sum("len").over(upto) - F.col("len")).alias("position")))
    turns = saved(turns, "chat-turns")
    nodes = turns.drop("conv_id").dropDuplicates(["node_id"])

    # segments: a node starts one if it is a root or its parent branches
    branches = (turns.where(F.col("parent_id").isNotNull()).select("parent_id", "node_id").distinct()
                .groupBy("parent_id").count().where("count > 1").select("parent_id", F.lit(True).alias("branch")))
    heads = (nodes.select("node_id", "parent_id").join(branches, "parent_id", "left")
             .select("node_id", (F.col("parent_id").isNull() | F.col("branch").isNotNull()).alias("head")))
    head = F.when(F.col("head"), F.col("node_id"))
    placed = (turns.select("conv_id", "idx", "node_id", "tree_id", "len", "position").join(heads, "node_id")
              .select("node_id", "tree_id", "len", "position",
                      F.collect_list(head).over(upto).alias("path"),
                      F.last(F.when(F.col("head"), F.col("position")), ignorenulls=True).over(upto).alias("from"))
              .withColumn("segment", F.element_at("path", -1))
              .withColumn("inside", F.col("position") - F.col("from"))
              .dropDuplicates(["node_id"]))
    placed = saved(placed, "chat-placed")
    segments = placed.groupBy("segment").agg(F.first("tree_id").alias("tree_id"), F.first("path").alias("path"),
                                             F.max(F.col("inside") + F.col("len")).alias("len"))

    # depth-first places: paths sort a parent before its children
    ranged = saved(segments.repartitionByRange("tree_id", "path").withColumn("part", F.spark_partition_id()),
                   "chat-segments")
    before = (Window.unboundedPreceding, -1)
    running = lambda w: F.coalesce(F.sum("len").over(w.rowsBetween(*before)), F.lit(0))
    parts = (ranged.groupBy("tree_id", "part").agg(F.sum("len").alias("len"))
             .withColumn("off", running(Window.partitionBy("tree_id").orderBy("part"))).drop("len"))
    starts = (ranged.join(parts, ["tree_id", "part"])
              .withColumn("start", running(Window.partitionBy("tree_id", "part").orderBy("path")) + F.col("off"))
              .select("segment", "path", "start", (F.col("start") + F.col("len")).alias("end")))
    starts = saved(starts, "chat-starts")
    above = (starts.select(F.col("segment").alias("of"), F.posexplode("path").alias("depth", "segment"))
             .join(starts.select("segment", "start", "end"), "segment")
             .groupBy("of").agg(F.sort_array(F.collect_list(F.struct("depth", "start", "end"))).alias("spans"))
             .select(F.col("of").alias("segment"), "spans"))
    where = (placed.select("node_id", "segment", "inside").join(above, "segment")
             .withColumn("segment_start", F.element_at("spans", -1)["start"])
             .withColumn("start", F.col("segment_start") + F.col("inside"))
             .select("node_id", "start", "segment_start",
                     F.transform(F.slice("spans", F.lit(1), F.size("spans") - 1),
                                 lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias("above")))
    end = F.col("start") + F.col("len")
    own = F.struct(F.col("segment_start").alias("start"), end.alias("end"))
    nodes = nodes.join(where, "node_id").select(
        "tree_id", "node_id", "parent_id", F.col("idx").alias("depth"), "content", "start", end.alias("end"),
        "position", _merged(F.concat(F.col("above"), F.array(own))).alias("attention"),
        (F.col("start") + F.col("head_len")).alias("loss_start"),
        F.when(F.col("head_len").isNotNull(), end - len(CLOSE)).alias("loss_end"))
    return nodes, turns.select("conv_id", F.col("idx").alias("turn"), "node_id")
