from pyspark.sql import functions as F

from tallyhawk.llm.chat import escape, format_chats, read_turn, unescape

SCHEMA = "conv_id long, turn long, role string, text string, start string, node_id int"
CHATS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (1, 2, "user", "bye"),
    (2, 0, "user", "hi"), (2, 1, "assistant", "hello"), (2, 2, "user", "more"), (2, 3, "assistant", "sure"),
    (3, 0, "user", "hi"), (3, 1, "assistant", "what?"),
    (4, 0, "user", "hi"), (4, 1, "assistant", "hello"),
    (5, 7, "system", "### x: </turn>\n\\h<"), (5, 9, "a:b", "\\\\l \u00e9\U0001f600"), (5, 9, "a:b", None),
    (6, None, None, None), (None, 1, "user", "lost"), (None, 2, "user", "found"),
]


def test_escapes_are_reversible(spark):
    texts = ["", "\\", "\\h", "\\\\h", "#<\\b\\l", "### a: </turn>\n", "\\bh:\\c", "plain"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", escape(F.col("t")).alias("e"), unescape(escape(F.col("t"))).alias("u")).collect():
        assert r["u"] == r["t"] and "#" not in r["e"] and "<" not in r["e"]


def check(spark, chats):
    df = spark.createDataFrame([(*c, "x", 1) for c in chats], SCHEMA)
    nodes, members = format_chats(df)
    role, text = read_turn(F.col("content"))
    nodes = {r["node_id"]: r for r in nodes.withColumn("role", role).withColumn("text", text).collect()}
    assert members.count() == len(chats)
    packed = {}
    for n in nodes.values():
        packed.setdefault(n["tree_id"], {})[n["start"]] = n
    for tree, parts in packed.items():  # no gaps, no overlap
        at = 0
        for start in sorted(parts):
            assert start == at
            at = parts[start]["end"]
        packed[tree] = "".join(parts[s]["content"] for s in sorted(parts))
    convs = {}
    for m in members.collect():
        convs.setdefault(m["conv_id"], []).append((m["turn"], nodes[m["node_id"]]))
    key = lambda c: (c[1] is not None, c[1] or 0, c[2] or "", c[3] or "")
    for conv, path in convs.items():
        path = [n for _, n in sorted(path, key=lambda x: x[0])]
        want = [(c[2] or "", c[3] or "") for c in sorted((c for c in chats if c[0] == conv), key=key)]
        assert [(n["role"], n["text"]) for n in path] == want
        for i, n in enumerate(path):
            seen = "".join(packed[n["tree_id"]][s["start"]:s["end"]] for s in n["attention"])
            assert seen == "".join(p["content"] for p in path[:i + 1])  # its ancestors and itself, nothing else
            assert n["position"] == sum(len(p["content"]) for p in path[:i]) and n["depth"] == i + 1
            assert n["parent_id"] == (path[i - 1]["node_id"] if i else None)
            if n["role"] == "assistant":
                body = packed[n["tree_id"]][n["loss_start"]:n["loss_end"]]
                assert n["content"] == f"### assistant: {body}</turn>\n"
            else:
                assert n["loss_start"] is None and n["loss_end"] is None
    return nodes


def test_tree(spark):
    nodes = check(spark, CHATS)
    assert len(nodes) == len({(n["tree_id"], n["depth"], n["content"], n["parent_id"]) for n in nodes.values()})
    assert sum(n["text"] == "hi" for n in nodes.values()) == 1  # shared turns once


def test_many_branches(spark):
    chats = [(c, t, "user" if t % 2 == 0 else "assistant", f"t{(c // 3 ** (4 - t)) if t else 0}") for c in range(81) for t in range(5)]
    check(spark, chats)


def test_empty(spark):
    nodes, members = format_chats(spark.createDataFrame([], SCHEMA))
    assert nodes.count() == members.count() == 0


def test_digests_of_long_conversations():
    """Turns are hashed as they come; a conversation may span batches, and its id may be null."""
    import hashlib

    import pyarrow as pa

    from tallyhawk.llm.queries import chat_digests
    rows = [(None, i, f"né{i}\n", "", 3) for i in range(3)] + [(1, i, f"t{i}\n", f"é{i}", 5) for i in range(7)] + [(2, 1, "x", "y", 1)]
    names = ["conv_id", "turn", "said", "loss", "len"]
    table = pa.Table.from_pylist([dict(zip(names, r, strict=True)) for r in rows])
    got = [tuple(r.values()) for b in chat_digests(iter(table.to_batches(max_chunksize=2))) for r in b.to_pylist()]
    want = []
    for conv in (None, 1, 2):
        own = [r for r in rows if r[0] == conv]
        digest = lambda i, own=own: hashlib.sha256("".join(r[i] for r in own).encode()).hexdigest()
        want.append((conv, len(own), digest(2), sum(len(r[3]) for r in own), digest(3), sum(r[4] for r in own)))
    assert got == want and list(chat_digests(iter([]))) == []
