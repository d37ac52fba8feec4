import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallyhawk.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, name int, pos string"


def ordered(rows):
    """{conversation: [(role, text)]} in the order of the turns."""
    digest = lambda r, t: hashlib.md5(f"{len(r.encode())}:{r}{t}".encode()).digest()
    by = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            by[c].append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    return {c: [x[3:] for x in sorted(v)] for c, v in by.items()}


def plain(convs):
    """The nodes of a dictionary of sequences, by looking at every prefix."""
    members, below = defaultdict(list), defaultdict(set)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                below[tuple(turns[:d - 1])].add(tuple(turns[:d]))
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in below
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(below.get(p, ())), leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p)).encode()).hexdigest())
                  for p, m in members.items())


def collected(df):
    return sorted(tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                              "saved_tokens", "ends_sha256").collect())


def chats(seed, n=60, most=9):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randrange(1, most)):
            rows.append((c * 3 - 20, t if rng.random() < 0.9 else rng.choice([None, 0, 2]),
                         rng.choice(["user", "assistant", None]), rng.choice(["yes", "no", "", None, "né"])))
    return rows + rng.sample(rows, 10)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(4)


def build(spark, rows):
    turns = trie.turns_of(frame(spark, rows))
    return collected(trie.prefix_trie(turns, turns.select("conv").distinct()))


@pytest.mark.parametrize("seed", [1, 2])
def test_as_brute_force(spark, seed):
    rows = chats(seed) + [(None, 1, "user", "left out")]
    assert build(spark, rows) == plain(ordered(rows))


def test_rebuilt_as_brute_force(spark):
    """Conversations begin with the turns of another one; some are left without turns."""
    rows = chats(3, 80, 12)
    convs = ordered(rows)
    head = lambda c: zlib.crc32(str(c).encode()) % 9
    rest = lambda c: c - (c - 5 * int(c / 5))  # noqa: E731  # the remainder has the sign of the id
    want = {c: convs.get(rest(c), [])[:head(c)] + turns[head(c):] for c, turns in convs.items()}
    assert any(not t for t in want.values())
    conv = F.col("conv")
    turns, members = trie.with_heads(trie.turns_of(frame(spark, rows)), conv - conv % 5,
                                     F.crc32(conv.cast("string").cast("binary")) % 9, 8)
    assert collected(trie.prefix_trie(turns, members)) == plain(want)


def test_long_conversations(spark):
    """Depths around powers of two; one conversation is far longer than the rest."""
    say = lambda n, x="a": [("user", f"{x}{i % 7}") for i in range(n)]
    convs = {n: say(n) for n in (1, 2, 3, 4, 7, 8, 9, 15, 16, 17, 31, 33)} | {
        100: say(200), 101: say(200), 102: say(120) + say(60, "b"), 103: say(120) + say(61, "b"), 104: say(16, "c")}
    rows = [(c, t, r, x) for c, turns in convs.items() for t, (r, x) in enumerate(turns)]
    random.Random(0).shuffle(rows)
    assert build(spark, rows) == plain(convs)


def test_many_ends_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK_IDS", 3)
    rows = [(c, 0, "user", "hi") for c in range(-5, 40)] + [(99, 0, "user", "other")]
    assert build(spark, rows) == plain(ordered(rows))


def test_no_rows(spark):
    assert build(spark, []) == []
    turns = trie.turns_of(frame(spark, []))
    members = spark.createDataFrame([(4,), (2,)], "conv long")
    assert collected(trie.prefix_trie(turns, members)) == plain({2: [], 4: []})
