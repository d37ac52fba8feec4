import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhawk.llm import anchors, suffixes

SCHEMA = "doc_id long, text string, ord int, data string, size int"


def plain(rows, length):
    """{(id, bytes): covered bytes as a mask}: every window looked up in all earlier ones."""
    seen, out = set(), []
    for i, t in rows:
        b = (t or "").encode()
        mask = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if b[p:p + length] in seen:
                mask[p:p + length] = b"\1" * length
            seen.add(b[p:p + length])
        out.append((i, bytes(x for x, m in zip(b, mask, strict=True) if not m), len(b)))
    return out


def texts(seed):
    rng = random.Random(seed)
    words = ["the", "of", "été", "and", "stone", "river", "b" * 7, "日本"]
    say = lambda n: " ".join(rng.choice(words) + str(rng.randrange(30)) for _ in range(n))
    shared = [say(40), say(14), say(25)]
    out = [say(60), "la " * 200, say(3), "", None, "x" * 99, "x" * 100, "x" * 350]
    for _ in range(60):
        out.append(" ".join([say(rng.randrange(12)), rng.choice(shared), say(rng.randrange(12)), rng.choice(shared)[rng.randrange(60):]]))
    copy = say(120)
    out += [copy, copy, copy[:300] + "!" + copy[300:], copy[7:], copy]
    return [(i * 7 % 1000, t) for i, t in enumerate(out)]


@pytest.mark.parametrize("bucket, often", [(8192, 0.01), (2, 0.01), (8192, 0.0)])
def test_as_brute_force(spark, monkeypatch, bucket, often):
    """Suffix arrays, buckets dealt out, and frequent anchors dealt out."""
    monkeypatch.setattr(suffixes, "FREQUENT", often)
    rows = texts(1)
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(5)
    out, c = suffixes.remove_repeats(docs, bucket=bucket)
    got = {r["doc_id"]: (bytes(r[c["kept"]]), r[c["n_bytes"]], r[c["removed"]]) for r in out.collect()}
    for i, kept, n in plain(sorted(rows), 100):
        assert got[i][:2] == (kept, n)
        spans = got[i][2]
        assert n - len(kept) == sum(s["end"] - s["start"] for s in spans)
        assert all(a["end"] < b["start"] for a, b in zip(spans, spans[1:], strict=False))


def test_small_pieces(spark, monkeypatch):
    """Texts longer than a chunk, pieces of few texts, arrays of few strings."""
    monkeypatch.setattr(anchors, "CHUNK", 150)
    monkeypatch.setattr(suffixes, "PIECE_BYTES", 500)
    monkeypatch.setattr(suffixes, "ARRAY_BYTES", 300)
    rows = [(i, t) for i, (_, t) in enumerate(texts(2))]
    out, c = suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r["doc_id"]: bytes(r[c["kept"]]) for r in out.collect()}
    assert got == {i: kept for i, kept, _ in plain(rows, 100)}


def test_repeated_and_null_ids(spark):
    a, b = "p" * 60 + "q" * 80, "r" * 50 + "p" * 60 + "q" * 80
    rows = [(None, a), (2, b), (2, a), (1, "s" * 20), (2, b)]
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    out = suffixes.without_repeats(docs)
    assert out.columns == docs.columns and out.count() == 5
    got = sorted((r["doc_id"] or 99, r["text"]) for r in out.collect())
    assert got[0] == (1, "s" * 20) and got[-1] == (99, "")  # the null id comes last
    assert [x for x in got if x[0] == 2][:1] == [(2, "")]
    empty = spark.createDataFrame([], SCHEMA)
    assert suffixes.without_repeats(empty).count() == 0


def test_whole_characters(spark):
    """The last byte of the first character is part of the repeat, the character stays."""
    tail = "\u00e9" * 80
    rows = [(1, "\u00e9" + tail), (2, "\u0129" + tail)]  # both first characters end in the same byte
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out, c = suffixes.remove_repeats(docs)
    assert {r["doc_id"]: bytes(r[c["kept"]]) for r in out.collect()}[2] == b"\xc4"
    assert {r["doc_id"]: r["text"] for r in suffixes.without_repeats(docs).collect()}[2] == "\u0129"


def test_maximal_repeats():
    rng = random.Random(5)
    for _ in range(200):
        length = 6
        strings = [bytes(rng.choice(b"ab\0") for _ in range(rng.randrange(6, 15))) for _ in range(rng.randrange(2, 6))]
        covered, want, seen = set(), set(), set()
        for size, who, offset in suffixes.maximal_repeats(strings, np.array([len(s) - length + 1 for s in strings]), length):
            spots = sorted(zip(who.tolist(), offset.tolist(), strict=True))
            same = {strings[w][o:o + size] for w, o in spots}
            assert len(same) == 1 and len(spots) > 1 and len(next(iter(same))) == size
            lefts = {strings[w][o - 1] if o else -1 - w for w, o in spots}
            assert len(lefts) > 1  # the members differ to the left
            for w, o in spots[1:]:
                covered |= {(w, o + i) for i in range(size)}
        for w, s in enumerate(strings):
            for o in range(len(s) - length + 1):
                if s[o:o + length] in seen:
                    want |= {(w, o + i) for i in range(length)}
                seen.add(s[o:o + length])
        assert covered == want


def test_groups_hold_all_occurrences(spark):
    rng = random.Random(6)
    core = "".join(rng.choice("abcdefgh") for _ in range(160))
    rows = [(i, f"{i} {'xyz'[i % 3]}{core}{'uvw'[i % 3]} {i * 17}") for i in range(9)]
    docs = spark.createDataFrame(rows, "ord long, t string").select("ord", F.col("t").cast("binary").alias("data"))
    _, groups = suffixes.repeats(docs)
    assert any({o["ord"] for o in r["occurrences"]} == set(range(9)) for r in groups.collect())
