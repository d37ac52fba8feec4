import random
import re

import numpy as np
import pytest
import xxhash

from tallyhawk.llm.components import connected_components
from tallyhawk.llm.simhash import fingerprint, links, one_per_group, segment_counts, simhash_groups

SCHEMA = "doc_id long, text string, fp string, component int, id string"


def plain(text):
    """The fingerprint, word by word and bit by bit."""
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def components(items):
    """{item number: smallest number reachable at 2 bits or fewer}."""
    up = list(range(len(items)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    a = np.array(items, np.uint64)
    for i in range(len(a)):
        for j in np.nonzero(np.bitwise_count(a[i:] ^ a[i]) <= 2)[0] + i:
            x, y = sorted((find(i), find(int(j))))
            up[y] = x
    return [find(i) for i in range(len(items))]


def near(rng, centres=25, each=40, flips=6):
    out = {0, (1 << 64) - 1, 1, 3, 7}
    for _ in range(centres):
        base = rng.getrandbits(64)
        for _ in range(each):
            x = base
            for _ in range(rng.randrange(flips)):
                x ^= 1 << rng.randrange(64)
            out.add(x)
    return sorted(out)


def test_fingerprints():
    rng = random.Random(1)
    texts = ["", " \t", "one", "Two WORDS", "a b c", "Ä ä x y", "A b c d", "x " * 5000, "z\x0bz\x0cz\x1cz"]
    texts += [" ".join(rng.choice("ab cd ef Gh".split()) for _ in range(rng.randrange(60))) for _ in range(50)]
    for t in texts:
        assert fingerprint(t.encode()) == plain(t)
    assert fingerprint(b"") == 0


def test_segment_counts(spark):
    rng = random.Random(2)
    items = [0, 1, (1 << 64) - 1, 1 << 63] + [rng.getrandbits(64) for _ in range(100)]
    df = spark.createDataFrame([(signed(x),) for x in items], "fp long")
    for x, (got,) in zip(items, df.select(segment_counts(df["fp"])).collect(), strict=True):
        assert got == sum((x >> 4 * s & 15).bit_count() << 4 * s for s in range(16))


@pytest.mark.parametrize("seed", [3, 4])
def test_links_give_all_components(spark, seed):
    items = near(random.Random(seed))
    star = links(spark.createDataFrame([(signed(x),) for x in items], "fp long"))
    for r in star.collect():
        assert ((r["u"] ^ r["v"]) & ((1 << 64) - 1)).bit_count() <= 2
    got = {r["node"]: r["component"] for r in connected_components(star).collect()}
    of = components(items)
    mine = [got.get(signed(x), signed(x)) for x in items]
    assert len(set(zip(of, mine, strict=True))) == len(set(of)) == len(set(mine))


def test_components(spark):
    rng = random.Random(5)
    chain = [(i, i + 1) for i in range(100, 400)]
    hub = [(7, i) for i in range(1000, 1500)]
    other = [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(200)]
    edges = chain + hub + other + [(5, 5), (None, 3), (4, None)] + chain[:20]
    rng.shuffle(edges)
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    up = {}
    find = lambda x: x if up.get(x, x) == x else find(up[x])
    for u, v in chain + hub + other:
        a, b = sorted((find(u), find(v)))
        if a != b:
            up[b] = a
    nodes = {x for u, v in chain[::-1] + hub + other if u != v for x in (u, v)}
    import sys
    sys.setrecursionlimit(5000)
    assert got == {x: find(x) for x in nodes}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_groups_of_documents(spark):
    long = " ".join(f"w{i % 997}" for i in range(30_000))
    rows = [(5, "same text here now"), (3, "same  TEXT here now"), (9, None), (8, ""), (7, " \n"), (None, "same text here now"),
            (None, "alone among the words"), (12, long), (11, long + " w0"), (3, "same  TEXT here now"), (20, "quite another text")]
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    got = {(r["id"], r["fp"]): r["component"] for r in simhash_groups(docs).collect()}
    fp = lambda t: signed(plain(t))
    assert got[5, fp(rows[0][1])] == got[3, fp(rows[0][1])] == got[None, fp(rows[0][1])] == 3
    assert got[9, 0] == got[8, 0] == got[7, 0] == 7
    assert got[12, fp(long)] == got[11, fp(rows[8][1])] == 11
    assert got[None, fp("alone among the words")] is None
    kept = one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or -1, r["text"] or "") for r in kept.collect()) == sorted([
        (3, "same  TEXT here now"), (7, " \n"), (11, long + " w0"), (20, "quite another text"), (-1, "alone among the words")])
    twice = spark.createDataFrame([(4, "one text that is here"), (4, "one text that is here"), (4, "a wholly different text"),
                                   (None, "one text that is here")], "doc_id long, text string")
    assert sorted(r["text"] for r in one_per_group(twice).collect()) == ["a wholly different text", "one text that is here"]
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash_groups(empty).count() == 0 and one_per_group(empty).count() == 0


def test_links_through_rows_without_an_id(spark, monkeypatch):
    """0 and 15 differ in four bits; only the fingerprint between them, of a row without an id, links them."""
    from tallyhawk.llm import simhash
    rows = [(1, 0), (9, 15), (None, 3), (None, 0x7FFF << 40)]
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, *_: docs)
    docs = spark.createDataFrame(rows, "id long, fp long")
    got = {(r["id"], r["fp"]): r["component"] for r in simhash_groups(docs).collect()}
    assert got == {(1, 0): 1, (9, 15): 1, (None, 3): 1, (None, 0x7FFF << 40): None}
