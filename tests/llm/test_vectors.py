import numpy as np
import pytest

from pyspark.sql import functions as F

from tallyhawk.llm import vectors
from tallyhawk.llm.topk import build, search, top_k

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string, id int, cell int"


def clusters(seed, groups=30, each=12, dim=24, spread=0.22):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        centre = rng.normal(size=dim)
        centre /= np.linalg.norm(centre)
        for _ in range(each):
            v = centre + rng.normal(size=dim) * spread / dim ** 0.5 * rng.uniform(0.2, 2)
            rows.append((len(rows) * 3 + 1, (v * rng.uniform(0.5, 3)).astype(np.float32).tolist(), int(g % 4)))
    return rows


def plain_links(rows, threshold=0.93):
    n, up = {}, {i: i for i in range(len(rows))}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    v = [np.array(r[1], float) for r in rows]
    for i in range(len(rows)):
        for j in range(i):
            if rows[i][2] == rows[j][2] and len(v[i]) == len(v[j]) and v[i] @ v[j] / np.sqrt((v[i] @ v[i]) * (v[j] @ v[j])) >= threshold:
                n[i], n[j] = n.get(i, 0) + 1, n.get(j, 0) + 1
                up[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted((r[0], n.get(i, 0), least[find(i)], r[0] == least[find(i)]) for i, r in enumerate(rows))


@pytest.mark.parametrize("cell_rows, block_rows", [(512, 512), (20, 512), (20, 5), (512, 7)])
def test_links(spark, monkeypatch, cell_rows, block_rows):
    """One cell, many cells, and cells of many blocks."""
    monkeypatch.setattr(vectors, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(vectors, "BLOCK_ROWS", block_rows)
    rows = clusters(7)
    rows += [(5000 + i, rows[4][1], rows[4][2]) for i in range(10)]  # exact copies
    got = sorted(tuple(r) for r in vectors.near_duplicates(
        spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)).collect())
    want = plain_links(rows)
    found, there = sum(r[1] for r in got), sum(r[1] for r in want)
    assert there > 300 and [r[0] for r in got] == [r[0] for r in want]
    if cell_rows == 512:
        assert got == want
    else:  # cells are an index: recall is measured, nothing is made up
        assert found >= 0.98 * there and all(g[1] <= w[1] for g, w in zip(got, want, strict=True))


@pytest.mark.parametrize("rank, groups, cell_rows, block_rows", [(4, 1, 20, 512), (4, 1, 20, 7), (3, 12, 30, 512), (2, 4, 20, 9)])
def test_no_link_is_lost(spark, monkeypatch, rank, groups, cell_rows, block_rows):
    """Dense groups spread in few directions and cut into many cells, where
    linked vectors often live in different cells."""
    monkeypatch.setattr(vectors, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(vectors, "BLOCK_ROWS", block_rows)
    rng = np.random.default_rng(11)
    basis = np.linalg.qr(rng.normal(size=(24, rank)))[0]
    rows = []
    for _ in range(groups):
        centre = rng.normal(size=24)
        centre /= np.linalg.norm(centre)
        for _ in range(480 // groups):
            v = centre + basis @ rng.normal(size=rank) * 0.5 / rank ** 0.5
            rows.append((len(rows) + 1, v.astype(np.float32).tolist(), 1))
    got = sorted(tuple(r) for r in vectors.near_duplicates(
        spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)).collect())
    want = plain_links(rows)
    assert sum(r[1] for r in want) > 1000 and got == want


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    a = [1.0, 2.0, 3.0]
    rows = [(9, a, 1), (4, a, 1), (4, a, 1), (6, [2.0, 4.0, 6.0], 1), (1, a, 2), (2, a, None), (3, None, 1), (5, [], 1),
            (7, [0.0, 0.0, 0.0], 1), (8, [1.0, nan, 3.0], 1), (10, [inf, 2.0, 3.0], 1), (11, [1.0, None, 3.0], 1),
            (12, [1.0, 2.0], 1), (None, a, 3), (13, a, 3), (14, [3e38, 3e38, 3e38], 5), (15, [1e-40, 1e-40, 1e-40], 5)]
    got = vectors.near_duplicates(spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)).collect()
    by = {r["id"]: (r["n_links"], r["component"], r["kept"]) for r in got}
    assert len(got) == len(rows)
    assert by[9] == by[6] == (3, 4, False) and by[4] == (3, 4, True)
    for i in (1, 2, 3, 5, 7, 8, 10, 11, 12):
        assert by[i] == (0, i, True)
    assert by[None] == (1, 13, False) and by[13] == (1, 13, True)
    assert by[14] == (1, 14, True) and by[15] == (1, 14, False)
    assert vectors.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def plain_top(rows, k, ask):
    out = []
    v = {i: np.floor(256 * np.array(x, float)) for i, x, _ in rows}
    for q in v:
        if ask(q):
            best = sorted(((-int(v[q] @ v[c]), c) for c in v if c != q and len(v[c]) == len(v[q])))[:k]
            out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("shard_rows, block_rows", [(4096, 2048), (40, 2048), (40, 6)])
def test_top_k(spark, shard_rows, block_rows):
    rows = clusters(8) + [(3000 + i, [0.5] * 24, 0) for i in range(40)]  # ties
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    got = top_k(df, F.col("id") % 5 == 0, shard_rows=shard_rows, block_rows=block_rows)
    assert sorted(tuple(r) for r in got.collect()) == plain_top(rows, 5, lambda q: q % 5 == 0)


def test_top_k_odd(spark):
    a = [1.0, 2.0]
    rows = [(0, a), (1, a), (2, [2.0, 1.0]), (3, None), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [1.0]), (10, [1.0]),
            (None, a), (20, [float("-inf"), 1.0]), (30, []), (40, [1e30, -1e30]), (1, a)]
    df = spark.createDataFrame([(*r, 1, "x", 1, 2) for r in rows], SCHEMA)
    got = top_k(df, F.col("id") % 10 == 0, k=5).collect()
    by = {}
    for r in sorted(got):
        by.setdefault(r["query_id"], []).append(r["id"])
    assert {q: set(c) for q, c in by.items()} == {0: {1, 2, 40}, 10: {6}, 40: {0, 1, 2}}
    assert by[0] == [1, 2, 40] or by[0][0] in (1, 40)
    assert top_k(spark.createDataFrame([], SCHEMA), F.col("id") % 10 == 0).count() == 0


def test_top_k_large_and_repeated(spark):
    """Scores of large components are exact, in doubles, in 64 bits and beyond; repeated ids are all candidates."""
    rows = [(0, [1.0, 0.0]), (1, [200000.0, 0.0]), (2, [400000.0, 0.0]), (3, [1e12, 1.0]), (4, [2e12, 0.5]), (5, [-3e9, 0.0]),
            (5, [0.25, 0.0]), (5, [4.0, 0.0]), (10, [3e15, 0.0]), (10, [1.0, 1.0]), (20, [1e300, 0.0])]
    df = spark.createDataFrame([(i, v, 0, "x", 1, 2) for i, v in rows], SCHEMA.replace("float", "double"))
    got = sorted(tuple(r) for r in top_k(df, F.col("id") % 10 == 0, k=9, shard_rows=3, block_rows=2).collect())
    held = [(i, [min(int(np.floor(256 * x)), 1 << 62) for x in v]) for i, v in rows]
    want = []
    for q in (0, 10, 20):
        found = [(-min(max(sum(a * b for a, b in zip(x, y)), -1 << 63), (1 << 63) - 1), c)
                 for i, x in held if i == q for c, y in held if c != q]
        want += [(q, n + 1, c, -s) for n, (s, c) in enumerate(sorted(found)[:9])]
    assert got == sorted(want)


def test_tree_cuts_off():
    rng = np.random.default_rng(3)
    points = np.floor(rng.normal(size=(2000, 4)) * 256).astype(np.int64)
    tree = build(points, np.arange(2000))
    leaves = tree["left"] < 0
    assert (tree["end"] - tree["start"])[leaves].sum() == 2000 and sorted(tree["ids"].tolist()) == list(range(2000))
    q = points[17]
    bounds = np.maximum(q, 0) @ tree["high"].T + np.minimum(q, 0) @ tree["low"].T
    for n in range(len(bounds)):  # no point of a node scores above the node's bound, and the box is tight
        own = tree["points"][tree["start"][n]:tree["end"][n]]
        assert (own @ q).max() <= bounds[n] and (own.min(axis=0) == tree["low"][n]).all()
    s = points @ q
    best = sorted(((-int(x), i) for i, x in enumerate(s) if i != 17))[:5]
    assert sorted((-int(x), i) for x, i in search(tree, q, 17, 5, float("-inf"), bounds)) == best
