from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallyhawk.llm.mixing import mix, with_copies

SCHEMA = "doc_id long, text string, source string, size string, copies int"


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Cut and share anew until none is above its cap."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    cut, left = {}, share * sum(sizes.values())
    while True:
        open_ = [s for s in order if s not in cut]
        level = left / max(1, sum(weight[s] for s in open_))
        over = [s for s in open_ if weight[s] * level >= most * sizes[s]]
        if not over:
            return {**cut, **{s: weight[s] * level for s in open_}}
        for s in over:
            cut[s] = most * sizes[s]
            left -= cut[s]


def test_targets_and_copies(spark):
    rows = [(i, "w " * (1 + i * 7 % 50), "abcde"[i % 5] if i % 3 else "a") for i in range(600)]
    rows += [(1000 + i, "x y z", None) for i in range(40)]
    docs = spark.createDataFrame([(*r, "s", 1) for r in rows], SCHEMA)
    out, c = with_copies(docs)
    got = out.collect()
    assert out.columns[:5] == docs.columns
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        n = len((r["text"] or "").split())
        assert r[c["size"]] == n and 0 <= r[c["copies"]] <= 2
        sizes[r["source"]] += n
        taken[r["source"]] += n * r[c["copies"]]
        target[r["source"]] = r[c["target"]]
    want = targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - target[s]) <= 51  # about one longest document
    again, c2 = with_copies(docs.repartition(7, "text"))
    assert sorted((r["doc_id"], r[c2["copies"]]) for r in again.collect()) == sorted((r["doc_id"], r[c["copies"]]) for r in got)
    assert mix(docs).count() == sum(r[c["copies"]] for r in got)
    assert mix(docs).columns == docs.columns


def test_odd_rows(spark):
    odd = [(None, None, None, None, None), (1, "", "a", "x", 1), (1, "", "a", "x", 1), (2, "\u00a0 \t\n", "b", None, 2),
           (3, "one two\x0bthree", "b", None, 2), (4, "w " * 200_000, "c", None, 3)]
    out, c = with_copies(spark.createDataFrame(odd, SCHEMA))
    sizes = {(r["doc_id"], r[c["size"]]) for r in out.collect()}
    assert out.count() == 6 and sizes == {(None, 0), (1, 0), (2, 1), (3, 3), (4, 200_000)}
    empty = spark.createDataFrame([], SCHEMA)
    assert with_copies(empty)[0].count() == 0 and mix(empty).columns == empty.columns
    zero, c = with_copies(spark.createDataFrame([(1, None, "a", None, 1)], SCHEMA))
    assert zero.select(F.col(c["copies"]), F.col(c["target"])).first() == (0, 0.0)
