import numpy as np
import pytest

from tallyhawk.llm import whitening
from tallyhawk.llm.catalog import QUERIES, load_all
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<float>, id string, dim int, n int"


def spread(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    m = (q * values) @ q.T
    return (m + m.T) / 2


@pytest.mark.parametrize("n", [1, 2, 7, 40])
def test_inertia(n):
    rng = np.random.default_rng(n)
    for _ in range(20):
        m = rng.standard_normal((n, n))
        m = m + m.T
        if rng.random() < 0.5:
            np.fill_diagonal(m, 0)  # asks for pivots of two rows
        own = np.sort(np.linalg.eigvalsh(m))
        for shift in [*((own[1:] + own[:-1]) / 2), own[0] - 1, own[-1] + 1, 0.0]:
            assert whitening.above(m, shift) == (own > shift).sum()


@pytest.mark.parametrize("values", [
    np.linspace(1, 9, 30), 2.0 ** -np.arange(30), np.r_[5.0, 5.0, 5.0, 1.0, 1.0, 0.5], np.ones(12),
    np.r_[1.0, 1 - 1e-9, 1 - 2e-9, 0.3, 0.1], np.r_[3.0, 2.0, np.zeros(10)], np.r_[1e12, 1.0, 1e-3], np.r_[4e-9, 1e-9]])
def test_leading(values):
    values = np.sort(values)[::-1]
    m = spread(values)
    got, vectors = whitening.leading(m, 8)
    k = min(8, (values > values[0] * 1e-13).sum())
    assert len(got) == k and np.abs(got - values[:k]).max() < 1e-12 * values[0]
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-9
    assert np.abs(m @ vectors - vectors * got).max() < 1e-12 * values[0]


def test_no_variance():
    assert whitening.leading(np.zeros((5, 5)), 3)[0].size == 0


def plain(rows, k):
    """{id: (n, deviation, whitened up to sign, explained)} by numpy and whole numbers."""
    x = [[int(np.floor(64 * np.float64(np.float32(c)))) + 1_000_000 for c in v] for _, v in rows]
    n, dim = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(dim)]
    dev = [sum((n * r[j] - sums[j]) ** 2 for j in range(dim)) for r in x]
    y = np.array([[(n * r[j] - sums[j]) / n for j in range(dim)] for r in x])
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    white = (y @ vectors)[:, :k] / np.sqrt(values[:k])
    return n, dev, white, values[:k] / values.sum()


def compare(got, rows, k):
    n, dev, white, explained = plain(rows, k)
    by = {}
    for r in got:
        by.setdefault(r.get("vec_id", r.get("id")), {})[r["component"]] = r
    assert len(got) == n * k
    mine = np.array([[by[i][c]["whitened"] for c in range(1, k + 1)] for i, _ in rows])
    sign = np.sign((mine * white).sum(axis=0))
    assert np.abs(mine - white * sign).max() < 1e-6
    for (i, _), d in zip(rows, dev, strict=True):
        for c in range(1, k + 1):
            r = by[i][c]
            assert (r["n"], int(r["deviation"])) == (n, d)
            assert abs(r["explained"] / explained[c - 1] - 1) < 1e-9
            assert r["identity_error"] < 1e-9


@pytest.mark.parametrize("scale", [0.3, 1e4, 1e9])
def test_as_brute_force(spark, scale):
    rng = np.random.default_rng(3)
    rows = [(i, (scale * v).astype(np.float32).tolist()) for i, v in enumerate(rng.standard_normal((300, 10)) * np.arange(1, 11))]
    odd = [(901, None), (902, [1.0, None, *[0.0] * 8]), (903, [float("nan"), *[0.0] * 9]), (904, [float("inf"), *[0.0] * 9]), (905, [])]
    docs = spark.createDataFrame([(*r, "x", 1, 2) for r in rows + odd], SCHEMA).repartition(4)
    got = whitening.whiten(docs, components=6).collect()
    compare([r.asDict() for r in got], rows, 6)


def test_query_as_brute_force(spark):
    load_all()
    sf_dir = SF_SMALL
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    compare([r.asDict() for r in QUERIES["op13_whitening"](spark, sf_dir).collect()], rows, 32)


def test_odd_tables(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    same = [(i % 2 or None, [1.0, 2.0], "x", 1, 2) for i in range(5)]
    assert whitening.whiten(spark.createDataFrame(same, SCHEMA)).count() == 0
    two = [(None, [0.0, 0.0], "x", 1, 2), (None, [1.0, 0.0], "x", 1, 2), (3, [7.0], "x", 1, 2), (3, [9.0], "x", 1, 2)]
    out = whitening.whiten(spark.createDataFrame(two, SCHEMA)).collect()
    assert sorted((r["id"] or 0, r["component"], abs(round(r["whitened"], 9)), r["n"]) for r in out) == [(0, 1, 1.0, 2)] * 2 + [(3, 1, 1.0, 2)] * 2
    with pytest.raises(Exception, match="does not fit a long"):
        whitening.whiten(spark.createDataFrame([(1, [1e30], "x", 1, 2)], SCHEMA)).count()
