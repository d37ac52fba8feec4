"""Hand cases of the money model and ranking metrics, plus one-pass curves
against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhawk.operators import metrics as M


def _df(spark, rows):
    return spark.createDataFrame(rows, "y int, score double, amount double")


@pytest.fixture
def four(spark):
    return _df(spark, [(1, .9, 100.0), (1, .1, 500.0), (0, .8, 300.0), (0, .2, 50.0)])


def test_cost_hand_case(four):
    r = M.cost(four, 0.5, fp_unit_cost=25).first()
    assert r["fn_cost"] == 500 and r["fp_cost"] == 25 and r["total_cost"] == 525
    assert r["cost_per_million"] == pytest.approx(131_250_000)
    t = M.threshold_metrics(four, 0.5).first()
    assert (t["tp"], t["fp"], t["fn"], t["tn"]) == (1, 1, 1, 1)


def test_cost_fraction_and_fixed(four):
    assert M.cost(four, 0.5, fn_loss_fraction=0.02).first()["fn_cost"] == pytest.approx(10)
    assert M.cost(four, 0.5, fn_fixed_cost=15).first()["fn_cost"] == pytest.approx(515)


def test_cost_nan_amount_is_finite(spark):
    df = _df(spark, [(1, .1, float("nan")), (0, .9, 100.0)])
    assert math.isfinite(M.cost(df, 0.5).first()["total_cost"])


def test_auroc_direction_and_one_class(spark):
    up = _df(spark, [(0, .1, 1.0), (0, .2, 1.0), (1, .3, 1.0), (1, .4, 1.0)])
    down = _df(spark, [(0, .4, 1.0), (0, .3, 1.0), (1, .2, 1.0), (1, .1, 1.0)])
    one = _df(spark, [(0, .1, 1.0), (0, .2, 1.0), (0, .3, 1.0)])
    assert M.ranking_metrics(up).first()["AUROC"] == pytest.approx(1.0)
    assert M.ranking_metrics(down).first()["AUROC"] == pytest.approx(0.0)
    assert M.ranking_metrics(one).first()["AUROC"] is None


def _brute(y, s):
    from itertools import product
    pos = [b for a, b in zip(y, s) if a == 1]
    neg = [b for a, b in zip(y, s) if a == 0]
    auc = sum((p > n) + 0.5 * (p == n) for p, n in product(pos, neg)) / (len(pos) * len(neg))
    order = sorted(set(s), reverse=True)
    ap, P = 0.0, len(pos)
    for t in order:
        tp = sum(1 for a, b in zip(y, s) if b >= t and a == 1)
        fp = sum(1 for a, b in zip(y, s) if b >= t and a == 0)
        newpos = sum(1 for a, b in zip(y, s) if b == t and a == 1)
        ap += newpos / P * tp / (tp + fp)
    return auc, ap


def test_ranking_matches_brute_force_with_ties(spark):
    rng = np.random.default_rng(7)
    y = rng.integers(0, 2, 400).tolist()
    s = (rng.integers(0, 40, 400) / 40).tolist()
    df = _df(spark, [(a, b, 1.0) for a, b in zip(y, s)])
    r = M.ranking_metrics(df).first()
    auc, ap = _brute(y, s)
    assert r["AUROC"] == pytest.approx(auc, abs=1e-12)
    assert r["PR_AUC"] == pytest.approx(ap, abs=1e-12)


def test_curve_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    n = 3000
    y = rng.integers(0, 2, n)
    s = rng.integers(0, 1001, n) / 1000
    a = np.round(rng.uniform(1, 500, n), 2)
    df = _df(spark, [(int(p), float(q), float(r)) for p, q, r in zip(y, s, a)])
    curve = {round(r["threshold"], 2): r["total_cost"] for r in M.threshold_curve(df).collect()}
    for i in range(1, 100):
        t = i / 100.0
        pred = s >= t
        cost = a[(y == 1) & ~pred].sum() + 25.0 * ((y == 0) & pred).sum()
        assert curve[round(t, 2)] == pytest.approx(cost, abs=1e-6)
    best = M.best_threshold(M.threshold_curve(df)).first()
    brute = min(((curve[round(i / 100, 2)], i / 100) for i in range(1, 100)))
    assert best["threshold"] == pytest.approx(brute[1])


def test_best_threshold_on_scored_fixture(spark):
    from tests.conftest import SF_MID
    from tallyhawk.sources.fixtures import scored
    b = M.best_threshold(M.threshold_curve(scored(spark, SF_MID))).first()
    assert b["threshold"] == pytest.approx(0.75)
    assert b["total_cost"] == pytest.approx(69681.78, abs=0.01)


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(11)
    v = np.round(rng.normal(size=1001), 3)
    df = spark.createDataFrame([(float(x),) for x in v], "x double")
    qs = [0.1, 0.25, 0.5, 0.9]
    got = {r["q"]: r["value"] for r in M.exact_quantiles(df, "x", qs).collect()}
    for q in qs:
        assert got[q] == pytest.approx(float(np.percentile(v, q * 100)), abs=1e-12)


def test_band_distribution_keeps_empty_bands(spark):
    df = _df(spark, [(1, .9, 1.0), (0, .1, 1.0)])
    rows = {r["band"]: r for r in M.band_distribution(df).collect()}
    assert rows["High"]["count"] == 0 and rows["High"]["fraud_rate_pct"] is None
    assert rows["Critical"]["fraud_caught"] == 1


def test_segment_min_n(spark):
    rows = [(i % 2, (i % 10) / 10, 1.0, "a" if i < 40 else "b") for i in range(50)]
    df = spark.createDataFrame(rows, "y int, score double, amount double, segment string")
    segs = {r["segment"] for r in M.segment_metrics(df, 0.5, min_n=30).collect()}
    assert segs == {"a"}
