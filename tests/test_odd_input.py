"""Inputs that the fixtures never hold: each is either refused or has one
stated result in every operator."""

import pytest
from pyspark.sql import functions as F

from tallyhawk.operators import labels as L
from tallyhawk.operators import metrics as M
from tallyhawk.operators import prep as PR
from tallyhawk.operators import scoring as SC

FLAGS = "transfer string, action string, flag_ts timestamp, seq long"


@pytest.mark.parametrize("row", [("t1", "hold", "2024-01-01 00:00:00"), (None, "flag", "2024-01-01 00:00:00"), ("t1", "flag", None)])
def test_label_paths_refuse_bad_flags(spark, row):
    flags = spark.createDataFrame([row, ("t2", None, None)], "transfer string, action string, flag_ts string")
    flags = flags.withColumn("flag_ts", F.col("flag_ts").cast("timestamp"))
    with pytest.raises(Exception, match="flag history"):
        L.latest_flag_verdict(flags).collect()
    with pytest.raises(L.FlagHistoryError):
        L.check_flag_history(flags)


def test_good_flags_still_count(spark):
    flags = spark.createDataFrame([("t1", "flag", "2024-01-01 00:00:00"), ("t1", "unflag", "2024-01-02 00:00:00"), ("t2", None, None)],
                                  "transfer string, action string, flag_ts string")
    got = L.latest_flag_verdict(flags.withColumn("flag_ts", F.col("flag_ts").cast("timestamp"))).collect()
    assert [(r["_id"], r["label"]) for r in got] == [("t1", 0)]


def test_unlabelled_encoded_features_are_not_shown(spark):
    df = spark.createDataFrame([("mystery_FE",), ("send_amount_FE",), ("send_amount",), ("V_x",), ("hour",)], "f string")
    got = {r[0]: r[1] for r in df.select("f", SC.is_interpretable(F.col("f"))).collect()}
    assert got == {"mystery_FE": False, "send_amount_FE": True, "send_amount": True, "V_x": False, "hour": True}


def test_nan_is_no_value_and_no_impact(spark):
    df = spark.createDataFrame([(float("nan"), 2.0)], "a double, b double")
    factors = SC.risk_factor_array({"send_amount": F.lit(1.0), "hour": F.col("a")}, {"send_amount": F.col("a"), "hour": F.col("b")})
    row = df.select(factors.alias("f")).first()["f"]
    assert [(x["feature"], x["value"]) for x in row] == [("send_amount", None)]


def test_nan_columns_are_dropped(spark):
    nan = float("nan")
    df = spark.createDataFrame([(nan, 1.0, 1.0, "x"), (nan, nan, 2.0, "y")], "a double, b double, c double, d string")
    kinds = PR.fit(df).kinds
    assert (kinds["a"], kinds["b"], kinds["c"]) == ("dropped", "dropped", "numeric")


SCORED = "k string, y int, score double, amount double"
ROWS = [("a", 1, 0.9, 5.0), ("a", 0, 0.2, 1.0), (None, 1, 0.99, 7.0), (None, 0, 0.1, 1.0), (None, 1, None, 100.0),
        ("a", 0, float("nan"), 50.0)]


def test_rows_without_a_score_count_nowhere(spark):
    df = spark.createDataFrame(ROWS, SCORED)
    curve = {round(r["threshold"], 2): r for r in M.threshold_curve(df).collect()}
    for t in (0.5, 0.99):
        at = M.threshold_metrics(df, t).first()
        got = curve[t]
        assert (at["tp"], at["fp"], at["fn"], at["tn"]) == (got["tp"], got["fp"], got["fn"], got["tn"])
        assert got["tp"] + got["fp"] + got["fn"] + got["tn"] == 4


def test_rows_without_a_score_are_as_dropped(spark):
    """Every output column of every operator, keyed or not."""
    df = spark.createDataFrame(ROWS + [("b", 1, None, 2.0), ("b", 0, float("nan"), 3.0)], SCORED).withColumn("fpc", F.lit(2.0))
    clean = df.where("score is not null and not isnan(score)")
    ops = [lambda d: M.ranking_metrics(d), lambda d: M.threshold_metrics(d, 0.5), lambda d: M.threshold_metrics(d, 0.5, keys=["k"]),
           lambda d: M.cost(d, 0.5), lambda d: M.cost(d, 0.5, fp_unit_cost="fpc", keys=["k"]), lambda d: M.evaluate(d, 0.5, keys=["k"]),
           lambda d: M.segment_metrics(d, 0.5, segment="k", min_n=1), lambda d: M.segment_metrics(d, 0.5, segment="k", min_n=3),
           lambda d: M.threshold_curve(d, keys=["k"]), lambda d: M.cost_grid(d), lambda d: M.reliability_table(d, n_bins=3),
           lambda d: M.band_distribution(d)]
    for op in ops:
        assert sorted(map(repr, op(df).collect())) == sorted(map(repr, op(clean).collect()))


def test_no_score_has_no_band_and_no_text(spark):
    from tallyhawk.functions.columns import risk_band
    df = spark.createDataFrame([(float("nan"),), (None,), (0.9,)], "p double")
    none = F.array(F.struct(F.lit(1).alias("rank"), F.lit("x").alias("label"), F.lit("y").alias("value"), F.lit(0.0).alias("hidden_signal_weight")))
    got = df.select(risk_band("p"), SC.explain_text(F.col("p"), none)).collect()
    assert [tuple(r) for r in got[:2]] == [(None, None)] * 2 and got[2][0] == "Critical" and got[2][1].startswith("Critical risk (90.0%)")


def test_a_null_key_is_a_key(spark):
    df = spark.createDataFrame(ROWS, SCORED)
    assert {r["k"] for r in M.evaluate(df, 0.5, keys=["k"]).collect()} == {"a", None}
    got = {r["k"]: r for r in M.threshold_curve(df, keys=["k"]).where("threshold = 0.5").collect()}
    assert got[None]["tp"] == got["a"]["tp"] == 1 and got[None]["tn"] == 1


@pytest.mark.parametrize("buckets", [1, 7, 40])
def test_ranking_with_many_buckets(spark, buckets):
    rows = [(i % 7 == 0 or i % 11 == 3, round((i * 7919 % 1000) / 999, 3)) for i in range(3000)]
    df = spark.createDataFrame([(int(y), s) for y, s in rows], "y int, score double")
    got = M.ranking_metrics(df, buckets=buckets).first()
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    import numpy as np
    want = np.mean([(np.array(neg) < p).mean() + 0.5 * (np.array(neg) == p).mean() for p in pos])
    assert got["AUROC"] == pytest.approx(want)
    q = {r["q"]: r["value"] for r in M.exact_quantiles(df, "score", [0.0, 0.13, 0.5, 1.0], buckets=buckets).collect()}
    assert q == pytest.approx({x: float(np.quantile([s for _, s in rows], x)) for x in q})


def test_gates_can_fail(spark):
    from tallyhawk.operators import gate as G
    good = spark.createDataFrame([(1.0, 2), (None, 3)], "send_amount double, hour int")
    assert [r["passed"] for r in G.gate_pii_columns(good).collect() + G.gate_forbidden_columns(good).collect()] == [True, True]
    bad = good.withColumn("sender_email", F.lit("x")).withColumn("_raw_dob", F.col("send_amount"))
    row = G.gate_pii_columns(bad).first()
    assert not row["passed"] and "sender_email" in row["detail"] and "2 rows" in row["detail"]
    row = G.gate_forbidden_columns(bad).first()
    assert not row["passed"] and "_raw_dob" in row["detail"] and "1 rows" in row["detail"]


def test_presets(spark):
    from tallyhawk import contract as K
    from tallyhawk.operators import policy as P
    name, factor = K.PRESETS[0]
    assert P.preset(f"  {name.upper().replace('_', '-')} ") == (name, factor) and P.preset()[0] == K.DEFAULT_PRESET
    with pytest.raises(ValueError):
        P.preset("nothing like it")
    churn = spark.createDataFrame([(0.2, 3.0, "measured")], "churn_prob double, monthly_volume_multiple double, source string")
    cost = P.FalsePositiveCost.measured(churn)
    assert (cost.leaving, cost.monthly_multiple, cost.origin) == (0.2, 3.0, "measured")
