"""Label precedence, flag-table checks, bands, feature labels, pseudonyms."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyhawk import contract as K
from tallyhawk.functions.columns import pseudonym, risk_band
from tallyhawk.operators import labels as LB
from tallyhawk.operators.scoring import label_for

D = dt.datetime(2024, 1, 1)


def _flags(spark, rows):
    return spark.createDataFrame(rows, "transfer string, action string, flag_ts timestamp, seq int")


def _labels(spark, flags, ids, cb_ids=()):
    t = spark.createDataFrame([(i,) for i in ids], "_id string")
    cb = spark.createDataFrame([(i,) for i in cb_ids], "_id string") if cb_ids else None
    return {r["_id"]: (r["label"], r["label_source"]) for r in LB.build_labels(flags, t, cb).collect()}


def test_flag_history_rules(spark):
    d = lambda n: D + dt.timedelta(days=n)
    f = _flags(spark, [("a", "flag", d(0), 1),
                       ("b", "flag", d(0), 1), ("b", "unflag", d(1), 1),
                       ("c", "flag", d(0), 1), ("c", "unflag", d(1), 1), ("c", "flag", d(2), 1),
                       ("e", "unflag", d(5), 1), ("e", "flag", d(1), 1)])
    r = _labels(spark, f, ["a", "b", "c", "e", "z"])
    assert r["a"] == (1, K.SOURCE_UPHELD)
    assert r["b"] == (0, K.SOURCE_CLEARED)
    assert r["c"] == (1, K.SOURCE_UPHELD)
    assert r["e"] == (0, K.SOURCE_CLEARED)          # out of order: latest date wins
    assert r["z"] == (0, K.SOURCE_ASSUMED)


def test_chargeback_overrides(spark):
    f = _flags(spark, [("b", "flag", D, 1), ("b", "unflag", D + dt.timedelta(days=1), 1)])
    r = _labels(spark, f, ["b", "n"], cb_ids=["b", "n"])
    assert r["b"] == (1, K.SOURCE_CHARGEBACK)
    assert r["n"] == (1, K.SOURCE_CHARGEBACK)


def test_attach_labels_keeps_rows_and_matches_label_table(spark):
    """Labels joined onto a wide frame equal the label table joined on _id;
    every row stays exactly once, also with repeated flag/chargeback ids."""
    d = lambda n: D + dt.timedelta(days=n)
    f = _flags(spark, [("a", "flag", d(0), 1), ("a", "flag", d(0), 2), ("b", "unflag", d(1), 1),
                       ("c", "flag", d(0), 1), ("c", "unflag", d(0), 1)])
    wide = spark.createDataFrame([("a", 1.0, "x"), ("b", 2.0, None), ("c", 3.0, "z"), ("n", 4.0, "w")],
                                 "_id string, amt double, tag string")
    cb = spark.createDataFrame([("n",), ("n",), (None,)], "_id string")
    got = LB.attach_labels(wide, f, cb)
    assert got.columns == ["_id", "amt", "tag", "label", "label_source"]
    want = wide.join(LB.build_labels(f, wide, cb), "_id", "left")
    rows = lambda df: sorted(tuple(r) for r in df.select(*got.columns).collect())
    assert rows(got) == rows(want)
    assert got.count() == wide.count()
    r = {x["_id"]: (x["label"], x["label_source"]) for x in got.collect()}
    assert r["c"] == (0, K.SOURCE_CLEARED)           # same date and seq: unflag sorts last
    assert r["n"] == (1, K.SOURCE_CHARGEBACK)

def test_flag_checks_raise(spark):
    with pytest.raises(LB.FlagHistoryError):
        LB.check_flag_history(_flags(spark, [("a", "quarantine", D, 1)]))
    with pytest.raises(LB.FlagHistoryError):
        LB.check_flag_history(_flags(spark, [(None, "flag", D, 1)]))


def test_band_boundaries(spark):
    ps = [0.0, 0.14, 0.15, 0.49, 0.50, 0.84, 0.85, 1.0]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    got = [r["b"] for r in df.select(risk_band("p").alias("b")).collect()]
    assert got == ["Low", "Low", "Elevated", "Elevated", "High", "High", "Critical", "Critical"]


def test_feature_labels(spark):
    df = spark.createDataFrame([("send_amount",), ("V258",), ("recipient_bank_name_FE",), ("some_new_field",)], "f string")
    got = [r["l"] for r in df.select(label_for(F.col("f")).alias("l")).collect()]
    assert got == ["Transfer amount", "Behavioural signal V258",
                   "Recipient bank (how common this value is)", "Some new field"]


def test_pseudonym_normalisation(spark):
    df = spark.createDataFrame([("  ABC123  ",), ("abc123",), (None,), ("",), (" \t",)], "v string")
    h = [r["h"] for r in df.select(pseudonym("v", "s").alias("h")).collect()]
    assert h[0] == h[1] and len(h[0]) == 24
    assert h[2] is None and h[3] is None and h[4] is None
    import hashlib
    assert h[1] == hashlib.sha256(b"s" + b"abc123").hexdigest()[:24]


def test_typology_first_match(spark):
    from tallyhawk.functions.columns import typology
    df = spark.createDataFrame([("Stolen card, then romance scam",), ("nothing",), (None,)], "t string")
    assert [r["x"] for r in df.select(typology("t").alias("x")).collect()] == ["stolen_card", "other", None]
