"""Batches that are killed, repeated, late or concurrent; labels kept by batches."""

import itertools
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tallyhawk.operators import labels as LB
from tallyhawk.operators.label_state import LabelState
from tallyhawk.sources import commits as C


@pytest.fixture
def path():
    return tempfile.mkdtemp(prefix="th-commit-", dir="/tmp") + "/table"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_append(spark, path):
    one, two = (spark.createDataFrame(x, "k int, v string") for x in ([(1, "a"), (1, "a")], [(2, None)]))
    assert C.read_committed(spark, path) is None
    assert C.commit_batch(one, path, "b1") and not C.commit_batch(one, path, "b1")
    assert C.commit_batch(two.select("v", F.col("k").cast("long")), path, "b2")
    got = C.read_committed(spark, path)
    assert got.dtypes == [("k", "int"), ("v", "string")]
    assert sorted(map(repr, got.collect())) == sorted(map(repr, one.collect() + two.collect()))
    with pytest.raises(ValueError, match="differ"):
        C.commit_batch(one.drop("v"), path, "b3")
    assert C.commit_batch(one.limit(0), path, "empty") and got.count() == C.read_committed(spark, path).count() == 3


def test_killed_batch_leaves_nothing(spark, path, monkeypatch):
    df = spark.createDataFrame([(1, "a")], "k int, v string")

    def killed(*_):
        raise KeyboardInterrupt
    with monkeypatch.context() as m:
        m.setattr(C, "_put_manifest", killed)
        with pytest.raises(KeyboardInterrupt):
            C.commit_batch(df, path, "b1")
    assert os.listdir(f"{path}/data") and C.read_committed(spark, path) is None
    assert C.commit_batch(df, path, "b1") and C.read_committed(spark, path).count() == 1


def test_two_writers(spark, path, monkeypatch):
    """The second writer sees the version of the first and keeps its rows."""
    add = lambda old, new: new if old is None else old.unionByName(new)
    a, b = (spark.createDataFrame([(0, x)], "s int, v string") for x in "ab")
    real, once = C._put_manifest, []

    def meanwhile(*args):
        if not once:
            once.append(1)
            assert C.commit_slots(b, path, "other", "s", add)
        real(*args)
    monkeypatch.setattr(C, "_put_manifest", meanwhile)
    assert C.commit_slots(a, path, "mine", "s", add)
    assert rows(C.read_committed(spark, path)) == [(0, "a"), (0, "b")]
    assert sorted(C.read_manifest(spark, path).done) == ["mine", "other"]


def test_only_touched_slots_change(spark, path):
    df = spark.createDataFrame([(i % 4, i) for i in range(20)] + [(None, 99)], "s int, v int")
    with pytest.raises(ValueError, match="without a s"):
        C.commit_slots(df, path, "b0", "s")
    C.commit_slots(df.where("s is not null"), path, "b1", "s")
    with pytest.raises(Exception, match="does not touch"):
        C.commit_slots(df.where("s = 1"), path, "b2", "s", lambda old, new: old.withColumn("s", F.lit(3)))
    before = C.read_manifest(spark, path).live
    C.commit_slots(spark.createDataFrame([(2, -1)], "s int, v int"), path, "b2", "s")
    after = C.read_manifest(spark, path).live
    assert {s for s in after if after[s] != before[s]} == {"2"}
    assert rows(C.read_committed(spark, path)) == sorted([(i % 4, i) for i in range(20) if i % 4 != 2] + [(2, -1)])
    assert rows(C.read_committed(spark, path, ["2", "no such"])) == [(2, -1)]


FLAGS = [("t1", "flag", "2024-01-01 00:00:00", 1), ("t1", "unflag", "2024-01-05 00:00:00", 1), ("t2", "flag", "2024-02-01 00:00:00", 1),
         ("t2", "unflag", "2024-02-01 00:00:00", 1), ("t3", "unflag", "2024-01-01 00:00:00", 1), ("t3", "flag", "2024-01-01 00:00:00", 2),
         ("t9", None, None, 1), ("t4", "flag", "1969-05-01 00:00:00.000001", 3), ("t1", "flag", "2024-01-04 00:00:00", 9)]
CHARGES = [("r1", None), ("r1", "x"), (None, "x5"), ("gone", "x6"), (None, None), ("r8", "x1")]
TRANSFERS = [(f"t{i}", f"r{i % 6}", f"x{i}") for i in range(1, 9)]


def test_labels_in_any_order_of_batches(spark):
    flags = [spark.createDataFrame(part, "transfer string, action string, flag_ts string, seq long")
             .withColumn("flag_ts", F.col("flag_ts").cast("timestamp")) for part in (FLAGS[:4], FLAGS[4:6], FLAGS[6:])]
    charges = [spark.createDataFrame(part, "partner_reference string, partner_txn_id string") for part in (CHARGES[:2], CHARGES[2:])]
    transfers = spark.createDataFrame(TRANSFERS, "_id string, partner_reference string, partner_txn_id string")
    history = flags[0].unionByName(flags[1]).unionByName(flags[2])
    matched = LB.match_to_transfers(charges[0].unionByName(charges[1]), transfers)
    want = sorted(map(repr, LB.label_details(history, transfers, matched).collect()))
    audit = LB.flag_history_audit(history.where("action is not null")).collect()
    steps = [(f"f{n}", "add_flags", f) for n, f in enumerate(flags)] + [(f"c{n}", "add_chargebacks", c) for n, c in enumerate(charges)]
    orders = list(itertools.permutations(steps))
    for order in (orders[0], orders[-1], orders[61]):
        state = LabelState(spark, tempfile.mkdtemp(prefix="th-labels-", dir="/tmp") + "/state", buckets=5)
        for name, method, df in [*order, *order[1:3]]:
            assert getattr(state, method)(df, name) == (name not in state.__dict__.setdefault("seen", set()))
            state.seen.add(name)
        assert sorted(map(repr, state.details(transfers).collect())) == want
        assert state.audit().collect() == audit
        assert state.labels(transfers).columns == ["_id", "label", "label_source", "verdict_date"]


def test_a_bad_batch_counts_nowhere(spark, path):
    state = LabelState(spark, path, buckets=3)
    assert state.verdicts() is None and state.audit().first()[0] == 0
    bad = spark.createDataFrame([("t1", "hold", "2024-01-01 00:00:00", 1)], "transfer string, action string, flag_ts string, seq long")
    with pytest.raises(Exception, match="flag history"):
        state.add_flags(bad, "b")
    assert state.verdicts() is None
    transfers = spark.createDataFrame(TRANSFERS[:1], "_id string, partner_reference string, partner_txn_id string")
    assert [(r["label"], r["label_source"]) for r in state.labels(transfers).collect()] == [(0, "assumed_legit_never_flagged")]
