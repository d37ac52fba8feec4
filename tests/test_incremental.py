"""Features kept day by day equal one run over everything."""

import datetime as dt
import random
import re
import tempfile

import pytest

from tallyhawk.operators import incremental as I
from tallyhawk.operators.features import add_recipient_history, add_velocity_features

SCHEMA = "_id string, user_id long, recipient_id string, date timestamp, send_amount double"
START = dt.datetime(2024, 3, 1)


def transfers(seed, n=300, days=25):
    rng = random.Random(seed)
    return [(f"t{i:04}", rng.choice([1, 1, 2, 3, None]), rng.choice(["a", "b", None]),
             None if rng.random() < 0.03 else START + dt.timedelta(minutes=rng.randrange(days * 24 * 60)), rng.choice([None, 5.0, 0.1, 77.25]))
            for i in range(n)]


def full(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return add_recipient_history(add_velocity_features(df, time_col="date"), time_col="date")


def same(got, want):
    tidy = lambda df: sorted(tuple((x is not None, str(round(x, 6) if isinstance(x, float) else x)) for x in r)
                             for r in df.select(*sorted(df.columns)).collect())
    assert sorted(got.columns) == sorted(want.columns) and tidy(got) == tidy(want)


@pytest.fixture
def kept(spark):
    return I.DailyFeatures(spark, tempfile.mkdtemp(prefix="th-daily-", dir="/tmp") + "/t")


def test_days_in_order_and_late(spark, kept):
    rows = transfers(1)
    make = lambda part: spark.createDataFrame(part, SCHEMA)
    at = lambda d: START + dt.timedelta(days=d)
    timed = [r for r in rows if r[3]]
    parts = [[r for r in timed if r[3] < at(10)], [r for r in timed if at(12) <= r[3] < at(13)], [r for r in rows if not r[3]],
             [r for r in timed if at(13) <= r[3]]]
    late = [r for r in timed if at(10) <= r[3] < at(12)]
    for n, part in enumerate(parts):
        days = kept.add(make(part), f"b{n}")
        assert days and (n != 3 or min(days) >= "2024-03-14")  # nothing behind a batch that is in time
    assert kept.add(make(parts[0]), "b0") == []
    days = kept.add(make(late), "late")
    assert min(days) == "2024-03-11" and {f"2024-03-{d}" for d in range(11, 18)} <= set(days) and I.NO_DAY in days
    same(kept.features(), full(spark, rows))


def test_only_days_in_reach_are_read(spark, kept):
    rows = [(f"a{d}", d % 2, "x", START + dt.timedelta(days=d, hours=3), 1.0) for d in range(30)]
    kept.add(spark.createDataFrame(rows, SCHEMA), "all")
    live = I.read_manifest(spark, f"{kept.path}/transfers").live
    seen = []
    real = I.read_committed

    def watched(session, path, slots=None):
        df = real(session, path, slots)
        if path.endswith("/transfers") and slots is not None and df is not None:
            seen.append({re.sub(r"/[^/]*$", "", f).split(f"{kept.path}/transfers/")[-1] for f in df.inputFiles()})
        return df
    I.read_committed = watched
    try:
        days = kept.add(spark.createDataFrame([("new", 9, "y", START + dt.timedelta(days=29, hours=5), 2.0)], SCHEMA), "one")
    finally:
        I.read_committed = real
    assert days == ["2024-03-30"]
    live = I.read_manifest(spark, f"{kept.path}/transfers").live
    assert set().union(*seen) == {live[f"2024-03-{d}"] for d in range(23, 31)}
    assert [r["_id"] for r in kept.features(["2024-03-30"]).orderBy("_id").collect()] == ["a29", "new"]


def test_killed_between_the_tables(spark, kept, monkeypatch):
    rows = transfers(2, 60, 6)
    df = spark.createDataFrame(rows, SCHEMA)
    with monkeypatch.context() as m:
        m.setattr(I.DailyFeatures, "_rows", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            kept.add(df, "b")
    assert kept._table("features") is None
    assert kept.add(df, "b")
    same(kept.features(), full(spark, rows))
    assert kept.add(df.limit(0), "empty") == []
