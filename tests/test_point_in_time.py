"""Velocity, recipient history and split: leakage guards."""

import datetime as dt
import time

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyhawk.operators import features as FT
from tallyhawk.operators.prep import split_sizes, temporal_split
from tallyhawk.operators.ranking import global_rank
from tallyhawk.functions.columns import epoch_us

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)


def _frame(spark, rows):
    return spark.createDataFrame(rows, "_id long, user_id string, date timestamp, send_amount double")


def test_velocity_excludes_current_row(spark):
    rows = [(1, "u1", T0, 100.0), (2, "u1", T0 + dt.timedelta(minutes=10), 200.0),
            (3, "u1", T0 + dt.timedelta(minutes=20), 300.0), (4, "u2", T0, 50.0)]
    out = FT.add_velocity_features(_frame(spark, rows), time_col="date", windows=(24,))
    r = {x["_id"]: x for x in out.collect()}
    assert [r[i]["user_id_txn_24h"] for i in (1, 2, 3)] == [0, 1, 2]
    assert r[3]["user_id_amt_24h"] == 300.0
    assert r[4]["user_id_txn_24h"] == 0 and r[4]["user_id_amt_24h"] == 0.0


def test_velocity_ties_and_lower_bound(spark):
    mins = [0, 0, 10, 70, 70]
    rows = [(i, "u", T0 + dt.timedelta(minutes=m), float(a)) for i, (m, a) in enumerate(zip(mins, [1, 2, 4, 8, 16]))]
    out = FT.add_velocity_features(_frame(spark, rows), time_col="date", windows=(1,))
    r = sorted(out.collect(), key=lambda x: x["_id"])
    assert [x["user_id_txn_1h"] for x in r] == [0, 0, 2, 1, 1]
    assert [x["user_id_amt_1h"] for x in r] == [0, 0, 3, 4, 4]


def test_null_user_and_time_get_zero(spark):
    rows = [(1, None, T0, 5.0), (2, "u", None, 5.0), (3, "u", T0, 5.0)]
    out = FT.add_velocity_features(_frame(spark, rows), time_col="date", windows=(24,))
    assert sorted(x["user_id_txn_24h"] for x in out.collect()) == [0, 0, 0]


def test_halo_buckets_equal_plain_window(spark):
    """Small buckets force many halos; result must equal one plain window."""
    rng = np.random.default_rng(5)
    n = 2000
    users = rng.integers(0, 5, n)           # few users: hot keys
    secs = np.sort(rng.integers(0, 30 * 24 * 3600, n))
    rows = [(i, f"u{u}", T0 + dt.timedelta(seconds=int(s)), float(i % 17))
            for i, (u, s) in enumerate(zip(users, secs))]
    df = _frame(spark, rows)
    got = FT.add_velocity_features(df, time_col="date", windows=(1, 24, 168),
                                   bucket_us=168 * 3_600_000_000)
    us = epoch_us("date")
    w = lambda h: Window.partitionBy("user_id").orderBy(us).rangeBetween(-h * 3_600_000_000, -1)
    ref = df.select("_id", *[F.count("send_amount").over(w(h)).alias(f"c{h}") for h in (1, 24, 168)],
                    *[F.coalesce(F.sum("send_amount").over(w(h)), F.lit(0.0)).alias(f"s{h}") for h in (1, 24, 168)])
    g = {r["_id"]: r for r in got.collect()}
    for r in ref.collect():
        for h in (1, 24, 168):
            assert g[r["_id"]][f"user_id_txn_{h}h"] == r[f"c{h}"]
            assert g[r["_id"]][f"user_id_amt_{h}h"] == pytest.approx(r[f"s{h}"])


def test_prior_sends(spark):
    rows = [(1, "u1", "r1", T0), (2, "u1", "r1", T0 + dt.timedelta(days=1)),
            (3, "u1", "r2", T0 + dt.timedelta(days=2))]
    df = spark.createDataFrame(rows, "_id long, user_id string, recipient_id string, date timestamp")
    out = FT.add_recipient_history(df, time_col="date")
    r = sorted(out.collect(), key=lambda x: x["_id"])
    assert [x["is_first_send_to_recipient"] for x in r] == [1, 0, 1]
    assert [x["prior_sends_to_recipient"] for x in r] == [0, 1, 0]


def test_history_two_level_equals_row_number(spark):
    rng = np.random.default_rng(9)
    n = 1500
    rows = [(i, f"u{rng.integers(0, 3)}", f"r{rng.integers(0, 2)}",
             T0 + dt.timedelta(days=int(rng.integers(0, 400)))) for i in range(n)]
    df = spark.createDataFrame(rows, "_id long, user_id string, recipient_id string, date timestamp")
    got = {r["_id"]: r["prior_sends_to_recipient"] for r in FT.add_recipient_history(df, time_col="date").collect()}
    w = Window.partitionBy("user_id", "recipient_id").orderBy("date", "_id")
    for r in df.select("_id", (F.row_number().over(w) - 1).alias("p")).collect():
        assert got[r["_id"]] == r["p"]


DATES = {
    "spread": lambda i: f"2024-01-{1 + i * 7 % 28:02d} {i % 24:02d}:00:00",
    "one date": lambda i: "2024-01-01 00:00:00",
    "an outlier": lambda i: "9999-12-31 00:00:00" if i == 0 else f"2024-01-01 00:{i // 60 % 60:02d}:{i % 60:02d}",
}


@pytest.mark.parametrize("dates", DATES)
def test_positions_with_many_buckets(spark, dates):
    """Balanced buckets: none holds most rows, whatever the dates are."""
    from tallyhawk.operators.prep import split_sizes, temporal_split
    from tallyhawk.operators.ranking import range_bucket, row_at
    rows = [(i * 37 % 3001, DATES[dates](i)) for i in range(3001)]
    df = spark.createDataFrame(rows, "_id long, date string").withColumn("us", epoch_us(F.col("date").cast("timestamp")))
    want = [r["_id"] for r in sorted(df.collect(), key=lambda r: (r["us"], r["_id"]))]
    order = [F.col("us").asc(), F.col("_id").asc()]
    ranked = global_rank(df, order, buckets=17)
    assert [r["_id"] for r in sorted(ranked.collect(), key=lambda r: r["_rank"])] == want
    assert sorted(r["_rank"] for r in ranked.collect()) == list(range(3001))
    sizes = [r["count"] for r in range_bucket(df, order, "b", 17).groupBy("b").count().collect()]
    assert len(sizes) > 10 and max(sizes) < 3001 / 4
    at = row_at(df, ["us", "_id"], [0, 1000, 3000, 3001], 17)
    assert [r and r["_id"] for r in at] == [want[0], want[1000], want[3000], None]
    split = {r["_id"]: r["split"] for r in temporal_split(df).collect()}
    n_train, n_val, n_test = split_sizes(3001)
    assert [split[i] for i in want] == ["train"] * n_train + ["val"] * n_val + ["test"] * n_test


def test_one_user_with_many_rows(spark):
    """All in one bucket: a sliding frame would need minutes."""
    from tallyhawk.operators.features import add_velocity_features
    n = 200_000
    df = spark.range(n).select(F.lit("u").alias("user_id"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).alias("_t"),
                               (F.col("id") % 100 / 4).alias("send_amount"), "id")
    t0 = time.time()
    out = add_velocity_features(df, bucket_us=400 * 24 * 3_600_000_000)
    got = out.agg(F.max("user_id_txn_1h"), F.max("user_id_txn_168h"), F.sum("user_id_amt_1h")).first()
    assert time.time() - t0 < 60
    ids = range(n)
    amounts, total, ahead = [i % 100 / 4 for i in ids], 0.0, 0.0
    for i in ids:
        total += ahead
        ahead += amounts[i] - (amounts[i - 3600] if i >= 3600 else 0)
    assert got[0] == 3600 and got[1] == n - 1 and abs(got[2] - total) < 1e-3 * total / n + 1


def test_conflicting_ids_are_chosen_by_rule(spark):
    from tallyhawk.operators.features import conflicting_ids, one_per_id
    df = spark.createDataFrame([("u1", "US", 1), ("u1", "GB", 9), ("u2", "FR", 2), ("u2", "FR", 2)],
                               "_id string, country string, n int")
    assert conflicting_ids(df).first()[0] == 1
    for d in (df, df.repartition(3), df.orderBy("n")):
        assert sorted(tuple(r) for r in one_per_id(d).collect()) == [("u1", "US", 1), ("u2", "FR", 2)]

def test_split_is_chronological(spark):
    rows = [(i, "u", T0 + dt.timedelta(hours=i), 1.0) for i in range(100)]
    s = temporal_split(_frame(spark, rows)).collect()
    n_train, n_val, n_test = split_sizes(100)
    by = {r["_id"]: r["split"] for r in s}
    assert [by[i] for i in range(100)] == ["train"] * n_train + ["val"] * n_val + ["test"] * n_test
    assert (n_train, n_val, n_test) == (68, 12, 20)


def test_split_raises_on_bad_date(spark):
    rows = [(1, "u", T0, 1.0), (2, "u", None, 1.0)]
    with pytest.raises(ValueError):
        temporal_split(_frame(spark, rows))


def _window_sums(spark, amounts):
    from tallyhawk.operators.features import add_velocity_features
    rows = [(i, "u", i * 60, a) for i, a in enumerate(amounts)]
    df = spark.createDataFrame(rows, "_id int, user_id string, s long, send_amount double")
    df = df.withColumn("_t", F.timestamp_seconds("s"))
    got = add_velocity_features(df, windows=(1,)).orderBy("_id").collect()
    return [(r["user_id_txn_1h"], r["user_id_amt_1h"]) for r in got]


def test_velocity_keeps_every_amount(spark):
    """Large, tiny, negative and infinite amounts; NaN and null are no amounts."""
    import math
    import random
    rng = random.Random(4)
    amounts = [1e20, 1e-9, 3.5, -1e20, 2e25, 1e-12, None, float("nan"), 0.1, -7.25, 1e15 + 0.5, *(
        rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.randrange(-9, 26) for _ in range(150))]
    known = [a if a is not None and a == a else None for a in amounts]
    for i, (n, s) in enumerate(_window_sums(spark, amounts)):
        inside = [a for a in known[max(0, i - 60):i] if a is not None]
        assert n == len(inside)
        size = max(map(abs, inside), default=0.0)
        assert s == pytest.approx(math.fsum(inside), rel=1e-12, abs=size * 1e-15)
    # what left the frame leaves no trace, however large it was
    assert _window_sums(spark, [1e25, *[0.0] * 60, 1e-9, 1.0])[-1] == (60, pytest.approx(1e-9, rel=1e-8))
    inf = float("inf")
    assert [s for _, s in _window_sums(spark, [inf, 1.0, -1e30, 2.0])][1:3] == [inf, inf]
    assert math.isnan(_window_sums(spark, [inf, 1.0, -1e30, 2.0])[3][1])
    assert _window_sums(spark, [inf, *[0.0] * 60, 2.0, 1.0])[-1] == (60, 2.0)


@pytest.mark.parametrize("kind", ["one pair", "no pair", "no time"])
def test_history_of_a_hot_pair_is_spread(spark, kind):
    """300,000 rows of one pair in one day, of null pairs, and without a time: numbered by many tasks, all right."""
    n = 300_000
    d = spark.range(n).select(
        F.format_string("%07d", F.pmod(F.col("id") * 7919, F.lit(n))).alias("_id"),
        F.lit(None if kind == "no pair" else "u").cast("string").alias("user_id"),
        F.lit(None if kind == "no pair" else "r").cast("string").alias("recipient_id"),
        (F.lit(None).cast("timestamp") if kind == "no time" else F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") % 86_000)).alias("_t"))
    out = FT.add_recipient_history(d, buckets=16).withColumn("task", F.spark_partition_id())
    order = Window.orderBy(F.col("_t").asc_nulls_last(), "_id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in out.groupBy("task").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(sizes) < n / 2 and len(sizes) > 3
    wrong = out.withColumn("want", F.row_number().over(order) - 1).where(F.col("want") != F.col("prior_sends_to_recipient"))
    assert wrong.count() == 0 and out.where("is_first_send_to_recipient = 1").count() == 1


@pytest.mark.parametrize("ranges", [1, 3, 16])
def test_ranged_velocity_equals_buckets(spark, ranges):
    """Keys inside a range, across two and over many; ties at the edges; rows without key, time or amount."""
    import random
    rng = random.Random(ranges)
    rows = [(i, rng.choice(["hot"] * 6 + ["a", "b", "c", None]), None if rng.random() < 0.03 else 3600 * rng.randrange(400) // rng.choice([1, 2]),
             rng.choice([None, 1.5, 0.25, -4.0, 1e21])) for i in range(1500)]
    df = spark.createDataFrame(rows, "_id int, user_id string, s long, send_amount double").withColumn("_t", F.timestamp_seconds("s"))
    tidy = lambda d: sorted(map(repr, d.collect()))
    assert tidy(FT.add_velocity_features(df, ranges=ranges)) == tidy(FT.add_velocity_features(df))


def test_velocity_of_a_hot_user_is_spread(spark):
    """A million rows of one user in one day: summed by many tasks, all right."""
    n = 1_000_000
    d = spark.range(n).select("id", F.lit("u").alias("user_id"), F.lit(1.0).alias("send_amount"),
                              F.timestamp_micros(F.lit(1_700_000_000_000_000) + F.pmod(F.col("id") * 7919, F.lit(n)) * 80_000).alias("_t"))
    out = FT.add_velocity_features(d, windows=(1, 24), ranges=16)
    spans = d.repartitionByRange(16, "user_id", F.col("_t")).groupBy(F.spark_partition_id()).count().collect()
    assert len(spans) > 8 and max(r["count"] for r in spans) < n / 4
    nth = F.pmod(F.col("id") * 7919, F.lit(n))
    wrong = out.where((F.col("user_id_txn_1h") != F.least(nth, F.lit(45_000))) | (F.col("user_id_txn_24h") != nth)
                      | (F.col("user_id_amt_1h") != F.col("user_id_txn_1h")))
    assert wrong.count() == 0 and out.count() == n
