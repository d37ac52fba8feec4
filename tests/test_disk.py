"""What is written on the way: compressed columns, removed when done; narrow joins."""

import datetime as dt
import decimal
import os
from types import SimpleNamespace

from pyspark.sql import functions as F

from tallyhawk.operators import scoring as SC
from tallyhawk.operators import training as TR
from tallyhawk.operators.ranking import row_at
from tallyhawk.plans import queries_ml as Q
from tallyhawk.session import ensure_checkpoint_dir, materialize, passing, settled


def size(path):
    return sum(os.path.getsize(f"{d}/{f}") for d, _, files in os.walk(path.removeprefix("file:")) for f in files)


def folder(df):
    (found,) = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    return found.removeprefix("file:")


def test_what_is_fixed_is_the_same_and_small(spark):
    when = dt.datetime(1890, 5, 1, 2, 3, 4, 567891)
    rows = [(1, "a", float("nan"), when, when, when.date(), decimal.Decimal("1.50"), ["x", None], None),
            (None, None, None, None, None, None, None, None, None), (1, "", -0.0, when, when, None, None, [], None)]
    df = spark.createDataFrame(rows, "`a b` int, s string, d double, t timestamp, n timestamp_ntz, y date, m decimal(9,2), l array<string>, v struct<w: int>")
    assert sorted(map(repr, materialize(df).collect())) == sorted(map(repr, df.collect()))
    assert repr(materialize(df.select(F.lit(None).alias("void"), "s")).collect()) == repr(df.select(F.lit(None).alias("void"), "s").collect())
    wide = spark.range(50_000).select("id", *[(F.col("id") % n).cast("double").alias(f"c{n}") for n in range(2, 22)])
    fixed = materialize(wide)
    assert fixed.count() == 50_000 and 0 < size(folder(fixed)) < 50_000 * 21 * 8 / 10
    assert spark.conf.get("spark.sql.parquet.outputTimestampType") == "INT96"  # the session's settings are as before


def test_what_passes_is_removed(spark):
    made = []

    def build():
        made.append(materialize(spark.range(9)))
        return made[0].withColumn("x", F.col("id") + 1)
    with passing(spark):
        inner = materialize(spark.range(3))
        out = settled(spark, build)
        stays = materialize(spark.range(4), stays=True)
        gone = settled(spark, lambda: spark.range(5), stays=False)
        folders = [folder(f) for f in (inner, gone)]
        assert all(map(os.path.exists, folders)) and gone.count() == 5
    assert out.count() == 9 and stays.count() == 4 and not any(map(os.path.exists, folders))
    assert made[0].inputFiles() and not os.path.exists(folder(made[0]))
    tables = f"{ensure_checkpoint_dir(spark)}/tables".removeprefix("file:")
    before = sorted(os.listdir(tables))
    assert [r["id"] for r in row_at(spark.range(100), ["id"], [0, 57])] == [0, 57]
    assert sorted(os.listdir(tables)) == before


def test_joins_carry_no_contributions(spark, monkeypatch):
    names = ["send_amount", "hour", "prior_sends_to_recipient"]
    m = spark.range(300).select(F.col("id").alias("_id"), (F.col("id") % 7).cast("double").alias(names[0]), (F.col("id") % 24).alias(names[1]),
                                F.when(F.col("id") % 5 > 0, F.col("id") % 3).alias(names[2]))
    train = TR.filled(m, names).withColumns({"y": (F.col(names[0]) > 3).cast("int"), "w": F.lit(1.0), "is_val": F.col("_id") % 4 == 0})
    model = TR.gbt(names, max_depth=2, iters=3).fit(train)
    scored = TR.raw_scores(model, TR.filled(m, names), ["_id"]).select("_id", F.col("score").alias("probability"), SC.risk_band(F.col("score")).alias("risk_band"))
    monkeypatch.setattr(Q, "_explained", lambda spark, sf_dir: (SimpleNamespace(model=model, features=names), m, scored))
    whole, text = Q.tree_contributions(spark, ""), Q.explain_scores(spark, "")
    assert [r["adds_up"] for r in whole.collect()] == [True] * 300
    assert text.count() == 300 and text.where(F.size("factors") > 0).count() > 100
    for df in (whole, text):
        df.collect()
        shuffled = [x for x in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in x or "Project" in x]
        above = shuffled[:1 + max(i for i, x in enumerate(shuffled) if "Join" in x)]
        assert above and not any("impacts" in x for x in above)
