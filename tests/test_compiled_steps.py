"""Steps with many columns stay short enough to be compiled (the virtual machine
leaves methods of more than 8000 bytes interpreted), and shared work is done once."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tallyhawk.operators import scoring as SC
from tallyhawk.operators import training as TR
from tallyhawk.operators.extract import extract_collection
from tallyhawk.plans import queries_ml as Q
from tallyhawk.sources.documents import parse_documents

COMPILED = 8000


def longest(df, capsys):
    capsys.readouterr()
    df.explain(mode="codegen")
    return max(int(n) for n in re.findall(r"maxMethodCodeSize:\s*(\d+)", capsys.readouterr().out))


def test_extraction_is_compiled(spark, tmp_path, capsys):
    spark.createDataFrame([('{"_id": {"$oid": " A1 "}, "status": " "}',)], "json string").write.parquet(str(tmp_path / "d"))
    got = extract_collection(parse_documents(spark.read.parquet(str(tmp_path / "d"))), "transfer", "salt")
    assert longest(got, capsys) < COMPILED
    assert got.select(F.col("_id") == F.substring(F.sha2(F.lit("salta1"), 256), 1, 24)).first()[0]


def test_scoring_is_compiled(spark, tmp_path, capsys):
    rng = random.Random(4)
    names = [f"f{i}" for i in range(40)]
    rows = [(i, *(rng.choice([None, float("nan"), rng.random(), -999.0]) for _ in names)) for i in range(60)]
    spark.createDataFrame(rows, "_id long, " + ", ".join(f"{n} double" for n in names)).write.parquet(str(tmp_path / "m"))
    raw = spark.read.parquet(str(tmp_path / "m"))
    m = TR.filled(raw, names).withColumns({"y": (F.col("_id") % 2).cast("int"), "w": F.lit(1.0), "is_val": F.col("_id") % 5 == 0,
                                           "split": F.lit("val")})
    known = lambda x: x is not None and x == x and x != TR.MISSING
    assert sorted(tuple(r) for r in m.select("_id", *names).collect()) == [(r[0], *(x if known(x) else TR.MISSING for x in r[1:])) for r in rows]
    model = TR.gbt(names, iters=2).fit(m)
    scored = SC.score_table(model, TR.calibrate(model, m), raw, [*names, "not there"], ["_id"])
    assert longest(scored, capsys) < COMPILED
    assert {r["_id"]: r["features_provided"] for r in scored.collect()} == {r[0]: sum(map(known, r[1:])) for r in rows}


@pytest.mark.parametrize("query", [Q.score_table, Q.score_bundle])
@pytest.mark.parametrize("trained", [False, True])
def test_the_training_table_is_assembled_once(spark, monkeypatch, query, trained):
    asked = []

    def table(*_, **__):
        asked.append(1)
        return spark.range(3).withColumnRenamed("id", "_id")

    class Kept:
        threshold, features = 0.5, ["x"]

        def score(self, rows, keep):
            return rows.select(*keep, F.lit(0.6).alias("probability"), F.lit("High").alias("risk_band"), F.lit(1).alias("features_provided"),
                               F.lit(1).alias("features_expected"), F.lit(False).alias("low_coverage"), F.lit(True).alias("flagged"))

    monkeypatch.setattr(Q, "training_table", table)
    monkeypatch.setattr(Q, "train_bundle", lambda *_, rows=table, **__: rows().count())
    monkeypatch.setattr(Q.BU, "versions", lambda *_: [(1, "v1")] if trained else [])
    monkeypatch.setattr(Q.BU, "load", lambda *_: Kept())
    assert sorted(r["_id"] for r in query(spark, "unused").collect()) == [0, 1, 2]
    assert len(asked) == 1
