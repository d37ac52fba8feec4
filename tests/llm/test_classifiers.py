import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhawk.llm import labelled, quality, toxicity
from tests.conftest import SF_MID

DOCS = "doc_id long, text string, score string, label int, spans int, id string"


def judged(spark, out, target):
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    return out.join(labels, "doc_id").select("held_out", "predicted", "score", target).toPandas()


def test_quality_on_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    out = quality.classify(docs, labels)
    assert out.count() == docs.count()
    got = judged(spark, out, "quality")
    held = got[got.held_out]
    assert len(held) > 80 and (held.predicted == held.quality).mean() >= 0.95
    assert held[held.quality == 1].predicted.mean() >= 0.97  # good documents stay
    assert got.score.between(0, 1).all()


def test_toxicity_on_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    out = toxicity.tag(docs, labels)
    assert out.count() == docs.count()
    got = judged(spark, out, "toxic")
    held = got[got.held_out]
    assert (held.predicted == held.toxic).mean() >= 0.9
    assert held[held.toxic == 0].predicted.mean() <= 0.05  # clean documents are left alone
    assert held[held.toxic == 1].predicted.mean() >= 0.5
    spans = out.join(docs.select("doc_id", "text"), "doc_id").where(F.size("spans") > 0).collect()
    assert spans
    for r in spans:
        assert all(0 <= s["start"] < s["end"] <= len(r["text"]) for s in r["spans"])


def test_folds(spark):
    import zlib
    ids = [*range(200), None]
    df = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    for parts, part in ((3, 1), (4, 2)):
        got = {r[0]: r[1] for r in df.select("doc_id", labelled.held_out("doc_id", parts, part)).collect()}
        assert got == {i: zlib.crc32(b"" if i is None else str(i).encode()) % parts == part for i in ids}


def test_held_out_labels_are_never_read(spark):
    """Turning every held-out label around changes no score."""
    docs, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.where("doc_id < 300")
    turned = labels.withColumn("quality", F.when(labelled.held_out("doc_id", 3, 1), 1 - F.col("quality")).otherwise(F.col("quality")))
    scores = [sorted(tuple(r) for r in quality.classify(docs, x).select("doc_id", "score").collect()) for x in (labels, turned)]
    assert scores[0] == scores[1]


@pytest.mark.parametrize("run, target", [(quality.classify, "quality"), (toxicity.tag, "toxic")])
def test_odd_rows(spark, run, target):
    rng = random.Random(1)
    say = lambda n: " ".join(rng.choice("river stone tree cloud grass bird".split()) for _ in range(n))
    rows = [(i, say(20) + (" zzgrr zzgrr $$$ %%%" if i % 4 == 0 else ""), "x", 1, 2, "y") for i in range(300)]
    odd = [(1000, None), (1001, ""), (1002, " \n\t"), (1003, "$$$"), (1004, "zzgrr " * 300_000), (1005, "\U0001f600 é \x00"), (None, "river"),
           (5, say(5)), (5, say(5))]
    docs = spark.createDataFrame(rows + [(*r, "x", 1, 2, "y") for r in odd], DOCS)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)] + [(None, 1), (7, None), (5000, 0), (8, 1), (8, 1)],
                                   f"doc_id long, {target} int")
    got = run(docs, labels)
    out = got.collect()
    assert len(out) == len(rows) + len(odd) and all(0 <= r["score"] <= 1 for r in out)
    scores = lambda df: sorted((r[0], round(r[1], 9)) for r in df.select("doc_id", "score").fillna(-1).collect())
    assert scores(run(docs.repartition(5, "text"), labels)) == scores(got)
    empty = next(r for r in out if r["doc_id"] == 1001)["score"]
    assert next(r for r in out if r["doc_id"] == 1000)["score"] == empty
    assert run(docs.limit(0), labels).count() == 0
    one_kind = run(docs, labels.where(f"{target} = 0")).collect()
    assert len({r["score"] for r in one_kind}) == 1 and one_kind[0]["score"] < 0.1
    assert {r["score"] for r in run(docs, labels.limit(0)).collect()} == {0.5}


def test_marginals_are_exact():
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 6, 9):
        emission, first = rng.normal(0, 2, n), np.zeros(n, bool)
        first[0] = True
        if n > 4:
            first[3] = True
        start, move = np.array([0.6, 0.4]), np.array([[1.0, 0.3], [0.2, 0.8]])
        total, one, pairs = 0.0, np.zeros(n), np.zeros((2, 2))
        for s in itertools.product((0, 1), repeat=n):
            w = 1.0
            for t in range(n):
                w *= (start[s[t]] if first[t] else move[s[t - 1], s[t]]) * np.exp(emission[t] * s[t])
            total += w
            one += w * np.array(s)
            for t in range(n):
                if not first[t]:
                    pairs[s[t - 1], s[t]] += w
        p, got = toxicity.marginals(emission, first, start, move, pairs=True)
        assert np.allclose(p, one / total) and np.allclose(got, pairs / total)
    assert len(toxicity.marginals(np.empty(0), np.empty(0, bool), start, move)[0]) == 0
