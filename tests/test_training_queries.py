"""The registered training queries use the library's settings."""

import pytest
from pyspark.sql import functions as F

from tallyhawk.operators import training as TR
from tallyhawk.plans import queries_ml as Q


class Fitted(Exception):
    pass


@pytest.mark.parametrize("query", [Q.train_report, Q.score_table])
def test_rounds_are_the_library_default(spark, monkeypatch, query):
    """The first fit of each query may take all 60 rounds and stops early on validation."""
    rows = spark.range(40).select(
        F.col("id").alias("_id"), (F.col("id") % 2).cast("int").alias("y"), F.col("id").cast("double").alias("amount"),
        F.when(F.col("id") < 30, "train").otherwise("val").alias("split"))
    default = TR.gbt(["amount"]).getStages()[-1]
    real, seen = TR.gbt, []

    def watched(*args, **named):
        seen.append(real(*args, **named).getStages()[-1])
        raise Fitted

    monkeypatch.setattr(TR, "gbt", watched)
    monkeypatch.setattr(Q, "training_matrix", lambda *_: (rows, ["amount"], None))
    monkeypatch.setattr(Q.FX, "scored", lambda *_: None)
    monkeypatch.setattr(Q.PO, "churn_estimate", lambda *_: None)
    monkeypatch.setattr(Q.PO.FalsePositiveCost, "measured", classmethod(lambda cls, _: cls()))
    with pytest.raises(Fitted):
        query(spark, "unused")
    assert [m.getMaxIter() for m in seen] == [default.getMaxIter()] == [60]
    assert seen[0].getValidationIndicatorCol() == "is_val"
