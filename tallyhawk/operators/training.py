"""Model training on Spark ML.

Boosted trees with a class weight and early stopping on the validation
slice, a random-forest challenger, a grid search whose fits use a 35%
sample of train but are scored on the full validation slice, selection by
validation average precision, isotonic calibration on validation, a
threshold chosen on validation and one final read of test.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhawk.operators import metrics as M

SEED = 42


def with_weights(df: DataFrame, spw: float, label: str = "y") -> DataFrame:
    """Positives weighted by neg/pos (the fit split's ratio)."""
    return df.withColumn("w", F.when(F.col(label) == 1, F.lit(float(spw))).otherwise(F.lit(1.0)))


def _assembler(features: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")


def gbt(features: list[str], max_depth: int = 4, step: float = 0.1, iters: int = 60, subsample: float = 1.0,
        feature_subset: str = "all", min_leaf: int = 1) -> Pipeline:
    clf = GBTClassifier(featuresCol="features", labelCol="y", weightCol="w", maxDepth=max_depth, stepSize=step,
                        maxIter=iters, validationIndicatorCol="is_val", seed=SEED, subsamplingRate=subsample,
                        featureSubsetStrategy=feature_subset, minInstancesPerNode=min_leaf)
    return Pipeline(stages=[_assembler(features), clf])


def forest(features: list[str]) -> Pipeline:
    clf = RandomForestClassifier(featuresCol="features", labelCol="y", weightCol="w", numTrees=60,
                                 maxDepth=6, seed=SEED)
    return Pipeline(stages=[_assembler(features), clf])


def fit_frame(split_df: DataFrame, spw: float, train_sample: float | None = None) -> DataFrame:
    """Train rows (optionally a seeded sample) plus validation rows flagged
    for early stopping."""
    train = split_df.filter(F.col("split") == "train")
    if train_sample is not None:
        # by a hash of the row, so the sample does not depend on how rows are partitioned
        part = F.pmod(F.xxhash64(*[F.col(c) for c in split_df.columns], F.lit(SEED)), F.lit(10_000))
        train = train.filter(part < int(train_sample * 10_000))
    val = split_df.filter(F.col("split") == "val")
    return with_weights(train.unionByName(val), spw).withColumn("is_val", F.col("split") == "val")


#: what stands for a missing value; a level of its own, as the trees know no missing
MISSING = -999.0


def filled(df: DataFrame, features: list[str], missing: float = MISSING) -> DataFrame:
    """The feature columns as doubles without null or NaN.

    They are filled as one array: an expression per column, with all that goes
    before and after it, makes a method that is too long to be compiled."""
    if not features:
        return df
    value = lambda c: F.col(c).cast("double") if c in df.columns else F.lit(None).cast("double")
    known = F.transform(F.array(*[value(c) for c in features]), lambda x: F.coalesce(F.nanvl(x, F.lit(missing)), F.lit(missing)))
    return (df.withColumn("_filled", known).withColumns({c: F.get("_filled", F.lit(i)) for i, c in enumerate(features)})
            .drop("_filled"))


def raw_scores(model, df: DataFrame, keep: list[str]) -> DataFrame:
    return model.transform(df).select(*keep, vector_to_array("probability").getItem(1).alias("score"))


def val_ap(model, split_df: DataFrame) -> float:
    val = split_df.filter(F.col("split") == "val")
    r = M.ranking_metrics(raw_scores(model, val, ["y"])).first()
    return float(r["PR_AUC"]) if r["PR_AUC"] is not None else float("nan")


def tune_grid(split_df: DataFrame, features: list[str], spw: float, sample: float = 0.35,
              iters: int = 60) -> list[dict]:
    """Grid search: each candidate fits on a seeded sample of train and is
    scored by average precision on the full validation slice."""
    base = gbt(features, iters=iters)
    clf = base.getStages()[1]
    grid = ParamGridBuilder().addGrid(clf.maxDepth, [3, 5]).addGrid(clf.stepSize, [0.05, 0.2]).build()
    fit_df = fit_frame(split_df, spw, train_sample=sample)
    out = []
    for params in grid:
        model = base.fit(fit_df, params)
        out.append({"max_depth": params[clf.maxDepth], "step_size": params[clf.stepSize],
                    "val_pr_auc": val_ap(model, split_df)})
    return out


def calibrate(model, split_df: DataFrame):
    """Isotonic regression of the label on the raw score, fit on validation;
    predictions outside the fitted range are clipped to its ends."""
    val = raw_scores(model, split_df.filter(F.col("split") == "val"), ["y"])
    # one weighted row per distinct score: what is pooled is bounded by the scores that the model can give
    val = val.groupBy("score").agg(F.avg(F.col("y").cast("double")).alias("y"), F.count(F.lit(1)).cast("double").alias("w"))
    iso = IsotonicRegression(featuresCol="score", labelCol="y", weightCol="w", predictionCol="calibrated", isotonic=True)
    return iso.fit(val)


def calibrated(model, calibrator, df: DataFrame, keep: list[str]) -> DataFrame:
    r = raw_scores(model, df, keep)
    return calibrator.transform(r).withColumnRenamed("score", "raw_score") \
                     .withColumnRenamed("calibrated", "score")


@dataclass
class TrainResult:
    winner: str
    model: object
    calibrator: object
    candidates: dict
    threshold: float
    params: dict
    report: DataFrame
    reliability: DataFrame
    cost_grid: DataFrame


def train_report(split_df: DataFrame, features: list[str], spw: float, keep: list[str],
                 fp_unit_cost: float | str = 25.0, tune: bool = True, iters: int = 60,
                 params: dict | None = None) -> TrainResult:
    """Fit the candidates on train, choose by average precision on val,
    calibrate and set the threshold there, then evaluate once on test.
    ``fp_unit_cost``: a figure or the name of a column with a cost per row.
    ``params``: parameters of the boosted trees that a search has found, in
    place of the grid. ``split_df`` is read by every fit: pass a checkpointed
    frame."""
    best = {"max_depth": 4, "step_size": 0.1}
    if params is None and tune:
        grid = tune_grid(split_df, features, spw, iters=iters)
        best = {k: v for k, v in max(grid, key=lambda r: r["val_pr_auc"]).items() if k != "val_pr_auc"}
    fit_df = fit_frame(split_df, spw)
    if params is None:
        params = {"max_depth": best["max_depth"], "step": best["step_size"]}
    cands = {"gbt": gbt(features, iters=iters, **params).fit(fit_df),
             "forest": forest(features).fit(fit_df.filter(~F.col("is_val")))}
    aps = {n: val_ap(m, split_df) for n, m in cands.items()}
    winner = max(aps, key=aps.get)
    model = cands[winner]
    cal = calibrate(model, split_df)
    extra = ["y", "amount"] + ([fp_unit_cost] if isinstance(fp_unit_cost, str) else [])
    val = calibrated(model, cal, split_df.filter(F.col("split") == "val"), keep + extra)
    t = M.best_threshold(M.threshold_curve(val, fp_unit_cost=fp_unit_cost)).first()["threshold"]
    test = calibrated(model, cal, split_df.filter(F.col("split") == "test"), keep + extra)
    ev = M.evaluate(test, t, fp_unit_cost=fp_unit_cost)
    report = ev.select(F.lit(winner).alias("winner"), F.lit(aps[winner]).alias("val_pr_auc"),
                       F.lit(str(fp_unit_cost)).alias("fp_unit_cost"), "*")
    return TrainResult(winner, model, cal, aps, t, params if winner == "gbt" else {}, report, M.reliability_table(test),
                       M.cost_grid(test))
