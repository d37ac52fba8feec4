"""Evaluation in ranking, threshold and money terms.

Inputs are one scored DataFrame (y, score, amount[, fp cost][, segment]) -
never positionally aligned arrays. Every metric is an aggregate, optionally
per key (configuration, segment), so a breakdown is one ``groupBy`` rather
than a loop of masks, and the threshold sweep is one aggregation into 100
grid buckets plus prefix sums over 99 rows instead of 99 passes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhawk import contract as K
from tallyhawk.functions.columns import grid_index, risk_band, score_or_null
from tallyhawk.operators.ranking import exclusive_prefix, range_bucket

GRID_STEPS = 100


def _num(c) -> Column:
    """Amount with null and NaN -> 0."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.nanvl(c.cast("double"), F.lit(0.0)), F.lit(0.0))


def with_score(df: DataFrame, score: str) -> DataFrame:
    """The rows that have a score; all that a metric ever sees."""
    return df.filter(score_or_null(F.col(score)).isNotNull())


def _join_on(a: DataFrame, b: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join per key, a null key being a key like any other; without keys ``b`` is a one-row aggregate and is
    broadcast (a constant-key shuffle join would put every row in one task)."""
    if keys:
        same = [b[k].alias(f"_key_{k}") for k in keys]
        b = b.select(*same, *[c for c in b.columns if c not in keys])
        on = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
        return a.join(b, on, how).drop(*[f"_key_{k}" for k in keys])
    return a.withColumn("_one", F.lit(1)).join(F.broadcast(b.withColumn("_one", F.lit(1))), "_one").drop("_one")


def ranking_metrics(df: DataFrame, y: str = "y", score: str = "score",
                    keys: list[str] | None = None, buckets: int | None = None) -> DataFrame:
    """AUROC (ties count half) and average precision (step sum over distinct
    scores, descending), plus the positive rate as the PR baseline. Null when
    a key has one class only.

    Works on the distinct (key, score) table with two-level prefix sums, so
    no single task ever sorts all scores.
    """
    keys = list(keys or [])
    d = (with_score(df, score)
           .groupBy(*keys, F.col(score).cast("double").alias("_s"))
           .agg(F.sum(F.col(y).cast("long")).alias("_pos"),
                F.sum((1 - F.col(y)).cast("long")).alias("_neg")))
    d = range_bucket(d, [F.col("_s").desc()], "_bk", buckets)
    p = exclusive_prefix(d, [F.col("_s").desc()], "_bk",
                         {"_pos_above": F.col("_pos"), "_neg_above": F.col("_neg")},
                         keys=keys or None)
    tp = F.col("_pos_above") + F.col("_pos")
    fp = F.col("_neg_above") + F.col("_neg")
    r = p.groupBy(*keys).agg(
        F.sum("_pos").alias("_P"), F.sum("_neg").alias("_N"),
        F.sum(F.col("_pos").cast("double") * F.col("_neg_above")).alias("_pa"),   # products outgrow a long
        F.sum(F.col("_pos").cast("double") * F.col("_neg")).alias("_pt"),
        F.sum(F.col("_pos") * tp / (tp + fp)).alias("_ap"))
    both = (F.col("_P") > 0) & (F.col("_N") > 0)
    pn = F.col("_P").cast("double") * F.col("_N").cast("double")
    return r.select(*keys,
                    F.when(both, (pn - F.col("_pa") - 0.5 * F.col("_pt")) / pn).alias("AUROC"),
                    F.when(both, F.col("_ap") / F.col("_P")).alias("PR_AUC"),
                    (F.col("_P") / (F.col("_P") + F.col("_N"))).alias("pr_auc_baseline"))


def threshold_metrics(df: DataFrame, threshold: float, y: str = "y", score: str = "score",
                      keys: list[str] | None = None) -> DataFrame:
    keys = list(keys or [])
    pred = F.col(score).cast("double") >= F.lit(float(threshold))
    pos = F.col(y) == 1
    r = with_score(df, score).groupBy(*keys).agg(
        F.count_if(pos & pred).alias("tp"), F.count_if(~pos & pred).alias("fp"),
        F.count_if(pos & ~pred).alias("fn"), F.count_if(~pos & ~pred).alias("tn"),
        F.count(F.lit(1)).alias("_n"))
    tp, fp, fn, tn, n = (F.col(c) for c in ("tp", "fp", "fn", "tn", "_n"))
    z = F.lit(0.0)
    return r.select(*keys, F.lit(float(threshold)).alias("threshold"),
                    F.coalesce(F.try_divide(tp, tp + fp), z).alias("precision"),
                    F.coalesce(F.try_divide(tp, tp + fn), z).alias("recall"),
                    F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), z).alias("f1"),
                    "tp", "fp", "fn", "tn",
                    F.coalesce(F.try_divide(tp + fp, n), z).alias("flag_rate"),
                    F.coalesce(F.try_divide(fp, fp + tn), z).alias("false_positive_rate"))


def cost(df: DataFrame, threshold: float, y: str = "y", score: str = "score", amount: str = "amount",
         fp_unit_cost: float | str | None = None, fn_loss_fraction: float | None = None,
         fn_fixed_cost: float | None = None, keys: list[str] | None = None) -> DataFrame:
    """Missed fraud at amount x fraction + fixed, wrongly declined customers at
    a flat or per-row cost (a column name), and the total per million rows."""
    keys = list(keys or [])
    fpc = K.FP_UNIT_COST if fp_unit_cost is None else fp_unit_cost
    frac = K.FN_LOSS_FRACTION if fn_loss_fraction is None else fn_loss_fraction
    fixed = K.FN_FIXED_COST if fn_fixed_cost is None else fn_fixed_cost
    fp_each = F.col(fpc).cast("double") if isinstance(fpc, str) else F.lit(float(fpc))
    pred = F.col(score).cast("double") >= F.lit(float(threshold))
    fn_m = (F.col(y) == 1) & ~pred
    fp_m = (F.col(y) == 0) & pred
    r = with_score(df, score).groupBy(*keys).agg(
        F.sum(F.when(fn_m, _num(amount)).otherwise(0.0)).alias("_fn_amt"),
        F.count_if(fn_m).alias("n_missed_fraud"),
        F.sum(F.when(fp_m, fp_each).otherwise(0.0)).alias("fp_cost"),
        F.count_if(fp_m).alias("n_false_declines"),
        F.count(F.lit(1)).alias("_n"))
    fn_cost = F.col("_fn_amt") * F.lit(float(frac)) + F.col("n_missed_fraud") * F.lit(float(fixed))
    r = r.withColumn("fn_cost", fn_cost).withColumn("total_cost", F.col("fn_cost") + F.col("fp_cost"))
    return r.select(*keys, "fn_cost", "fp_cost", "total_cost",
                    F.coalesce(F.try_divide(F.col("total_cost"), F.col("_n")) * 1_000_000, F.lit(0.0))
                     .alias("cost_per_million"),
                    "n_missed_fraud", "n_false_declines")


def evaluate(df: DataFrame, threshold: float, keys: list[str] | None = None, **kw) -> DataFrame:
    """Ranking, threshold and cost metrics merged into one row per key."""
    keys = list(keys or [])
    cols = {k: kw.pop(k) for k in ("y", "score") if k in kw}
    r = ranking_metrics(df, keys=keys, **cols)
    t = threshold_metrics(df, threshold, keys=keys, **cols)
    c = cost(df, threshold, keys=keys, **cols, **kw)
    return _join_on(_join_on(r, t, keys), c, keys)


def segment_metrics(df: DataFrame, threshold: float, segment: str = "segment", min_n: int = 30,
                    **kw) -> DataFrame:
    """Metrics per segment (null -> '(missing)') of the rows with a score,
    segments below ``min_n`` of them skipped."""
    d = with_score(df, kw.get("score", "score")).withColumn("segment", F.coalesce(F.col(segment).cast("string"), F.lit("(missing)")))
    sizes = d.groupBy("segment").agg(F.count(F.lit(1)).alias("n"),
                                     F.avg(F.col(kw.get("y", "y")).cast("double")).alias("fraud_rate"))
    big = sizes.filter(F.col("n") >= min_n)
    d = d.join(big.select("segment"), "segment", "left_semi")
    ev = evaluate(d, threshold, keys=["segment"], **kw)
    return big.join(ev, "segment").select("segment", "n", "fraud_rate", "AUROC", "PR_AUC", "recall",
                                           "precision", "cost_per_million")


def _grid_table(df: DataFrame, y: str, score: str, amount: str, fp_each: Column,
                keys: list[str]) -> DataFrame:
    """Per (keys, grid bucket k): positives' amount and count, negatives'
    fp cost and count. k = number of grid points i/100 that are <= score."""
    pos = F.col(y) == 1
    return (with_score(df, score).withColumn("_k", grid_index(F.col(score), GRID_STEPS))
              .groupBy(*keys, "_k").agg(
                  F.sum(F.when(pos, _num(amount)).otherwise(0.0)).alias("_pamt"),
                  F.count_if(pos).alias("_pcnt"),
                  F.sum(F.when(~pos, fp_each).otherwise(0.0)).alias("_nfp"),
                  F.count_if(~pos).alias("_ncnt")))


def threshold_curve(df: DataFrame, y: str = "y", score: str = "score", amount: str = "amount",
                    fp_unit_cost: float | str | None = None, fn_loss_fraction: float | None = None,
                    fn_fixed_cost: float | None = None, keys: list[str] | None = None) -> DataFrame:
    """Cost at each grid threshold i/100, i = 1..99, with its confusion counts.

    A threshold i flags exactly the rows with grid bucket >= i, so missed
    fraud is the positives in buckets below i and false declines the
    negatives in buckets from i: prefix sums over at most 100 buckets.
    """
    keys = list(keys or [])
    fpc = K.FP_UNIT_COST if fp_unit_cost is None else fp_unit_cost
    frac = K.FN_LOSS_FRACTION if fn_loss_fraction is None else fn_loss_fraction
    fixed = K.FN_FIXED_COST if fn_fixed_cost is None else fn_fixed_cost
    fp_each = F.col(fpc).cast("double") if isinstance(fpc, str) else F.lit(float(fpc))
    g = _grid_table(df, y, score, amount, fp_each, keys)
    # complete the 0..99 bucket range per key with a generated sequence (100 rows per key)
    keyset = g.select(*keys).distinct() if keys else df.sparkSession.range(1).select()
    full = (keyset.withColumn("_k", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(GRID_STEPS - 1).cast("bigint"))))
                  .transform(lambda x: _join_on(x, g, keys + ["_k"], "left")).na.fill(0, ["_pamt", "_pcnt", "_nfp", "_ncnt"]))
    below = Window.partitionBy(*keys).orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
    from_here = Window.partitionBy(*keys).orderBy("_k").rowsBetween(0, Window.unboundedFollowing)
    c = full.select(*keys, F.col("_k").alias("i"),
                    F.coalesce(F.sum("_pamt").over(below), F.lit(0.0)).alias("_fn_amt"),
                    F.coalesce(F.sum("_pcnt").over(below), F.lit(0)).alias("fn"),
                    F.sum("_pcnt").over(from_here).alias("tp"),
                    F.sum("_nfp").over(from_here).alias("fp_cost"),
                    F.sum("_ncnt").over(from_here).alias("fp"),
                    F.coalesce(F.sum("_ncnt").over(below), F.lit(0)).alias("tn"))
    c = c.filter(F.col("i") >= 1)
    fn_cost = F.col("_fn_amt") * F.lit(float(frac)) + F.col("fn") * F.lit(float(fixed))
    return c.select(*keys, (F.col("i").cast("double") / GRID_STEPS).alias("threshold"),
                    fn_cost.alias("fn_cost"), "fp_cost", (fn_cost + F.col("fp_cost")).alias("total_cost"),
                    "tp", "fp", "fn", "tn")


def best_threshold(curve: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Lowest total cost; ties go to the lowest threshold."""
    keys = list(keys or [])
    best = curve.groupBy(*keys).agg(F.min_by(F.struct("threshold", "total_cost"),
                                             F.struct("total_cost", "threshold")).alias("_b"))
    return best.select(*keys, F.col("_b.threshold").alias("threshold"), F.col("_b.total_cost").alias("total_cost"))


def cost_grid(df: DataFrame, fp_costs=None, y: str = "y", score: str = "score", amount: str = "amount",
              fn_loss_fraction: float | None = None, fn_fixed_cost: float | None = None) -> DataFrame:
    """Best threshold, recall, precision and cost per million for each flat
    FP cost: the grid counts are computed once and the costs applied to them."""
    costs = [float(c) for c in (fp_costs or K.COST_GRID_FP)]
    frac = K.FN_LOSS_FRACTION if fn_loss_fraction is None else fn_loss_fraction
    fixed = K.FN_FIXED_COST if fn_fixed_cost is None else fn_fixed_cost
    n = with_score(df, score).agg(F.count(F.lit(1)).alias("n"))
    curve = threshold_curve(df, y, score, amount, fp_unit_cost=0.0, fn_loss_fraction=frac,
                            fn_fixed_cost=fixed)
    per = (curve.withColumn("fp_unit_cost", F.explode(F.array(*[F.lit(c) for c in costs])))
                .withColumn("total_cost", F.col("fn_cost") + F.col("fp") * F.col("fp_unit_cost")))
    best = best_threshold(per, keys=["fp_unit_cost"])
    chosen = per.join(best.select("fp_unit_cost", "threshold"), ["fp_unit_cost", "threshold"])
    out = _join_on(chosen, n, [])
    z = F.lit(0.0)
    return out.select("fp_unit_cost", "threshold",
                      F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), z).alias("recall"),
                      F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), z).alias("precision"),
                      (F.col("total_cost") / F.col("n") * 1_000_000).alias("cost_per_million"))


def exact_quantiles(df: DataFrame, col: str, qs: list[float], buckets: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (numpy's default), computed
    by rank: distinct values with counts, two-level prefix counts, then the
    values at the needed ranks (a bounded table of 2 x len(qs) rows)."""
    spark = df.sparkSession
    d = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).cast("double").alias("_v")).agg(
        F.count(F.lit(1)).alias("_c"))
    d = range_bucket(d, [F.col("_v").asc()], "_bk", buckets)
    n = d.agg(F.sum("_c").alias("n")).first()["n"] or 0
    if n == 0:
        return spark.createDataFrame([(float(q), None) for q in qs], "q double, value double")
    p = exclusive_prefix(d, [F.col("_v")], "_bk", {"_before": F.col("_c")})
    targets = []
    for q in qs:
        pos = (n - 1) * float(q)
        lo = int(pos // 1)
        hi = min(lo + 1, n - 1)
        targets.append((float(q), lo, hi, pos - lo))
    tdf = spark.createDataFrame(targets, "q double, r_lo long, r_hi long, frac double")
    ranks = tdf.select("q", F.col("r_lo").alias("r")).union(tdf.select("q", F.col("r_hi").alias("r"))).distinct()
    # bounded side (2 x len(qs) rows) broadcast; range condition on the rank interval
    hits = p.join(F.broadcast(ranks), (F.col("r") >= F.col("_before")) & (F.col("r") < F.col("_before") + F.col("_c")))
    vals = hits.select("r", "_v").distinct()
    lo_v = vals.select(F.col("r").alias("r_lo"), F.col("_v").alias("a"))
    hi_v = vals.select(F.col("r").alias("r_hi"), F.col("_v").alias("b"))
    out = F.broadcast(tdf).join(lo_v, "r_lo").join(hi_v, "r_hi")
    value = F.when(F.col("frac") >= 0.5, F.col("b") - (F.col("b") - F.col("a")) * (1 - F.col("frac"))) \
             .otherwise(F.col("a") + (F.col("b") - F.col("a")) * F.col("frac"))
    return out.select("q", value.alias("value"))


def reliability_table(df: DataFrame, y: str = "y", prob: str = "score", n_bins: int = 10) -> DataFrame:
    """Mean predicted vs observed rate per quantile bin; a row's bin is the
    number of interior quantile edges strictly below its probability; empty
    bins are absent, as are rows without a probability."""
    df = with_score(df, prob)
    qs = [i / n_bins for i in range(1, n_bins)]
    edges = exact_quantiles(df, prob, qs)
    arr = edges.agg(F.array_sort(F.collect_list("value")).alias("_edges"))  # n_bins - 1 values
    d = _join_on(df, F.broadcast(arr), [])
    b = F.size(F.filter(F.col("_edges"), lambda e: e < F.col(prob).cast("double")))
    return (d.withColumn("bin", b).groupBy("bin")
             .agg(F.avg(F.col(prob).cast("double")).alias("predicted"),
                  F.avg(F.col(y).cast("double")).alias("actual"),
                  F.count(F.lit(1)).alias("n")))


def band_distribution(df: DataFrame, prob: str = "score", y: str | None = "y") -> DataFrame:
    """Counts, share and fraud rate per advisory band of the rows with a
    probability; empty bands kept."""
    spark = df.sparkSession
    df = with_score(df, prob)
    bands = spark.createDataFrame([(name, i) for i, (_, name) in enumerate(K.RISK_BANDS)],
                                  "band string, band_order int")
    aggs = [F.count(F.lit(1)).alias("_c")]
    if y:
        aggs.append(F.sum(F.col(y).cast("long")).alias("_pos"))
    g = df.withColumn("band", risk_band(F.col(prob).cast("double"))).groupBy("band").agg(*aggs)
    total = df.agg(F.count(F.lit(1)).alias("_n"))
    # four bands: a fixed-size table
    out = _join_on(F.broadcast(bands).join(g, "band", "left"), total, [])
    cnt = F.coalesce(F.col("_c"), F.lit(0)).cast("bigint")
    cols = ["band", "band_order", cnt.alias("count"),
            F.coalesce(F.try_divide(cnt * 100.0, F.col("_n")), F.lit(0.0)).alias("pct")]
    if y:
        cols += [F.when(cnt > 0, F.col("_pos") * 100.0 / cnt).alias("fraud_rate_pct"),
                 F.when(cnt > 0, F.col("_pos")).alias("fraud_caught")]
    return out.select(*cols)
