"""Evaluation and money-model queries on the scored population, plus the
cost-model and preset queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyhawk import contract as K
from tallyhawk.functions.columns import risk_band
from tallyhawk.operators import metrics as M
from tallyhawk.operators import policy as P
from tallyhawk.plans.catalog import ORACLE, query
from tallyhawk.plans.oracle_views import with_views
from tallyhawk.sources import fixtures as FX

SC = with_views("scored")
T = 0.5


def _scored(spark, sf_dir):
    return FX.scored(spark, sf_dir)


def _r(df, cols, nd=6):
    return df.withColumns({c: F.round(c, nd) for c in cols})


S_DISTINCT = """
, s as (select score, cast(sum(y) as bigint) as pos, cast(sum(1 - y) as bigint) as neg
        from scored where score is not null group by score)"""

AUROC_SQL = SC + S_DISTINCT + """
, c as (select *, coalesce(sum(neg) over (order by score rows between unbounded preceding and 1 preceding), 0) as neg_below from s)
select case when sum(pos) > 0 and sum(neg) > 0
            then round(sum(pos * (neg_below + 0.5 * neg)) / (sum(pos) * sum(neg)), 6) end as auroc
from c"""


@query("auroc", AUROC_SQL)
def auroc(spark, sf_dir):
    r = M.ranking_metrics(_scored(spark, sf_dir))
    return r.select(F.round("AUROC", 6).alias("auroc"))


AP_SQL = SC + S_DISTINCT + """
, c as (select *, sum(pos) over (order by score desc rows between unbounded preceding and current row) as tp,
               sum(neg) over (order by score desc rows between unbounded preceding and current row) as fp from s)
select case when sum(pos) > 0 and sum(neg) > 0 then round(sum(pos * tp / (tp + fp)) / sum(pos), 6) end as average_precision,
       round(sum(pos) / (sum(pos) + sum(neg)), 6) as pr_auc_baseline
from c"""


@query("average_precision", AP_SQL)
def average_precision(spark, sf_dir):
    r = M.ranking_metrics(_scored(spark, sf_dir))
    return r.select(F.round("PR_AUC", 6).alias("average_precision"),
                    F.round("pr_auc_baseline", 6).alias("pr_auc_baseline"))


def _threshold_sql(src: str, t: float, keys: str = "") -> str:
    kc = f"{keys}, " if keys else ""
    gb = f"group by {keys}" if keys else ""
    return f"""
select {kc}cast({t} as double) as threshold,
       round(coalesce(tp / nullif(tp + fp, 0), 0), 6) as precision,
       round(coalesce(tp / nullif(tp + fn, 0), 0), 6) as recall,
       round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) as f1,
       tp, fp, fn, tn,
       round(coalesce((tp + fp) / nullif(tp + fp + fn + tn, 0), 0), 6) as flag_rate,
       round(coalesce(fp / nullif(fp + tn, 0), 0), 6) as false_positive_rate
from (select {kc}count(*) filter (where y = 1 and score >= {t}) as tp,
             count(*) filter (where y = 0 and score >= {t}) as fp,
             count(*) filter (where y = 1 and score < {t}) as fn,
             count(*) filter (where y = 0 and score < {t}) as tn
      from {src} {gb}) x"""


THRESH_COLS = ["precision", "recall", "f1", "flag_rate", "false_positive_rate"]


@query("threshold_metrics", SC + _threshold_sql("scored", T))
def threshold_metrics(spark, sf_dir):
    return _r(M.threshold_metrics(_scored(spark, sf_dir), T), THRESH_COLS)


def _cost_sql(src: str, t: float, fp_each: str = "25.0", frac: float = 1.0, fixed: float = 0.0,
              keys: str = "") -> str:
    kc = f"{keys}, " if keys else ""
    gb = f"group by {keys}" if keys else ""
    return f"""
select {kc}round(fn_amt * {frac} + n_missed_fraud * {fixed}, 2) as fn_cost, round(fp_cost, 2) as fp_cost,
       round(fn_amt * {frac} + n_missed_fraud * {fixed} + fp_cost, 2) as total_cost,
       round((fn_amt * {frac} + n_missed_fraud * {fixed} + fp_cost) / n * 1000000, 2) as cost_per_million,
       n_missed_fraud, n_false_declines
from (select {kc}coalesce(sum(case when y = 1 and score < {t} then coalesce(amount, 0) else 0 end), 0) as fn_amt,
             count(*) filter (where y = 1 and score < {t}) as n_missed_fraud,
             coalesce(sum(case when y = 0 and score >= {t} then {fp_each} else 0 end), 0) as fp_cost,
             count(*) filter (where y = 0 and score >= {t}) as n_false_declines,
             count(*) as n
      from {src} {gb}) x"""


COST_COLS = ["fn_cost", "fp_cost", "total_cost", "cost_per_million"]


@query("money_cost", SC + _cost_sql("scored", T))
def money_cost(spark, sf_dir):
    return _r(M.cost(_scored(spark, sf_dir), T), COST_COLS, 2)


GRID = "(select cast(range as double) / 100 as threshold from range(1, 100))"


def _curve_sql(fp_each: str = "25.0") -> str:
    return f"""
, g as {GRID}
, curve as (
select g.threshold,
       coalesce(sum(case when s.y = 1 and s.score < g.threshold then coalesce(s.amount, 0) else 0 end), 0) as fn_cost,
       coalesce(sum(case when s.y = 0 and s.score >= g.threshold then {fp_each} else 0 end), 0) as fp_cost,
       count(*) filter (where s.y = 1 and s.score >= g.threshold) as tp,
       count(*) filter (where s.y = 0 and s.score >= g.threshold) as fp,
       count(*) filter (where s.y = 1 and s.score < g.threshold) as fn,
       count(*) filter (where s.y = 0 and s.score < g.threshold) as tn
from g, scored s group by g.threshold)"""


@query("threshold_curve", SC + _curve_sql() + """
select threshold, round(fn_cost, 2) as fn_cost, round(fp_cost, 2) as fp_cost,
       round(fn_cost + fp_cost, 2) as total_cost, tp, fp, fn, tn from curve""")
def threshold_curve(spark, sf_dir, scored=_scored):
    c = M.threshold_curve(scored(spark, sf_dir))
    return _r(c, ["fn_cost", "fp_cost", "total_cost"], 2)


@query("best_threshold", SC + _curve_sql() + """
select threshold, round(fn_cost + fp_cost, 2) as total_cost
from (select *, row_number() over (order by fn_cost + fp_cost, threshold) as rn from curve) x where rn = 1""")
def best_threshold(spark, sf_dir):
    b = M.best_threshold(M.threshold_curve(_scored(spark, sf_dir)))
    return _r(b, ["total_cost"], 2)


EVAL_COLS = ["auroc", "pr_auc", "pr_auc_baseline"]


def _eval_select(ev):
    ev = ev.withColumnsRenamed({"AUROC": "auroc", "PR_AUC": "pr_auc"})
    ev = _r(ev, EVAL_COLS + THRESH_COLS)
    return _r(ev, COST_COLS, 2)


@query("evaluate", SC + S_DISTINCT + """
, c as (select *, coalesce(sum(neg) over (order by score rows between unbounded preceding and 1 preceding), 0) as neg_below,
               sum(pos) over (order by score desc rows between unbounded preceding and current row) as tp_ge,
               sum(neg) over (order by score desc rows between unbounded preceding and current row) as fp_ge from s)
, r as (select case when sum(pos) > 0 and sum(neg) > 0 then round(sum(pos * (neg_below + 0.5 * neg)) / (sum(pos) * sum(neg)), 6) end as auroc,
               case when sum(pos) > 0 and sum(neg) > 0 then round(sum(pos * tp_ge / (tp_ge + fp_ge)) / sum(pos), 6) end as pr_auc,
               round(sum(pos) / (sum(pos) + sum(neg)), 6) as pr_auc_baseline from c)
, t as (""" + _threshold_sql("scored", T) + """)
, k as (""" + _cost_sql("scored", T) + """)
select * from r, t, k""")
def evaluate(spark, sf_dir, scored=_scored):
    return _eval_select(M.evaluate(scored(spark, sf_dir), T))


def _configs(spark, sf_dir, scored):
    s = scored(spark, sf_dir)
    rules = F.when(F.col("segment").isin("1", "2"), F.lit(1.0)).otherwise(F.lit(0.0))
    cfg = F.explode(F.array(F.struct(F.lit("model").alias("config"), F.col("score").alias("s")),
                            F.struct(F.lit("rules").alias("config"), rules.alias("s"))))
    return s.select("y", "amount", cfg.alias("_c")).select("y", "amount", "_c.config", F.col("_c.s").alias("score"))


CONFIGS_VIEW = """
, long as (select 'model' as config, y, amount, score from scored
           union all
           select 'rules' as config, y, amount, case when segment in ('1', '2') then 1.0 else 0.0 end as score from scored)"""


def _keyed_ranking_sql(src: str, key: str) -> str:
    return f"""
select {key},
       case when sum(pos) > 0 and sum(neg) > 0 then round(sum(pos * (neg_below + 0.5 * neg)) / (sum(pos) * sum(neg)), 6) end as auroc,
       case when sum(pos) > 0 and sum(neg) > 0 then round(sum(pos * tp_ge / (tp_ge + fp_ge)) / sum(pos), 6) end as pr_auc
from (select *, coalesce(sum(neg) over (partition by {key} order by score rows between unbounded preceding and 1 preceding), 0) as neg_below,
             sum(pos) over (partition by {key} order by score desc rows between unbounded preceding and current row) as tp_ge,
             sum(neg) over (partition by {key} order by score desc rows between unbounded preceding and current row) as fp_ge
      from (select {key}, score, cast(sum(y) as bigint) as pos, cast(sum(1 - y) as bigint) as neg
            from {src} where score is not null group by {key}, score) d) c
group by {key}"""


@query("compare_configs", SC + CONFIGS_VIEW + f"""
, r as ({_keyed_ranking_sql('long', 'config')})
, t as ({_threshold_sql('long', T, 'config')})
, k as ({_cost_sql('long', T, keys='config')})
select r.config, r.auroc, r.pr_auc, t.recall, t.precision, t.false_positive_rate,
       k.n_missed_fraud, k.n_false_declines, k.cost_per_million
from r join t on r.config = t.config join k on k.config = r.config""")
def compare_configs(spark, sf_dir, scored=_scored):
    ev = _eval_select(M.evaluate(_configs(spark, sf_dir, scored), T, keys=["config"]))
    return ev.select("config", "auroc", "pr_auc", "recall", "precision", "false_positive_rate",
                     "n_missed_fraud", "n_false_declines", "cost_per_million")


@query("segment_metrics", SC + """
, seg as (select coalesce(segment, '(missing)') as segment, y, score, amount from scored)
, sizes as (select segment, count(*) as n, round(avg(cast(y as double)), 6) as fraud_rate from seg group by segment having count(*) >= 30)
, big as (select * from seg where segment in (select segment from sizes))""" + f"""
, r as ({_keyed_ranking_sql('big', 'segment')})
, t as ({_threshold_sql('big', T, 'segment')})
, k as ({_cost_sql('big', T, keys='segment')})
select sizes.segment, sizes.n, sizes.fraud_rate, r.auroc, r.pr_auc, t.recall, t.precision, k.cost_per_million
from sizes join r on r.segment = sizes.segment join t on t.segment = sizes.segment join k on k.segment = sizes.segment""")
def segment_metrics(spark, sf_dir, scored=_scored):
    s = M.segment_metrics(scored(spark, sf_dir), T, min_n=30)
    s = s.withColumnsRenamed({"AUROC": "auroc", "PR_AUC": "pr_auc"})
    return _r(_r(s, ["fraud_rate", "auroc", "pr_auc", "recall", "precision"]), ["cost_per_million"], 2)


_costs = ", ".join(f"{float(c)}" for c in K.COST_GRID_FP)


@query("cost_grid", SC + _curve_sql("0.0") + f"""
, costs as (select unnest([{_costs}]) as fp_unit_cost)
, per as (select fp_unit_cost, curve.*, fn_cost + fp * fp_unit_cost as total from costs, curve)
, best as (select *, row_number() over (partition by fp_unit_cost order by total, threshold) as rn from per)
select fp_unit_cost, threshold, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) as recall,
       round(coalesce(tp / nullif(tp + fp, 0), 0), 6) as precision,
       round(total / (select count(*) from scored) * 1000000, 2) as cost_per_million
from best where rn = 1""")
def cost_grid(spark, sf_dir, scored=_scored):
    g = M.cost_grid(scored(spark, sf_dir))
    return _r(_r(g, ["recall", "precision"]), ["cost_per_million"], 2)


@query("reliability_table", SC + """
, e as (select quantile_cont(score, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) as edges from scored)
select cast(len(list_filter(e.edges, lambda x: x < s.score)) as bigint) as bin,
       round(avg(s.score), 6) as predicted, round(avg(cast(s.y as double)), 6) as actual, count(*) as n
from scored s, e group by 1""")
def reliability_table(spark, sf_dir, scored=_scored):
    r = M.reliability_table(scored(spark, sf_dir), n_bins=10)
    return _r(r.withColumn("bin", F.col("bin").cast("bigint")), ["predicted", "actual"])


BAND_CASE = ("case when score >= 0.85 then 'Critical' when score >= 0.5 then 'High' "
             "when score >= 0.15 then 'Elevated' else 'Low' end")


@query("band_distribution", SC + f"""
, b as (select * from (values ('Critical', 0), ('High', 1), ('Elevated', 2), ('Low', 3)) t(band, band_order))
, g as (select {BAND_CASE} as band, count(*) as c, cast(sum(y) as bigint) as pos from scored group by 1)
, n as (select count(*) as n from scored)
select b.band, b.band_order, coalesce(g.c, 0) as count, round(coalesce(g.c, 0) * 100.0 / n.n, 6) as pct,
       round(case when g.c > 0 then g.pos * 100.0 / g.c end, 6) as fraud_rate_pct,
       case when g.c > 0 then g.pos end as fraud_caught
from b left join g on g.band = b.band, n""")
def band_distribution(spark, sf_dir, scored=_scored):
    return _r(M.band_distribution(scored(spark, sf_dir)), ["pct", "fraud_rate_pct"])


@query("risk_band", SC + f"select id, {BAND_CASE} as risk_band from scored")
def risk_band_q(spark, sf_dir):
    s = _scored(spark, sf_dir)
    return s.select("id", risk_band("score").alias("risk_band"))


FP_SQL = "15.0 + coalesce(transfer_fee, 0) + 0.05 * coalesce(send_amount, 0) * 1.0 * 12.0"


@query("fp_cost", with_views("transfers_o") + f"select _id, round({FP_SQL}, 6) as fp_cost from transfers_o")
def fp_cost(spark, sf_dir):
    t = FX.transfer_table(spark, sf_dir)
    return t.select("_id", F.round(P.FalsePositiveCost().of(t), 6).alias("fp_cost"))


@query("fp_cost_by_preset", with_views("transfers_o") + "select _id, " + ", ".join(
    f"round(({FP_SQL}) * {m}, 6) as fp_cost_{n}" for n, m in K.PRESETS) + " from transfers_o")
def fp_cost_by_preset(spark, sf_dir):
    t = P.fp_costs_by_preset(FX.transfer_table(spark, sf_dir))
    cols = [f"fp_cost_{n}" for n, _ in K.PRESETS]
    return _r(t.select("_id", *cols), cols)


def churn_sql(days: int) -> str:
    return SC + f"""
, h as (select *, count(*) over (partition by user_id order by epoch_us(cast(ts as timestamp))
                                 range between 1 following and {days} * 86400000000 following) as later
        from scored)
, a as (select count(*) as rows_n,
               count(*) filter (where y = 0 and segment = '3') as n_wrongful_blocks,
               avg(case when later = 0 then 1.0 else 0.0 end) filter (where y = 0 and segment = '3' and user_id is not null and ts is not null) as fp_quiet_rate,
               avg(case when later = 0 then 1.0 else 0.0 end) filter (where user_id is not null and ts is not null) as base_quiet_rate,
               greatest(floor((epoch_us(cast(max(ts) as timestamp)) - epoch_us(cast(min(ts) as timestamp))) / 86400000000), 1) as span_days,
               count(distinct user_id) as users
        from h)
select n_wrongful_blocks, round(fp_quiet_rate, 6) as fp_quiet_rate, round(base_quiet_rate, 6) as base_quiet_rate,
       round(case when n_wrongful_blocks >= 30 then least(greatest(0.0, fp_quiet_rate - base_quiet_rate), 0.5) else 0.05 end, 6) as churn_prob,
       round(case when n_wrongful_blocks >= 30 then greatest(rows_n / (span_days / 30.44) / users, 1.0) else 1.0 end, 6) as monthly_volume_multiple,
       12.0 as clv_months, 15.0 as ops_cost,
       case when n_wrongful_blocks >= 30 then 'measured' else 'defaults' end as source
from a"""


def _churn(spark, sf_dir, days):
    wrongful = (F.col("y") == 0) & (F.col("segment") == "3")
    r = P.churn_estimate(_scored(spark, sf_dir), wrongful, key="user_id", ts="ts", horizon_days=days)
    return _r(r, ["fp_quiet_rate", "base_quiet_rate", "churn_prob", "monthly_volume_multiple"])


@query("churn_estimate", churn_sql(1))
def churn_estimate(spark, sf_dir):
    return _churn(spark, sf_dir, 1)


@query("churn_estimate_90d", churn_sql(K.CHURN_HORIZON_DAYS))
def churn_estimate_90d(spark, sf_dir):
    """The default horizon."""
    return _churn(spark, sf_dir, K.CHURN_HORIZON_DAYS)


_preset_rows = ", ".join(f"('{n}', cast({m} as double), {i})" for i, (n, m) in enumerate(K.PRESETS))


@query("compare_presets", SC + f"""
, base as (select *, 15.0 + 0.05 * coalesce(amount, 0) * 1.0 * 12.0 as fpb from scored)
, g as {GRID}
, cnt as (select g.threshold,
                 coalesce(sum(case when s.y = 1 and s.score < g.threshold then coalesce(s.amount, 0) else 0 end), 0) as fn_amt,
                 coalesce(sum(case when s.y = 0 and s.score >= g.threshold then s.fpb else 0 end), 0) as fpb_sum,
                 count(*) filter (where s.y = 1 and s.score >= g.threshold) as tp,
                 count(*) filter (where s.y = 0 and s.score >= g.threshold) as fp,
                 count(*) filter (where s.y = 1 and s.score < g.threshold) as fn,
                 count(*) filter (where s.y = 0 and s.score < g.threshold) as tn
          from g, base s group by g.threshold)
, pr as (select * from (values {_preset_rows}) t(preset, multiplier, preset_order))
, per as (select pr.*, cnt.*, fn_amt + fpb_sum * multiplier as total from pr, cnt)
, best as (select *, row_number() over (partition by preset order by total, threshold) as rn from per)
select preset, preset_order, multiplier, round(threshold, 3) as threshold,
       round(coalesce(tp / nullif(tp + fn, 0), 0), 6) as recall,
       round(coalesce(tp / nullif(tp + fp, 0), 0), 6) as precision,
       round(coalesce(fp / nullif(fp + tn, 0), 0), 6) as false_positive_rate,
       round((tp + fp) * 100.0 / (tp + fp + fn + tn), 6) as flagged_pct,
       fn as missed_fraud, fp as false_declines,
       round(total / (tp + fp + fn + tn) * 1000000, 2) as cost_per_million
from best where rn = 1""")
def compare_presets(spark, sf_dir):
    s = _scored(spark, sf_dir)
    s = s.withColumn("_fpb", P.FalsePositiveCost().of(s, amount="amount"))
    r = P.compare_presets(s, "_fpb")
    return _r(_r(r, ["recall", "precision", "false_positive_rate", "flagged_pct"]), ["cost_per_million"], 2)


# --- the same operators on a population with null and NaN scores: equal to dropping those rows first
GAPS = with_views("scored_gaps", extra={"scored": "select * from scored_gaps where score is not null and not isnan(score)"})


def _with_gaps(name: str, fn) -> None:
    sql = ORACLE[name].removeprefix(SC)
    if name == "compare_configs":  # the rules score every row
        sql = sql.replace("as score from scored)", "as score from scored_gaps)")
    query(f"{name}_gaps", GAPS + sql)(lambda spark, sf_dir: fn(spark, sf_dir, FX.scored_gaps))


for _name, _fn in (("evaluate", evaluate), ("compare_configs", compare_configs), ("threshold_curve", threshold_curve),
                   ("segment_metrics", segment_metrics), ("cost_grid", cost_grid),
                   ("reliability_table", reliability_table), ("band_distribution", band_distribution)):
    _with_gaps(_name, _fn)


@query("risk_band_gaps", with_views("scored_gaps") + f"""
select id, case when score is null or isnan(score) then null else {BAND_CASE} end as risk_band from scored_gaps""")
def risk_band_gaps(spark, sf_dir):
    return FX.scored_gaps(spark, sf_dir).select("id", risk_band("score").alias("risk_band"))
