"""Training, scoring, explanation and streaming queries on the scored
population (features: amount, hour, segment, 24h velocity)."""

from __future__ import annotations

import functools
import hashlib
import json
import uuid

from pyspark.sql import functions as F

from tallyhawk import contract as K
from tallyhawk.functions.columns import hour_of
from tallyhawk.operators import bundle as BU
from tallyhawk.operators import contributions as CO
from tallyhawk.operators import policy as PO
from tallyhawk.operators import prep as PR
from tallyhawk.operators import scoring as SC
from tallyhawk.operators import search as SE
from tallyhawk.operators import training as TR
from tallyhawk.operators.features import add_velocity_features
from tallyhawk.plans.catalog import query
from tallyhawk.plans.oracle_views import with_views
from tallyhawk.plans.queries_features import training_table
from tallyhawk.plans.queries_sources import TOP_KEYS_SQL, docs
from tallyhawk.session import ensure_checkpoint_dir, materialize, passing, scratch_path, settled
from tallyhawk.sources import fixtures as FX

ID_COLUMNS = ["_id", "user_id", "recipient_id", "_t", "partner_reference", "partner_txn_id"]
FEATURES = ["amount", "hour", "segment_code", "user_id_txn_24h", "user_id_amt_24h"]


def ml_frame(spark, sf_dir):
    s = FX.scored(spark, sf_dir)
    s = add_velocity_features(s, key="user_id", time_col="ts", amount_col="amount", windows=(24,))
    return s.select("id", "ts", "y", "score", "amount", "segment", hour_of("ts").alias("hour"),
                    F.col("segment").cast("double").alias("segment_code"), "user_id_txn_24h", "user_id_amt_24h")


def ml_split(spark, sf_dir):
    """The split frame, fixed once: every fit and every evaluation reads it."""
    return materialize(PR.temporal_split(ml_frame(spark, sf_dir), time_col="ts", id_col="id"))


def training_rows(spark, sf_dir):
    """A function that gives the raw training table, assembled and fixed the first time it is asked."""
    return functools.cache(lambda: settled(spark, lambda: training_table(spark, sf_dir, keep_ids=True)))


def training_matrix(spark, sf_dir, rows):
    """(matrix, features, state): the assembled training table (``rows()``) split,
    encoded by its train part and fixed once; a missing value is its own level."""
    state, m = PR.prepare_matrix(rows(), exclude=ID_COLUMNS, time_col="_t", fixed=True)
    return materialize(TR.filled(m, state.feature_cols)), state.feature_cols, state


def _spw(split_df):
    return float(PR.class_weight(split_df.filter(F.col("split") == "train"), "y").first()["scale_pos_weight"])


@query("train_gbt")
def train_gbt(spark, sf_dir):
    s = ml_split(spark, sf_dir)
    m = TR.gbt(FEATURES).fit(TR.fit_frame(s, _spw(s)))
    return TR.raw_scores(m, s.filter(F.col("split") == "val"), ["id", "y"])


@query("train_challenger")
def train_challenger(spark, sf_dir):
    s = ml_split(spark, sf_dir)
    f = TR.fit_frame(s, _spw(s)).filter(~F.col("is_val"))
    m = TR.forest(FEATURES).fit(f)
    return TR.raw_scores(m, s.filter(F.col("split") == "val"), ["id", "y"])


@query("tune_grid")
def tune_grid(spark, sf_dir):
    s = ml_split(spark, sf_dir)
    rows = TR.tune_grid(s, FEATURES, _spw(s))
    return spark.createDataFrame([(r["max_depth"], r["step_size"], r["val_pr_auc"]) for r in rows],
                                 "max_depth int, step_size double, val_pr_auc double")


@query("select_model")
def select_model(spark, sf_dir):
    s = ml_split(spark, sf_dir)
    r = TR.train_report(s, FEATURES, _spw(s), keep=["id"], tune=False)
    return spark.createDataFrame([(n, ap, n == r.winner) for n, ap in r.candidates.items()],
                                 "model string, val_pr_auc double, winner boolean")


@query("calibrate_isotonic")
def calibrate_isotonic(spark, sf_dir):
    s = ml_split(spark, sf_dir)
    m = TR.gbt(FEATURES).fit(TR.fit_frame(s, _spw(s)))
    cal = TR.calibrate(m, s)
    return TR.calibrated(m, cal, s.filter(F.col("split") == "test"), ["id", "y"])


@query("tune_search", f"select {SE.TRIALS} as first_rung, 7 as second_rung, 3 as last_rung, true as scores_in_range, true as winner_is_best")
def tune_search(spark, sf_dir):
    """Successive halving over the random space; a search that is run again reads its table."""
    s = ml_split(spark, sf_dir)
    best, trials = SE.search(s, FEATURES, _spw(s), scratch_path(spark, "search"))
    last = trials.where(F.col("rung") == 2)
    top = last.agg(F.max_by("params", F.struct("val_pr_auc", -F.col("trial")))).first()[0]
    rungs = [F.count_if(F.col("rung") == n).alias(c) for n, c in enumerate(("first_rung", "second_rung", "last_rung"))]
    return trials.agg(*rungs, F.bool_and(F.col("val_pr_auc").between(0, 1)).alias("scores_in_range"),
                      F.lit(json.loads(top) == best).alias("winner_is_best"))


def train_bundle(spark, sf_dir, path, trials=0, rows=None):
    """The whole run on the training table, with the cost of a wrongful block
    measured from history. What scoring needs is written as the next bundle
    under ``path``, reliability and cost grid of the test part beside it. With
    ``trials`` a search of as many takes the place of the grid; a run that was
    killed goes on with it. ``rows``: see :func:`training_rows`; who goes on with
    the same table passes it, so that it is assembled once."""
    with passing(spark):  # the matrix is needed no longer when the bundle is written; the rows stay
        m, features, state = training_matrix(spark, sf_dir, rows or training_rows(spark, sf_dir))
        history = FX.scored(spark, sf_dir)
        churn = PO.churn_estimate(history, (F.col("y") == 0) & (F.col("score") >= 0.5))
        cost = PO.FalsePositiveCost.measured(churn)
        m = m.withColumn("fp_cost", cost.of(m, amount="amount"))
        found = SE.search(m, features, _spw(m), f"{path}/searches", trials)[0] if trials else None
        r = TR.train_report(m, features, _spw(m), keep=["_id"], fp_unit_cost="fp_cost", params=found)
        report = materialize(r.report, stays=True)
        kept = BU.Bundle(r.model, r.calibrator, state, features, r.threshold, {"winner": r.winner, **r.params},
                         {**r.candidates, **{k: report.first()[k] for k in ("AUROC", "PR_AUC", "recall", "precision", "cost_per_million")}})
        version = BU.save(spark, path, kept)
        reports = f"{path}/reports/{version}-{uuid.uuid4().hex[:8]}"
        r.reliability.write.parquet(f"{reports}/reliability")
        r.cost_grid.write.parquet(f"{reports}/cost_grid")
    return report


def bundle_folder(spark, sf_dir):
    """Where the bundles of a data set lie, in the folder that all share."""
    name = hashlib.sha256(sf_dir.rstrip("/").encode()).hexdigest()[:16]
    return f"{ensure_checkpoint_dir(spark)}/bundles/{name}"


def bundle_of(spark, sf_dir, rows=None):
    """The latest bundle of a data set; trained only where there is none yet."""
    path = bundle_folder(spark, sf_dir)
    if not BU.versions(spark, path):
        train_bundle(spark, sf_dir, path, rows=rows)
    return BU.load(spark, path)


def bundle_and_rows(spark, sf_dir):
    """The latest bundle and the raw training rows, which are those it was
    trained from where it had to be trained."""
    asked = []
    fixed = training_rows(spark, sf_dir)

    def rows():
        asked.append(True)
        return fixed()
    b = bundle_of(spark, sf_dir, rows)
    return b, fixed() if asked else training_table(spark, sf_dir, keep_ids=True)


@query("train_report")
def train_report(spark, sf_dir):
    return train_bundle(spark, sf_dir, bundle_folder(spark, sf_dir))


@query("score_table")
def score_table(spark, sf_dir):
    """Every raw row of the training table, scored from the bundle."""
    b, rows = bundle_and_rows(spark, sf_dir)
    return b.score(rows, keep=["_id"])


@query("score_bundle", with_views("transfers_o") + """
select _id, true as in_range, true as band_fits, true as flag_fits, true as coverage_fits from transfers_o""")
def score_bundle(spark, sf_dir):
    """What must hold for every score, whatever was trained."""
    b, rows = bundle_and_rows(spark, sf_dir)
    s = b.score(rows, keep=["_id"])
    p = F.col("probability")
    band = F.when(p >= 0.85, "Critical").when(p >= 0.5, "High").when(p >= 0.15, "Elevated").otherwise("Low")
    return s.select("_id", p.between(0, 1).alias("in_range"), (F.col("risk_band") == band).alias("band_fits"),
                    (F.col("flagged") == (p >= b.threshold)).alias("flag_fits"),
                    ((F.col("features_expected") == len(b.features)) & F.col("features_provided").between(0, len(b.features))
                     & (F.col("low_coverage") == (F.col("features_provided") / len(b.features) < K.MIN_FEATURE_COVERAGE)))
                    .alias("coverage_fits"))


def _explained(spark, sf_dir):
    """(bundle, raw training rows encoded, their scores)."""
    b, rows = bundle_and_rows(spark, sf_dir)
    m = materialize(b.matrix(rows, keep=["_id"]))
    scored = SC.score_table(b.model, b.calibrator, m, b.features, keep=["_id"])
    return b, m, scored.select("_id", "probability", "risk_band")


@query("tree_contributions", with_views("transfers_o") + "select _id, true as adds_up from transfers_o")
def tree_contributions(spark, sf_dir):
    """Base value plus contributions is the raw margin of the model that scores, on every row."""
    b, m, scored = _explained(spark, sf_dir)
    raw = b.model.transform(TR.filled(m, b.features)).select("_id", CO.margin(b.model).alias("margin"))
    total = F.col("base_value") + F.aggregate("impacts", F.lit(0.0), lambda a, x: a + x)
    # summed up before the joins, which carry an id and a number
    rows = CO.contributions(b.model, m, b.features, keep=["_id"]).select("_id", total.alias("total")).join(scored.select("_id"), "_id")
    return rows.join(raw, "_id").select("_id", (F.abs(F.col("total") - F.col("margin")) < 1e-9).alias("adds_up"))


@query("explain_scores")
def explain_scores(spark, sf_dir):
    """Score, band, top factors and text of every row, from the contributions of the model that scored it."""
    b, m, scored = _explained(spark, sf_dir)
    values = {f: F.nullif(F.col(f).cast("double"), F.lit(TR.MISSING)) for f in b.features}
    factors = SC.risk_factor_array(CO.by_name(b.features), values, k=3)
    # ranked before the join, which carries the top factors instead of all contributions and features
    ranked = CO.contributions(b.model, m, b.features, keep=["_id", *b.features]).select("_id", factors.alias("factors"))
    return ranked.join(scored, "_id").select(
        "_id", "probability", "risk_band", "factors", SC.explain_text(F.col("probability"), F.col("factors")).alias("explanation"))


# --- explanations: linear contributions weight x (value - mean) ------------
# Weights of the additive fixture model (not a fitted model).
WEIGHTS = {"send_amount": ("amount", 0.02), "hour": ("hour", 0.05),
           "V_segment": ("segment_code", 0.1), "user_id_txn_24h": ("user_id_txn_24h", 0.3)}
VALUE_COL = {"send_amount": "amount", "hour": "hour", "V_segment": "segment", "user_id_txn_24h": "user_id_txn_24h"}


def _with_contributions(spark, sf_dir):
    f = ml_frame(spark, sf_dir)
    means = f.agg(*[F.avg(src).alias(f"_m_{src}") for src, _w in WEIGHTS.values()])
    # one-row table of means
    return f.withColumn("_one", F.lit(1)).join(F.broadcast(means.withColumn("_one", F.lit(1))), "_one")


def _contrib():
    return {name: F.lit(w) * (F.col(src) - F.col(f"_m_{src}")) for name, (src, w) in WEIGHTS.items()}


def _values():
    return {name: F.col(c) for name, c in VALUE_COL.items()}


def label_sql(x: str) -> str:
    cases = " ".join(f"when {x} = '{k}' then '{v}'" for k, v in K.FEATURE_LABELS.items())
    opaque = " or ".join(f"starts_with({x}, '{p}')" for p in K.OPAQUE_PREFIXES)
    base = f"regexp_replace({x}, '_FE$', '')"
    base_label = f"(case {' '.join(f'when {base} = {chr(39)}{k}{chr(39)} then {chr(39)}{v}{chr(39)}' for k, v in K.FEATURE_LABELS.items())} else {base} end)"
    spaced = f"replace({x}, '_', ' ')"
    return (f"(case {cases} when ends_with({x}, '_FE') then concat({base_label}, '{K.FE_LABEL_SUFFIX}') "
            f"when {opaque} then concat('{K.BEHAVIOURAL_PREFIX}', {x}) "
            f"else concat(upper(substr({spaced}, 1, 1)), lower(substr({spaced}, 2))) end)")


ML_VIEW = with_views("scored", extra={
    "v": """select *, count(amount) over (partition by user_id order by epoch_us(cast(ts as timestamp))
                   range between 86400000000 preceding and 1 preceding) as user_id_txn_24h from scored""",
    "b": "select id, ts, score, amount, segment, cast(segment as double) as segment_code, "
         "hour(ts) as hour, user_id_txn_24h from v",
    "m": "select avg(amount) as ma, avg(hour) as mh, avg(segment_code) as ms, avg(user_id_txn_24h) as mv from b",
    "lng": """
select id, 'send_amount' as feature, 0.02 * (amount - ma) as impact, cast(amount as varchar) as value, true as interp from b, m
union all select id, 'hour', 0.05 * (hour - mh), cast(hour as varchar), true from b, m
union all select id, 'V_segment', 0.1 * (segment_code - ms), segment, false from b, m
union all select id, 'user_id_txn_24h', 0.3 * (user_id_txn_24h - mv), cast(user_id_txn_24h as varchar), true from b, m""",
    "pos": """select *, row_number() over (partition by id order by impact desc, feature) as p from lng where impact > 0""",
    "rk": """select *, coalesce(sum(case when interp then 1 else 0 end) over (partition by id order by p
                    rows between unbounded preceding and 1 preceding), 0) as n_before from pos""",
    "hid": """select id, coalesce(sum(impact) filter (where not interp and n_before < 3), 0) as hidden from rk group by id""",
    "top": """select * from (select id, row_number() over (partition by id order by p) as rank, feature, value, impact
              from rk where interp) t where rank <= 3""",
})


@query("top_risk_factors", ML_VIEW + f"""
select t.id, cast(t.rank as int) as rank, t.feature, {label_sql('t.feature')} as label, t.value,
       round(t.impact, 6) as impact, round(h.hidden, 6) as hidden_signal_weight
from top t join hid h on h.id = t.id""")
def top_risk_factors(spark, sf_dir):
    d = _with_contributions(spark, sf_dir)
    r = SC.top_risk_factors(d, _contrib(), _values(), k=3, keep=["id"])
    return r.withColumns({"impact": F.round("impact", 6), "hidden_signal_weight": F.round("hidden_signal_weight", 6)})


BAND = ("case when score >= 0.85 then 'Critical' when score >= 0.5 then 'High' "
        "when score >= 0.15 then 'Elevated' else 'Low' end")


@query("explain_text", ML_VIEW + f"""
, f as (select t.id, string_agg(concat('  ', cast(t.rank as varchar), '. ', {label_sql('t.feature')},
                                       case when t.value is not null then concat(' — ', t.value) else '' end),
                                chr(10) order by t.rank) as lines, max(h.hidden) as hidden
        from top t join hid h on h.id = t.id group by t.id)
select b.id, concat({BAND.replace('score', 'b.score')}, ' risk (', printf('%.1f%%', b.score * 100), ')',
       case when f.id is not null then concat(chr(10), 'Main contributing factors:', chr(10), f.lines,
            case when f.hidden > 0 then concat(chr(10), '  (Additional behavioural signals also contributed.)') else '' end)
       else '' end) as explanation
from b left join f on f.id = b.id""")
def explain_text(spark, sf_dir):
    d = _with_contributions(spark, sf_dir)
    arr = SC.risk_factor_array(_contrib(), _values(), k=3)
    return d.select("id", SC.explain_text(F.col("score"), arr).alias("explanation"))


_FEATURES_SQL = "\nunion all\n".join(
    f"select '{k}' as feature from transfers_o having count(*) filter (where {c}) > 0\n"
    f"union all select '{k}_FE' from transfers_o having count(*) filter (where {c}) > 0"
    for k, c in TOP_KEYS_SQL.items())


@query("feature_labels", with_views("transfers_o", extra={"fs": _FEATURES_SQL}) + f"""
select feature, {label_sql('feature')} as label from fs""")
def feature_labels(spark, sf_dir):
    keys = docs(spark, sf_dir).select(F.explode(F.json_object_keys(F.to_json("doc"))).alias("k")).distinct()
    feats = keys.select(F.explode(F.array(F.col("k"), F.concat(F.col("k"), F.lit(K.FE_SUFFIX)))).alias("feature"))
    return feats.select("feature", SC.label_for(F.col("feature")).alias("label"))
