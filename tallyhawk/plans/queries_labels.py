"""Label queries: flag history, chargebacks, label precedence and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyhawk.operators import label_state as LS
from tallyhawk.operators import labels as LB
from tallyhawk.plans.catalog import ORACLE, query, ts_sql, ts_text
from tallyhawk.plans.oracle_views import CUTOFF, with_views
from tallyhawk.plans.sql_blocks import LABEL_CTES, labels_over
from tallyhawk.session import scratch_path
from tallyhawk.sources import fixtures as FX

LBL = with_views("transfers_o", "flags", "chargebacks_raw", extra=LABEL_CTES)
CUT = f"(select * from transfers_o where txn_ts < timestamp '{CUTOFF}')"


def _parsed(spark, sf_dir):
    return LB.parse_chargebacks(FX.chargebacks_raw(spark, sf_dir), FX.FIXTURE_SALT)


def _matched(spark, sf_dir, transfers=None):
    t = transfers if transfers is not None else FX.transfer_table(spark, sf_dir)
    return LB.match_to_transfers(_parsed(spark, sf_dir), t)


@query("latest_flag_verdict", LBL + f"""
select _id, label, case when label = 1 then 'confirmed_fraud_upheld' else 'confirmed_legit_reviewed' end as label_source,
       {ts_sql('verdict_date')} as verdict_date
from latest""")
def latest_flag_verdict(spark, sf_dir):
    r = LB.latest_flag_verdict(FX.flags(spark, sf_dir))
    return r.withColumn("verdict_date", ts_text("verdict_date"))


@query("flag_history_checks", with_views("flags") + """
select count(*) as flag_rows, count(*) filter (where transfer is null) as null_transfer,
       count(*) filter (where action is not null and action not in ('flag', 'unflag')) as unexpected_action,
       count(*) filter (where action is not null and flag_ts is null) as undated
from flags""")
def flag_history_checks(spark, sf_dir):
    return LB.flag_history_checks(FX.flags(spark, sf_dir))


@query("flag_history_audit", with_views("flags") + """
select count(*) as transfers_with_flag_history, count(*) filter (where n > 1) as transfers_with_multiple_events
from (select transfer, count(*) as n from flags group by transfer) x""")
def flag_history_audit(spark, sf_dir):
    return LB.flag_history_audit(FX.flags(spark, sf_dir))


@query("pseudonymise_keys", LBL + """
select _id, partner_reference, partner_txn_id from tk""")
def pseudonymise_keys(spark, sf_dir):
    return FX.transfer_table(spark, sf_dir).select("_id", "partner_reference", "partner_txn_id")


@query("fraud_typology", LBL + """
select observations, fraud_type from cb""")
def fraud_typology(spark, sf_dir):
    return _parsed(spark, sf_dir).select("observations", "fraud_type")


@query("chargeback_amount", LBL + """
select amount, chargeback_amount from cb""")
def chargeback_amount(spark, sf_dir):
    return _parsed(spark, sf_dir).select("amount", "chargeback_amount")


@query("chargeback_unresolved", LBL + """
select amount, observations from cb where partner_reference is null and partner_txn_id is null""")
def chargeback_unresolved(spark, sf_dir):
    p = _parsed(spark, sf_dir)
    return p.filter(F.col("partner_reference").isNull() & F.col("partner_txn_id").isNull()).select("amount", "observations")


@query("chargeback_match", LBL + f"""
select partner_reference, partner_txn_id, {ts_sql('confirmed_date')} as confirmed_date,
       chargeback_amount, fraud_type, _id
from cbm""")
def chargeback_match(spark, sf_dir):
    m = _matched(spark, sf_dir)
    return m.select("partner_reference", "partner_txn_id", ts_text("confirmed_date").alias("confirmed_date"),
                    "chargeback_amount", "fraud_type", "_id")


@query("chargeback_match_rate", LBL + """
select count(*) as chargebacks, count(_id) as matched,
       round(coalesce(count(_id) * 100.0 / nullif(count(*), 0), 0), 6) as match_pct,
       coalesce(count(_id) * 100.0 / nullif(count(*), 0), 0) < 90 as low_match_warning
from cbm""")
def chargeback_match_rate(spark, sf_dir):
    r = LB.chargeback_match_rate(_matched(spark, sf_dir))
    return r.withColumn("match_pct", F.round("match_pct", 6))


@query("typology_mix", LBL + "select fraud_type, count(*) as n from cb group by fraud_type")
def typology_mix(spark, sf_dir):
    return LB.typology_mix(_parsed(spark, sf_dir))


def _details(spark, sf_dir, transfers=None):
    t = transfers if transfers is not None else FX.transfer_table(spark, sf_dir)
    return LB.label_details(FX.flags(spark, sf_dir), t, _matched(spark, sf_dir, t))


@query("build_labels", LBL + f"""
select _id, label, label_source, {ts_sql('verdict_date')} as verdict_date from labels""")
def build_labels(spark, sf_dir):
    d = _details(spark, sf_dir).drop("verdict_label")
    return d.withColumn("verdict_date", ts_text("verdict_date"))


@query("label_audit", LBL + """
select count(*) as total_transfers,
       count(*) filter (where label_source = 'confirmed_fraud_chargeback') as confirmed_fraud_chargeback,
       count(*) filter (where label_source = 'confirmed_fraud_upheld') as confirmed_fraud_upheld,
       count(*) filter (where label_source = 'confirmed_legit_reviewed') as confirmed_legit_reviewed,
       count(*) filter (where label_source = 'assumed_legit_never_flagged') as assumed_legit_never_flagged,
       count(*) filter (where label_source = 'confirmed_fraud_chargeback' and verdict_label = 0) as chargebacks_overriding_a_clear,
       round(avg(cast(label as double)), 6) as fraud_rate,
       round(avg(cast(label_source <> 'assumed_legit_never_flagged' as double)), 6) as coverage
from labels""")
def label_audit(spark, sf_dir):
    r = LB.label_audit(_details(spark, sf_dir))
    return r.withColumns({"fraud_rate": F.round("fraud_rate", 6), "coverage": F.round("coverage", 6)})


@query("orphan_flags", LBL + f"""
select _id from latest where _id not in (select _id from {CUT} c)""")
def orphan_flags(spark, sf_dir):
    latest = LB.latest_flag_verdict(FX.flags(spark, sf_dir))
    return LB.orphan_flags(latest, FX.exported_transfers(spark, sf_dir))


@query("chargeback_hits", LBL + """
select _id from transfers_o where _id in (select _id from cbm where _id is not null)""")
def chargeback_hits(spark, sf_dir):
    return LB.chargeback_hits(FX.transfers_o(spark, sf_dir), _matched(spark, sf_dir))


@query("unmatched_chargebacks", LBL + f"""
select distinct _id from cbm where _id is not null and _id not in (select _id from {CUT} c)""")
def unmatched_chargebacks(spark, sf_dir):
    return LB.unmatched_chargebacks(_matched(spark, sf_dir), FX.exported_transfers(spark, sf_dir))


@query("label_source_crosstab", LBL + """
select label_source, count(*) filter (where label = 0) as label_0, count(*) filter (where label = 1) as label_1,
       (count(*) filter (where label = 0) > 0)::int + (count(*) filter (where label = 1) > 0)::int = 1 as one_to_one
from labels group by label_source""")
def label_source_crosstab(spark, sf_dir):
    d = _details(spark, sf_dir)
    x = d.groupBy("label_source").agg(F.count_if(F.col("label") == 0).alias("label_0"),
                                      F.count_if(F.col("label") == 1).alias("label_1"))
    return x.withColumn("one_to_one", ((F.col("label_0") > 0).cast("int") + (F.col("label_1") > 0).cast("int")) == 1)


# --- labels kept by batches that come late and twice: the same tables as from whole histories

def _by_batches(spark, sf_dir):
    state = LS.LabelState(spark, scratch_path(spark, "label-state"))
    flags, cb = FX.flags(spark, sf_dir), _parsed(spark, sf_dir)
    late = F.col("flag_ts") >= F.lit("1996-01-01").cast("timestamp")
    early = F.col("flag_ts") < F.lit("1994-01-01").cast("timestamp")
    by_key = F.col("partner_reference").isNotNull()
    state.add_flags(flags.filter(late), "flags-3")
    state.add_chargebacks(cb.filter(by_key), "sheet-1")
    state.add_flags(flags.filter(early), "flags-1")
    state.add_flags(flags.filter(late), "flags-3")
    state.add_chargebacks(cb.filter(~by_key), "sheet-2")
    state.add_flags(flags.filter(~F.coalesce(late | early, F.lit(False))), "flags-2")
    state.add_chargebacks(cb.filter(by_key), "sheet-1")
    return state


@query("incremental_labels", ORACLE["build_labels"])
def incremental_labels(spark, sf_dir):
    d = _by_batches(spark, sf_dir).labels(FX.transfer_table(spark, sf_dir))
    return d.withColumn("verdict_date", ts_text("verdict_date"))


@query("incremental_label_audit", ORACLE["label_audit"])
def incremental_label_audit(spark, sf_dir):
    r = LB.label_audit(_by_batches(spark, sf_dir).details(FX.transfer_table(spark, sf_dir)))
    return r.withColumns({"fraud_rate": F.round("fraud_rate", 6), "coverage": F.round("coverage", 6)})


@query("incremental_flag_audit", ORACLE["flag_history_audit"])
def incremental_flag_audit(spark, sf_dir):
    return _by_batches(spark, sf_dir).audit()
