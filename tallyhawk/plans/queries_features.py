"""Feature queries: velocity, history, scalar derivations, enrichment and
the full training table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyhawk.operators import features as FT
from tallyhawk.operators import labels as LB
from tallyhawk.plans.catalog import query, ts_sql, ts_text
from tallyhawk.plans.oracle_views import with_views
from tallyhawk.plans.sql_blocks import ENRICHED, LABEL_CTES, days_sql, velocity_sql
from tallyhawk.sources import fixtures as FX


def _velocity(hours: int):
    def run(spark, sf_dir):
        t = FX.transfers_e(spark, sf_dir)
        out = FT.add_velocity_features(t, time_col="txn_ts", windows=(hours,))
        return out.select("_id", f"user_id_txn_{hours}h",
                          F.round(f"user_id_amt_{hours}h", 2).alias(f"user_id_amt_{hours}h"))
    return run


for _h in (1, 24, 168):
    query(f"velocity_{_h}h", with_views("transfers_e") + velocity_sql(_h, "transfers_e"))(_velocity(_h))


@query("velocity_ranges", with_views("transfers_e") + velocity_sql(168, "transfers_e"))
def velocity_ranges(spark, sf_dir):
    """The longest window by ranges of (user, time) with carries, for users of any size."""
    out = FT.add_velocity_features(FX.transfers_e(spark, sf_dir), time_col="txn_ts", windows=(168,),
                                   ranges=int(spark.conf.get("spark.sql.shuffle.partitions")))
    return out.select("_id", "user_id_txn_168h", F.round("user_id_amt_168h", 2).alias("user_id_amt_168h"))


def _history(spark, sf_dir):
    t = FX.transfers_e(spark, sf_dir)
    return FT.add_recipient_history(t, time_col="txn_ts")


@query("prior_sends", with_views("transfers_e") + """
select _id, row_number() over (partition by user_id, recipient_id order by txn_ts nulls last, _id) - 1
       as prior_sends_to_recipient
from transfers_e""")
def prior_sends(spark, sf_dir):
    return _history(spark, sf_dir).select("_id", "prior_sends_to_recipient")


@query("first_send", with_views("transfers_e") + """
select _id, cast(row_number() over (partition by user_id, recipient_id order by txn_ts nulls last, _id) = 1 as bigint)
       as is_first_send_to_recipient
from transfers_e""")
def first_send(spark, sf_dir):
    return _history(spark, sf_dir).select("_id", "is_first_send_to_recipient")


@query("time_features", with_views("transfers_e") + """
select _id, cast(hour(txn_ts) as bigint) as hour, cast(isodow(txn_ts) - 1 as bigint) as weekday
from transfers_e""")
def time_features(spark, sf_dir):
    t = FX.transfers_e(spark, sf_dir)
    return FT.derive_time_features(t, "txn_ts").select("_id", "hour", "weekday")


def _enriched(spark, sf_dir, with_labels=False):
    t = FX.transfer_table(spark, sf_dir)
    labels = None
    if with_labels:
        labels = _labels(spark, sf_dir, t)
    return FT.enrich_transfers(t, FX.user_table(spark, sf_dir), FX.recipient_table(spark, sf_dir), labels)


def _matched_chargebacks(spark, sf_dir, transfers):
    return LB.match_to_transfers(LB.parse_chargebacks(FX.chargebacks_raw(spark, sf_dir), FX.FIXTURE_SALT),
                                 transfers)


def _labels(spark, sf_dir, transfers):
    return LB.build_labels(FX.flags(spark, sf_dir), transfers, _matched_chargebacks(spark, sf_dir, transfers))


def _label_attacher(spark, sf_dir, transfers):
    """Labels joined straight onto the frame being assembled (no separate
    per-transfer label table to build and join)."""
    flags, cb = FX.flags(spark, sf_dir), _matched_chargebacks(spark, sf_dir, transfers)
    return lambda df: LB.attach_labels(df, flags, cb)


ENR = with_views("transfers_o", "users", "recipients", "flags", "chargebacks_raw",
                 extra={**LABEL_CTES, "enriched": ENRICHED})


def _aged(spark, sf_dir):
    return FT.add_account_ages(FT.derive_time_features(_enriched(spark, sf_dir)))


@query("account_ages", ENR + f"""
select _id, round({days_sql('txn_ts', 'user__raw_dateCreated')}, 6) as user_age_days,
       round({days_sql('txn_ts', 'recipient__raw_date_created')}, 6) as recipient_age_days
from enriched""")
def account_ages(spark, sf_dir):
    return _aged(spark, sf_dir).select("_id", F.round("user_age_days", 6).alias("user_age_days"),
                                       F.round("recipient_age_days", 6).alias("recipient_age_days"))


@query("negative_age_audit", ENR + f"""
select count(*) filter (where {days_sql('txn_ts', 'user__raw_dateCreated')} < 0) as negative_user_age_days,
       count(*) filter (where {days_sql('txn_ts', 'recipient__raw_date_created')} < 0) as negative_recipient_age_days
from enriched""")
def negative_age_audit(spark, sf_dir):
    return FT.negative_age_audit(_aged(spark, sf_dir))


@query("limit_utilisation", ENR + """
select _id, round(case when user__raw_threshold_level + user__raw_remainingBalance > 0
       then user__raw_threshold_level / (user__raw_threshold_level + user__raw_remainingBalance) end, 6)
       as limit_utilisation
from enriched""")
def limit_utilisation(spark, sf_dir):
    d = FT.derive_user_features(_enriched(spark, sf_dir))
    return d.select("_id", F.round("limit_utilisation", 6).alias("limit_utilisation"))


_STRIP = "regexp_replace({}, '^\\s+|\\s+$', '', 'g')"


@query("billing_country_match", ENR + f"""
select _id, case when user__raw_billing_address is not null and user_country is not null
                      and upper({_STRIP.format('user_country')}) <> ''
            then cast(ends_with(upper({_STRIP.format('user__raw_billing_address')}),
                                upper({_STRIP.format('user_country')})) as double) end as billing_country_match
from enriched""")
def billing_country_match(spark, sf_dir):
    return FT.derive_user_features(_enriched(spark, sf_dir)).select("_id", "billing_country_match")


def _transfer_feats(spark, sf_dir):
    return FT.derive_transfer_features(FX.transfer_table(spark, sf_dir))


@query("n_previous_recipients", with_views("transfers_o") + """
select _id, cast(coalesce(n_prev_list, 0) as bigint) as n_previous_recipients from transfers_o""")
def n_previous_recipients(spark, sf_dir):
    return _transfer_feats(spark, sf_dir).select("_id", "n_previous_recipients")


@query("threeds_reported", with_views("transfers_o") + """
select _id, cast(isenabled3ds is not null as bigint) as threeds_reported from transfers_o""")
def threeds_reported(spark, sf_dir):
    return _transfer_feats(spark, sf_dir).select("_id", "threeds_reported")


@query("ip_country_mismatch", with_views("transfers_o") + f"""
select _id, case when ip_country is not null and sending_from is not null
            then cast(substr(lower({_STRIP.format('ip_country')}), 1, 6) <> substr(lower({_STRIP.format('sending_from')}), 1, 6) as double)
            end as ip_country_mismatch
from transfers_o""")
def ip_country_mismatch(spark, sf_dir):
    return _transfer_feats(spark, sf_dir).select("_id", "ip_country_mismatch")


@query("cents", with_views("transfers_o") + """
select _id, round(send_amount - floor(send_amount), 6) as cents from transfers_o""")
def cents(spark, sf_dir):
    return _transfer_feats(spark, sf_dir).select("_id", F.round("cents", 6).alias("cents"))


@query("normalise_code", with_views("transfers_o") + """
select _id, case when regexp_matches(description_code, '^[0-9a-f]{24}$', 'i') then 'legacy'
                 else description_code end as description_code
from transfers_o""")
def normalise_code(spark, sf_dir):
    return FT.normalize_description_code(FX.transfer_table(spark, sf_dir)).select("_id", "description_code")


@query("code_format_ratio", with_views("transfers_o") + """
select total, total - legacy_n - missing_n as known_n, legacy_n, missing_n,
       round(legacy_n / total, 6) as legacy_rate, coalesce(legacy_n / total > 0.5, false) as legacy_alert
from (select count(*) as total,
             count(*) filter (where coalesce(regexp_matches(description_code, '^[0-9a-f]{24}$', 'i'), false)) as legacy_n,
             count(*) filter (where description_code is null) as missing_n
      from transfers_o) x""")
def code_format_ratio(spark, sf_dir):
    r = FT.code_format_ratio(FX.transfer_table(spark, sf_dir))
    return r.withColumn("legacy_rate", F.round("legacy_rate", 6))


@query("enrich_transfers", ENR + """
select _id, user_id, recipient_id, user_country, recipient_doc_bank_name, label, label_source
from enriched""")
def enrich_transfers(spark, sf_dir):
    return _enriched(spark, sf_dir, with_labels=True).select(
        "_id", "user_id", "recipient_id", "user_country", "recipient_doc_bank_name", "label", "label_source")


@query("join_match_rate", ENR + """
select count(*) as transfers,
       round(avg(cast(user__raw_dateCreated is not null as double)) * 100, 6) as user_match_pct,
       round(avg(cast(recipient__raw_date_created is not null as double)) * 100, 6) as recipient_match_pct,
       avg(cast(user__raw_dateCreated is not null as double)) * 100 < 50
         or avg(cast(recipient__raw_date_created is not null as double)) * 100 < 50 as low_match_warning
from enriched""")
def join_match_rate(spark, sf_dir):
    r = FT.join_match_rate(_enriched(spark, sf_dir))
    return r.select("transfers", F.round("user_match_pct", 6).alias("user_match_pct"),
                    F.round("recipient_match_pct", 6).alias("recipient_match_pct"), "low_match_warning")


def training_table(spark, sf_dir, keep_ids=False):
    t = FX.transfer_table(spark, sf_dir)
    return FT.assemble(t, FX.user_table(spark, sf_dir), FX.recipient_table(spark, sf_dir),
                       _label_attacher(spark, sf_dir, t), keep_ids=keep_ids)


@query("row_count_reconciliation", with_views("transfers_o") + """
select count(*) as source_rows, count(*) as training_rows, 0::bigint as missing_ids, 0::bigint as extra_ids,
       true as reconciled
from transfers_o""")
def row_count_reconciliation(spark, sf_dir):
    from tallyhawk.operators.gate import reconcile_rows
    return reconcile_rows(FX.transfer_table(spark, sf_dir), training_table(spark, sf_dir, keep_ids=True))


TRAINING_SQL = ENR + f"""
, feats as (
select e.*,
       cast(hour(txn_ts) as bigint) as hour, cast(isodow(txn_ts) - 1 as bigint) as weekday,
       {days_sql('txn_ts', 'user__raw_dateCreated')} as user_age_days,
       {days_sql('txn_ts', 'recipient__raw_date_created')} as recipient_age_days,
       case when user__raw_threshold_level + user__raw_remainingBalance > 0
            then user__raw_threshold_level / (user__raw_threshold_level + user__raw_remainingBalance) end as limit_utilisation,
       case when user__raw_billing_address is not null and user_country is not null
                 and upper({_STRIP.format('user_country')}) <> ''
            then cast(ends_with(upper({_STRIP.format('user__raw_billing_address')}), upper({_STRIP.format('user_country')})) as double)
            end as billing_country_match,
       cast(coalesce(n_prev_list, 0) as bigint) as n_previous_recipients,
       cast(isenabled3ds is not null as bigint) as threeds_reported,
       case when ip_country is not null and sending_from is not null
            then cast(substr(lower({_STRIP.format('ip_country')}), 1, 6) <> substr(lower({_STRIP.format('sending_from')}), 1, 6) as double)
            end as ip_country_mismatch,
       send_amount - floor(send_amount) as cents,
       case when regexp_matches(description_code, '^[0-9a-f]{{24}}$', 'i') then 'legacy' else description_code end as code,
       epoch_us(cast(txn_ts as timestamp)) as _us,
       row_number() over (partition by user_id, recipient_id order by txn_ts nulls last, _id) - 1 as prior_sends
from enriched e)
select {ts_sql('txn_ts')} as date, round(send_amount, 2) as send_amount, amount_paid, round(transfer_fee, 6) as transfer_fee,
       provider as paymentProvider, code as description_code, sending_from, user_country, recipient_doc_bank_name,
       label, label_source, hour, weekday,
       round(user_age_days, 6) as user_age_days, round(recipient_age_days, 6) as recipient_age_days,
       round(limit_utilisation, 6) as limit_utilisation, billing_country_match, n_previous_recipients,
       threeds_reported, ip_country_mismatch, round(cents, 6) as cents,
       count(send_amount) over w1 as user_id_txn_1h, round(coalesce(sum(send_amount) over w1, 0), 2) as user_id_amt_1h,
       count(send_amount) over w24 as user_id_txn_24h, round(coalesce(sum(send_amount) over w24, 0), 2) as user_id_amt_24h,
       count(send_amount) over w168 as user_id_txn_168h, round(coalesce(sum(send_amount) over w168, 0), 2) as user_id_amt_168h,
       prior_sends as prior_sends_to_recipient, cast(prior_sends = 0 as bigint) as is_first_send_to_recipient
from feats
window w1 as (partition by user_id order by _us range between 3600000000 preceding and 1 preceding),
       w24 as (partition by user_id order by _us range between 86400000000 preceding and 1 preceding),
       w168 as (partition by user_id order by _us range between 604800000000 preceding and 1 preceding)"""


@query("training_set", TRAINING_SQL)
def training_set(spark, sf_dir):
    df = training_table(spark, sf_dir)
    r6 = ["transfer_fee", "user_age_days", "recipient_age_days", "limit_utilisation", "cents"]
    r2 = ["send_amount"] + [f"user_id_amt_{h}h" for h in (1, 24, 168)]
    out = df.withColumns({c: F.round(c, 6) for c in r6}).withColumns({c: F.round(c, 2) for c in r2})
    out = out.withColumn("date", ts_text("date"))
    cols = ["date", "send_amount", "amount_paid", "transfer_fee", "paymentProvider", "description_code",
            "sending_from", "user_country", "recipient_doc_bank_name", "label", "label_source", "hour",
            "weekday", "user_age_days", "recipient_age_days", "limit_utilisation", "billing_country_match",
            "n_previous_recipients", "threeds_reported", "ip_country_mismatch", "cents",
            "user_id_txn_1h", "user_id_amt_1h", "user_id_txn_24h", "user_id_amt_24h",
            "user_id_txn_168h", "user_id_amt_168h", "prior_sends_to_recipient", "is_first_send_to_recipient"]
    return out.select(*cols)
