"""Split and model-matrix queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyhawk.operators import prep as PR
from tallyhawk.plans.catalog import query, ts_sql, ts_text
from tallyhawk.plans.oracle_views import with_views
from tallyhawk.plans.queries_features import _label_attacher
from tallyhawk.plans.sql_blocks import LABEL_CTES
from tallyhawk.sources import fixtures as FX


def prep_frame(spark, sf_dir):
    """Transfers with customer name and nation (a 25-row dimension),
    a constant channel, labels and the realised amount."""
    t = FX.transfer_table(spark, sf_dir)
    cust = FX.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_name", "c_nationkey")
    nation = FX.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    attach = _label_attacher(spark, sf_dir, t)
    base = (t.select("_id", "user_id", "date", "send_amount", F.col("paymentProvider").alias("provider"),
                     "amount_paid")
             .join(cust, "user_id", "left").join(F.broadcast(nation), "c_nationkey", "left"))
    return (attach(base)
             .withColumn("channel", F.lit("web"))
             .select("_id", "date", "send_amount", "provider", "n_name", "c_name", "channel",
                     "label", "label_source", "amount_paid"))


PREP_CTES = {**LABEL_CTES, "base": """
select t._id, t.txn_ts as date, t.send_amount, t.provider, n.n_name, c.c_name, 'web' as channel,
       lb.label, lb.label_source, t.amount_paid
from transfers_o t
left join customer c on c.c_custkey = t.user_id
left join nation n on n.n_nationkey = c.c_nationkey
left join labels lb on lb._id = t._id""", "split": """
select * exclude (r, n, n_test),
       case when r < n - n_test - floor(cast(n - n_test as double) * 0.15) then 'train'
            when r < n - n_test then 'val' else 'test' end as split
from (select *, floor(cast(n as double) * 0.2) as n_test
      from (select *, row_number() over (order by date, _id) - 1 as r, count(*) over () as n from base) a) b""",
    "tr": "select * from split where split = 'train'",
    "fm": """
select 'n_name' as col, n_name as value, cast(cast(count(*) as double) / sum(count(*)) over () as float) as freq
from tr where n_name is not null group by n_name
union all
select 'c_name' as col, c_name as value, cast(cast(count(*) as double) / sum(count(*)) over () as float) as freq
from tr where c_name is not null group by c_name""",
    "lv": """
select col, value, cast(row_number() over (partition by col order by value) - 1 as int) as idx
from (select distinct 'n_name' as col, n_name as value from tr
      where n_name is not null and (select count(distinct n_name) from tr) between 2 and 200
      union all
      select distinct 'provider' as col, provider as value from tr
      where provider is not null and (select count(distinct provider) from tr) between 2 and 200
      union all
      select distinct 'c_name' as col, c_name as value from tr
      where c_name is not null and (select count(distinct c_name) from tr) between 2 and 200) d""",
    "fmx": """
select s._id, s.split, cast(s.label as int) as y, s.amount_paid as amount,
       coalesce(f2.freq, cast(-1 as float)) as c_name_FE,
       l1.idx as n_name, coalesce(f1.freq, cast(-1 as float)) as n_name_FE,
       l2.idx as provider, s.send_amount
from split s
left join fm f1 on f1.col = 'n_name' and f1.value = s.n_name
left join fm f2 on f2.col = 'c_name' and f2.value = s.c_name
left join lv l1 on l1.col = 'n_name' and l1.value = s.n_name
left join lv l2 on l2.col = 'provider' and l2.value = s.provider"""}

PREP = with_views("transfers_o", "flags", "chargebacks_raw", extra=PREP_CTES)


def _split(spark, sf_dir):
    return PR.temporal_split(prep_frame(spark, sf_dir))


@query("temporal_split", with_views("transfers_e") + """
select _id, case when r < n - n_test - floor(cast(n - n_test as double) * 0.15) then 'train'
                 when r < n - n_test then 'val' else 'test' end as split
from (select *, floor(cast(n as double) * 0.2) as n_test
      from (select _id, row_number() over (order by txn_ts, _id) - 1 as r, count(*) over () as n
            from transfers_e) a) b""")
def temporal_split(spark, sf_dir):
    return PR.temporal_split(FX.transfers_e(spark, sf_dir), time_col="txn_ts").select("_id", "split")


@query("split_summary", PREP + f"""
select split, count(*) as n, {ts_sql('min(date)')} as min_date, {ts_sql('max(date)')} as max_date
from split group by split""")
def split_summary(spark, sf_dir):
    s = PR.split_summary(_split(spark, sf_dir))
    return s.select("split", "n", ts_text("min_date").alias("min_date"), ts_text("max_date").alias("max_date"))


@query("fraud_rate_by_split", PREP + """
select split, count(*) as n, round(avg(cast(label as double)), 6) as fraud_rate from split group by split""")
def fraud_rate_by_split(spark, sf_dir):
    return PR.fraud_rate_by_split(_split(spark, sf_dir)).withColumn("fraud_rate", F.round("fraud_rate", 6))


@query("class_weight", PREP + """
select count(*) - cast(coalesce(sum(label), 0) as bigint) as neg, cast(coalesce(sum(label), 0) as bigint) as pos,
       round((count(*) - coalesce(sum(label), 0)) / greatest(coalesce(sum(label), 0), 1), 6) as scale_pos_weight
from tr""")
def class_weight(spark, sf_dir):
    r = PR.class_weight(_split(spark, sf_dir).filter(F.col("split") == "train"))
    return r.withColumn("scale_pos_weight", F.round("scale_pos_weight", 6))


def _state(spark, sf_dir):
    s = _split(spark, sf_dir)
    return s, PR.fit(s.filter(F.col("split") == "train"), exclude=["_id", "split"])


@query("feature_plan", PREP + """
, st as (select count(distinct provider) as provider, count(distinct n_name) as n_name,
                count(distinct c_name) as c_name, count(distinct channel) as channel,
                min(send_amount) as amin, max(send_amount) as amax from tr)
select col, case when nu <= 1 then 'dropped' when nu <= 20 then 'category'
                 when nu <= 200 then 'category+frequency' else 'frequency' end as kind, nu as n_unique
from (select 'provider' as col, provider as nu from st union all select 'n_name', n_name from st
      union all select 'c_name', c_name from st union all select 'channel', channel from st) x
union all
select 'send_amount', case when amin is null or amin = amax then 'dropped' else 'numeric' end, null from st""")
def feature_plan(spark, sf_dir):
    return _state(spark, sf_dir)[1].plan


@query("frequency_encode", PREP + """
select _id, c_name_FE, n_name_FE from fmx""")
def frequency_encode(spark, sf_dir):
    s, st = _state(spark, sf_dir)
    return PR.transform(st, s, keep=["_id"]).select("_id", "c_name_FE", "n_name_FE")


@query("category_levels", PREP + "select col, value, idx from lv")
def category_levels(spark, sf_dir):
    return _state(spark, sf_dir)[1].levels


@query("feature_matrix", PREP + """
select _id, c_name_FE, n_name, n_name_FE, provider, send_amount from fmx""")
def feature_matrix(spark, sf_dir):
    s, st = _state(spark, sf_dir)
    return PR.transform(st, s, keep=["_id"])


@query("prepare_matrix", PREP + "select * from fmx")
def prepare_matrix(spark, sf_dir):
    return PR.prepare_matrix(prep_frame(spark, sf_dir))[1]


@query("feature_coverage", PREP + """
select _id, cast((c_name_FE is not null)::int + (n_name is not null)::int + (n_name_FE is not null)::int
                 + (provider is not null)::int + (send_amount is not null)::int as bigint) as features_provided,
       cast(5 as bigint) as features_expected,
       round(((c_name_FE is not null)::int + (n_name is not null)::int + (n_name_FE is not null)::int
              + (provider is not null)::int + (send_amount is not null)::int) / 5.0, 6) as coverage,
       ((c_name_FE is not null)::int + (n_name is not null)::int + (n_name_FE is not null)::int
        + (provider is not null)::int + (send_amount is not null)::int) / 5.0 < 0.5 as low_coverage
from fmx""")
def feature_coverage(spark, sf_dir):
    st, m = PR.prepare_matrix(prep_frame(spark, sf_dir))
    cov = PR.feature_coverage(m, st.feature_cols, keep=["_id"])
    return cov.withColumn("coverage", F.round("coverage", 6))


@query("prep_state_roundtrip", PREP + """
select _id, split, c_name_FE, n_name, n_name_FE, provider, send_amount from fmx""")
def prep_state_roundtrip(spark, sf_dir):
    """Persist the fitted state, reload it and transform with the copy."""
    from tallyhawk.session import scratch_path
    s, st = _state(spark, sf_dir)
    path = scratch_path(spark, "prep-state")
    st.save(path)
    again = PR.PrepState.load(spark, path)
    return PR.transform(again, s, keep=["_id", "split"])
