"""Reusable SQL blocks for the oracle text (DuckDB dialect)."""

from __future__ import annotations

from tallyhawk import contract as K
from tallyhawk.plans.oracle_views import hash_sql

_typology_cases = "\n".join(
    f"            when regexp_matches(lower(observations), '{pat}') then '{label}'"
    for label, pat in K.TYPOLOGY_PATTERNS)

CHARGEBACKS = f"""
select folio, partner_txn, amount, observations, rb_date,
       {hash_sql('folio')} as partner_reference,
       {hash_sql('partner_txn')} as partner_txn_id,
       strptime(rb_date, '%m/%d/%y') as confirmed_date,
       abs(try_cast(amount as double)) as chargeback_amount,
       case when observations is null then null
{_typology_cases}
            else 'other' end as fraud_type
from chargebacks_raw"""

TRANSFER_KEYS = f"""
select _id, txn_ts,
       {hash_sql('coalesce(omnexpaymentid, payment_receipt_number, transaction_id)')} as partner_reference,
       {hash_sql('transaction_id')} as partner_txn_id
from transfers_o"""

CB_MATCHED = """
select cb.*, coalesce(lk1.m, lk2.m) as _id
from cb
left join (select partner_reference as k, min(_id) as m from tk where partner_reference is not null group by 1) lk1
  on cb.partner_reference = lk1.k
left join (select partner_txn_id as k, min(_id) as m from tk where partner_txn_id is not null group by 1) lk2
  on cb.partner_txn_id = lk2.k"""

LATEST = """
select transfer as _id, action, flag_ts as verdict_date,
       cast(case when action = 'flag' then 1 else 0 end as int) as label
from (select *, row_number() over (partition by transfer order by flag_ts desc, seq desc, action desc) as rn
      from flags where action is not null) x
where rn = 1"""

def labels_over(transfers: str) -> str:
    return f"""
select t._id,
       cast(case when h._id is not null then 1 when l._id is null then 0 else l.label end as int) as label,
       case when h._id is not null then '{K.SOURCE_CHARGEBACK}'
            when l._id is null then '{K.SOURCE_ASSUMED}'
            when l.label = 1 then '{K.SOURCE_UPHELD}' else '{K.SOURCE_CLEARED}' end as label_source,
       l.verdict_date, l.label as verdict_label
from {transfers} t
left join latest l on l._id = t._id
left join (select distinct _id from cbm where _id is not null) h on h._id = t._id"""

LABEL_CTES = {"cb": CHARGEBACKS, "tk": TRANSFER_KEYS, "cbm": CB_MATCHED, "latest": LATEST,
              "labels": labels_over("transfers_o")}

ENRICHED = """
select t.*, u.datecreated as user__raw_dateCreated, u.country as user_country,
       u.billing_address as user__raw_billing_address, u.threshold_level as user__raw_threshold_level,
       u.remainingbalance as user__raw_remainingBalance,
       r.date_created as recipient__raw_date_created, r.bank_name as recipient_doc_bank_name,
       lb.label, lb.label_source
from transfers_o t
left join users u on u.user_id = t.user_id
left join recipients r on r.recipient_id = t.recipient_id
left join labels lb on lb._id = t._id"""

def days_sql(later: str, earlier: str) -> str:
    return f"((epoch_us(cast({later} as timestamp)) - epoch_us(cast({earlier} as timestamp))) / 86400e6)"


def velocity_sql(hours: int, src: str, ts: str = "txn_ts") -> str:
    w = hours * 3_600_000_000
    return f"""
select _id,
       cast(case when user_id is null or {ts} is null then 0 else count(send_amount) over w end as bigint) as user_id_txn_{hours}h,
       round(case when user_id is null or {ts} is null then 0 else coalesce(sum(send_amount) over w, 0) end, 2) as user_id_amt_{hours}h
from (select *, epoch_us(cast({ts} as timestamp)) as _us from {src}) v
window w as (partition by user_id order by _us range between {w} preceding and 1 preceding)"""
