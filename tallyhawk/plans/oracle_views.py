"""The fixture bindings as SQL text for the DuckDB oracle.

Same definitions as ``tallyhawk.sources.fixtures``; each oracle query is
``WITH <views it needs> SELECT ...``.
"""

from __future__ import annotations

from tallyhawk.sources.fixtures import EXPORT_CUTOFF, FIXTURE_SALT

VIEWS = {
    "transfers_e": """
select event_id as _id, user_id,
       cast(regexp_extract(props, '[0-9]+', 0) as bigint) as recipient_id,
       ts as txn_ts, value as send_amount, event_type as provider
from events""",
    "transfers_o": """
select o_orderkey as _id, o_custkey as user_id, o_orderkey % 120 as recipient_id,
       o_orderdate as txn_ts, o_totalprice as send_amount, o_orderpriority as provider,
       case when substr(o_orderpriority,1,1) in ('1','2') then concat('JP', cast(o_orderkey as varchar)) end as omnexpaymentid,
       case when substr(o_orderpriority,1,1) = '3' then concat('R', cast(o_orderkey as varchar)) end as payment_receipt_number,
       case when substr(o_orderpriority,1,1) <> '5' then concat('T', cast(o_orderkey as varchar)) end as transaction_id,
       case o_orderstatus when 'F' then '64383D62a8649c1fe6386962' when 'P' then '10' end as description_code,
       o_totalprice / 100 as transfer_fee,
       case when o_orderstatus <> 'P' then o_totalprice end as amount_paid,
       case when substr(o_orderpriority,1,1) = '2' then o_orderkey % 2 = 0 end as isenabled3ds,
       case when o_orderstatus <> 'O' then o_orderkey % 4 end as n_prev_list,
       ni.n_name as ip_country, nf.n_name as sending_from
from orders
left join nation ni on ni.n_nationkey = o_orderkey % 25
left join nation nf on nf.n_nationkey = o_custkey % 25""",
    "flags": """
select l_orderkey as transfer,
       case l_returnflag when 'R' then 'flag' else 'unflag' end as action,
       l_shipdate as flag_ts, l_linenumber as seq
from lineitem
where l_returnflag in ('A','R')""",
    "chargebacks_raw": """
select case when o_orderkey % 400 = 3 then concat('JPX', cast(o_orderkey as varchar))
            when substr(o_orderpriority,1,1) in ('1','2') then concat('  jp', cast(o_orderkey as varchar), ' ')
            when substr(o_orderpriority,1,1) = '3' then concat('r', cast(o_orderkey as varchar)) end as folio,
       case when substr(o_orderpriority,1,1) = '4' then concat(' T', cast(o_orderkey as varchar)) end as partner_txn,
       concat('-', cast(cast(floor(o_totalprice) as bigint) as varchar)) as amount,
       case o_orderkey % 7 when 0 then 'Error code 43 - Stolen Card.'
            when 1 then 'Unauthorized transaction reported by cardholder.'
            when 2 then 'Romance scam reported by victim.'
            when 3 then 'Account takeover - credentials compromised.'
            when 4 then 'no clear pattern'
            when 5 then 'First party misuse - not recognised by customer.' end as observations,
       strftime(cast(o_orderdate as date) + 45, '%m/%d/%y') as rb_date
from orders where o_orderstatus = 'P'""",
    "users": """
select c_custkey as user_id, date '1990-01-01' + cast(c_custkey % 1500 as int) as datecreated,
       concat('N', cast(c_nationkey as varchar)) as country,
       concat(c_name, ', ', case when c_custkey % 3 = 0 then 'XX' else concat('N', cast(c_nationkey as varchar)) end) as billing_address,
       c_acctbal as threshold_level,
       case when c_custkey % 10 = 0 then 0 - c_acctbal else 5000.0 end as remainingbalance,
       concat('user', cast(c_custkey as varchar), '@', c_mktsegment, '.COM ') as email
from customer""",
    "recipients": """
select s_suppkey as recipient_id, date '1994-06-01' + cast(s_suppkey * 7 % 400 as int) as date_created,
       concat('bank', cast(s_suppkey % 30 as varchar)) as bank_name
from supplier""",
    "scored": """
select event_id as id, case when event_type = 'error' then 1 else 0 end as y,
       cast(250 * (case when event_type = 'error' then 1 else 0 end) + (event_id * 7919) % 750 as double) / 1000 as score,
       value as amount, cast(user_id % 10 as varchar) as segment, ts, user_id
from events""",
}

VIEWS["scored_gaps"] = f"""
select s.* replace (case when id % 13 = 5 then 'NaN'::double when id % 7 <> 2 then score end as score)
from ({VIEWS['scored']}) s"""

# Hash of the fixture salt + normalised value, as the Spark pseudonym.
def hash_sql(expr: str) -> str:
    norm = f"lower(regexp_replace(cast({expr} as varchar), '^\\s+|\\s+$', '', 'g'))"
    return (f"(case when {norm} <> '' then substr(sha256(concat('{FIXTURE_SALT}', {norm})), 1, 24) end)")


def with_views(*names: str, extra: dict[str, str] | None = None) -> str:
    parts = [f"{n} as ({VIEWS[n]})" for n in names]
    for n, body in (extra or {}).items():
        parts.append(f"{n} as ({body})")
    return "with " + ",\n".join(parts) + "\n"


CUTOFF = EXPORT_CUTOFF
