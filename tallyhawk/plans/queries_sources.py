"""Document, extraction, profile, source and sink queries.

Documents are derived from the driver's tables (``tallyhawk.sources.documents``);
the oracle reads the plain columns the documents were rendered from. The
mapping below says, per contract field, which plain value a document
carries (absent fields are null).
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, TimestampType

from tallyhawk import contract as K
from tallyhawk.operators import extract as X
from tallyhawk.operators import labels as LB
from tallyhawk.operators import profile as PF
from tallyhawk.plans.catalog import query, ts_sql, ts_text
from tallyhawk.plans.oracle_views import hash_sql, with_views
from tallyhawk.plans.sql_blocks import CHARGEBACKS
from tallyhawk.session import scratch_path
from tallyhawk.sources import documents as D
from tallyhawk.sources import fixtures as FX
from tallyhawk.sources import sheets as SH
from tallyhawk.sources import commits as CM
from tallyhawk.sources import tables as TB

SALT = FX.FIXTURE_SALT
PRIO = "substr(provider, 1, 1)"

# plain value each document field carries, per collection (absent -> null)
RAW_SQL = {
    "transfer": {
        "_id": "cast(_id as varchar)", "user_id": "cast(user_id as varchar)",
        "recipient_id": "cast(recipient_id as varchar)", "send_amount": "send_amount",
        "amount_paid": "amount_paid", "transfer_fee": "transfer_fee", "sending_from": "sending_from",
        "recipient_network": f"case when {PRIO} = '1' then 'mtn' end", "paymentProvider": "provider",
        "description_code": "description_code", "isEnabled3Ds": "isenabled3ds",
        "previous_recipient": "case when n_prev_list is not null then "
                              "rtrim(repeat(cast(recipient_id as varchar) || ',', cast(n_prev_list as int)), ',') end",
        "ipDetails.ip": "'ip'", "ipDetails.location.country": "ip_country",
        "sender_email": "concat('sender', cast(user_id as varchar), '@Mail.Example ')", "date": "txn_ts",
        "omnexPaymentId": "omnexpaymentid", "payment_receipt_number": "payment_receipt_number",
        "transaction_id": "transaction_id",
    },
    "user": {
        "_id": "cast(user_id as varchar)", "dateCreated": "datecreated", "country": "country",
        "billing_address": "billing_address", "threshold_level": "threshold_level",
        "remainingBalance": "remainingbalance", "occupation": "case when user_id % 4 = 0 then null else 'occ' end",
    },
    "recipient": {
        "_id": "cast(recipient_id as varchar)", "date_created": "date_created", "bank_name": "bank_name",
        "recipient_email": "concat('r', cast(recipient_id as varchar), '@Bank.Example')",
    },
    "flag": {"transfer": "cast(transfer as varchar)", "action": "action", "date": "flag_ts"},
}
VIEW_OF = {"transfer": "transfers_o", "user": "users", "recipient": "recipients", "flag": "flags"}
SQL_TYPE = {"string": "varchar", "double": "double", "bigint": "bigint", "boolean": "boolean",
            "timestamp": "varchar", "array<string>": "varchar"}


def _email_sql(x: str) -> str:
    return (f"case when position('@' in {x}) > 0 then lower(regexp_replace(reverse(split_part(reverse({x}), '@', 1)),"
            f" '^\\s+|\\s+$', '', 'g')) end")


def _typed(field: str, raw: str | None) -> str:
    t = X.field_type(field)
    if raw is None:
        return f"cast(null as {SQL_TYPE[t]})"
    if t == "timestamp":
        return ts_sql(raw)
    return raw


def extract_sql(doc_type: str) -> str:
    raw = RAW_SQL[doc_type]
    cols = []
    for field, action, _t, _s in K.CONTRACTS[doc_type]:
        col = X.out_name(field)
        r = raw.get(field)
        if action == "HASH":
            cols.append(f"{hash_sql(r) if r else 'cast(null as varchar)'} as {col}")
        elif action == "DERIVE":
            if field in K.SENSITIVE_DERIVE:
                target = K.SENSITIVE_DERIVE[field]
                if target is None:
                    continue
                val = (_email_sql(r) if target.endswith("email_domain") else r) if r else "cast(null as varchar)"
                cols.append(f"{val} as {target}")
            else:
                cols.append(f"{_typed(field, r)} as _raw_{col}")
        else:
            cols.append(f"{_typed(field, r)} as {col}")
    if doc_type == "transfer":
        for canon, aliases in K.CANONICAL.items():
            present = [raw[a] for a in aliases if a in raw]
            cols.append(f"{hash_sql('coalesce(' + ', '.join(present) + ')')} as {canon}")
    return with_views(VIEW_OF[doc_type]) + "select " + ",\n       ".join(cols) + f" from {VIEW_OF[doc_type]}"


def textualise(df):
    """Timestamps -> text, arrays -> comma-joined text (oracle-comparable)."""
    cols = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, TimestampType):
            cols[f.name] = ts_text(f.name)
        elif isinstance(f.dataType, ArrayType):
            cols[f.name] = F.array_join(f.name, ",")
    return df.withColumns(cols) if cols else df


_EXPORTED: dict[tuple[str, str, str], str] = {}


def docs(spark, sf_dir, doc_type="transfer"):
    """The collection as exported NDJSON files, scanned into VARIANT. The
    export is rendered from the driver's tables into the shared scratch
    folder once per application and source folder, like a provider dump
    that later jobs read."""
    key = (spark.sparkContext.applicationId, sf_dir, doc_type)
    path = _EXPORTED.get(key)
    if path is None:
        path = scratch_path(spark, f"{doc_type}-docs")
        D.export_lines(D.BUILDERS[doc_type](spark, sf_dir), path)
        _EXPORTED[key] = path
    return D.read_documents(spark, path)


def _extract_query(doc_type):
    def run(spark, sf_dir):
        return textualise(X.extract_collection(docs(spark, sf_dir, doc_type), doc_type, SALT))
    return run


for _dt in ("transfer", "user", "recipient", "flag"):
    query(f"extract_{_dt}", extract_sql(_dt))(_extract_query(_dt))


@query("nested_field", with_views("transfers_o") + "select cast(_id as varchar) as doc_id, ip_country from transfers_o")
def nested_field(spark, sf_dir):
    d = docs(spark, sf_dir)
    return d.select(X.read_field("doc", "_id", "string").alias("doc_id"),
                    X.read_field("doc", "ipDetails.location.country", "string").alias("ip_country"))


@query("unwrap_extended_json", with_views("transfers_o") + f"""
select cast(_id as varchar) as doc_id, cast(user_id as varchar) as user_oid, {ts_sql('txn_ts')} as date, send_amount
from transfers_o""")
def unwrap_extended_json(spark, sf_dir):
    d = docs(spark, sf_dir)
    return d.select(X.read_field("doc", "_id", "string").alias("doc_id"),
                    X.read_field("doc", "user_id", "string").alias("user_oid"),
                    ts_text(X.read_field("doc", "date", "timestamp")).alias("date"),
                    X.read_field("doc", "send_amount", "double").alias("send_amount"))


@query("blank_to_null", with_views("transfers_o") + f"""
select cast(_id as varchar) as doc_id, case when {PRIO} = '1' then 'mtn' end as recipient_network from transfers_o""")
def blank_to_null(spark, sf_dir):
    d = docs(spark, sf_dir)
    return d.select(X.read_field("doc", "_id", "string").alias("doc_id"),
                    X.read_field("doc", "recipient_network", "string").alias("recipient_network"))


@query("email_domain", with_views("users") + f"select user_id, {_email_sql('email')} as email_domain from users")
def email_domain(spark, sf_dir):
    from tallyhawk.functions.columns import email_domain as ed
    return FX.users(spark, sf_dir).select("user_id", ed("email").alias("email_domain"))


CANON_SQL = f"""
select {hash_sql('cast(_id as varchar)')} as _id,
       case when omnexpaymentid is not null then 'omnexPaymentId'
            when payment_receipt_number is not null then 'payment_receipt_number'
            when transaction_id is not null then 'transaction_id' else 'UNRESOLVED' end as partner_reference_source,
       case when transaction_id is not null then 'transaction_id' else 'UNRESOLVED' end as partner_txn_id_source
from transfers_o"""


@query("canonical_reference", with_views("transfers_o") + CANON_SQL)
def canonical_reference(spark, sf_dir):
    d = docs(spark, sf_dir)
    return d.select(X.contract_columns("transfer", SALT)["_id"].alias("_id"), *_canon_cols())


def _canon_cols():
    out = []
    for canon, aliases in K.CANONICAL.items():
        expr = F.lit("UNRESOLVED")
        for a in reversed(aliases):
            expr = F.when(X.read_field("doc", a, "string").isNotNull(), F.lit(a)).otherwise(expr)
        out.append(expr.alias(f"{canon}_source"))
    return out


def _audit_sql(doc_type: str) -> str:
    raw = RAW_SQL[doc_type]
    tiers = sorted({t for _f, _a, t, _s in K.CONTRACTS[doc_type]})
    parts = [f"select 'docs' as metric, count(*) as n from {VIEW_OF[doc_type]}"]
    for t in tiers:
        terms = [f"count(*) filter (where ({raw[f]}) is null)" if f in raw else "count(*)"
                 for f, _a, tt, _s in K.CONTRACTS[doc_type] if tt == t]
        parts.append(f"select 'missing_tier{t}' as metric, cast({' + '.join(terms)} as bigint) as n "
                     f"from {VIEW_OF[doc_type]}")
    if doc_type == "transfer":
        parts.append("select concat('partner_reference<-', partner_reference_source) as metric, count(*) as n "
                     "from canon group by 1")
        parts.append("select concat('partner_txn_id<-', partner_txn_id_source) as metric, count(*) as n "
                     "from canon group by 1")
    extra = {"canon": CANON_SQL} if doc_type == "transfer" else None
    return with_views(VIEW_OF[doc_type], extra=extra) + "\nunion all\n".join(parts)


@query("extraction_audit", _audit_sql("transfer"))
def extraction_audit(spark, sf_dir):
    return X.extraction_audit(docs(spark, sf_dir), "transfer")


# presence of each top-level key in a transfer document
TOP_KEYS_SQL = {
    "_id": "true", "user_id": "true", "recipient_id": "true", "date": "true", "send_amount": "true",
    "transfer_fee": "true", "paymentProvider": "true", "sending_from": "true", "ipDetails": "true",
    "sender_email": "true", "amount_paid": "amount_paid is not null",
    "omnexPaymentId": "omnexpaymentid is not null", "payment_receipt_number": "payment_receipt_number is not null",
    "transaction_id": "transaction_id is not null", "description_code": "description_code is not null",
    "recipient_network": f"{PRIO} in ('1', '3')", "isEnabled3Ds": "isenabled3ds is not null",
    "previous_recipient": "n_prev_list is not null", "status": f"{PRIO} = '4'",
    "internalNote": "description_code is null", "partnerDebug": f"{PRIO} = '5'",
}
_KNOWN = ", ".join(f"'{k}'" for k in PF.known_fields("transfer"))
_PRESENCE = "\nunion all\n".join(
    f"select '{k}' as field, count(*) filter (where {c}) as n_present, count(*) as n from transfers_o"
    for k, c in TOP_KEYS_SQL.items())


@query("profile_presence", with_views("transfers_o", extra={"p": _PRESENCE}) + f"""
select field, n_present, round(n_present / n, 6) as rate, n_present < n as variable, field in ({_KNOWN}) as in_contract
from p where n_present > 0""")
def profile_presence(spark, sf_dir):
    r = PF.profile_presence(docs(spark, sf_dir), "transfer")
    return r.withColumn("rate", F.round("rate", 6))


_GROUP_RATES = "\nunion all\n".join(
    f"select provider as grp, '{k}' as field, avg(case when {c} then 1.0 else 0.0 end) as rate "
    f"from transfers_o group by provider" for k, c in TOP_KEYS_SQL.items())


@query("profile_discriminator_variance", with_views("transfers_o", extra={"p": _PRESENCE, "g": _GROUP_RATES}) + """
select 'paymentProvider' as discriminator, field,
       string_agg(grp, ',' order by grp) filter (where rate > 0.9) as present_in
from g where field in (select field from p where n_present < n)
group by field having max(rate) > 0.9 and min(rate) < 0.1""")
def profile_discriminator_variance(spark, sf_dir):
    return PF.profile_discriminator_variance(docs(spark, sf_dir))


@query("profile_unknown_fields", with_views("transfers_o", extra={"p": _PRESENCE}) + f"""
select field from p where n_present > 0 and field not in ({_KNOWN}) order by field limit 25""")
def profile_unknown_fields(spark, sf_dir):
    return PF.profile_unknown_fields(docs(spark, sf_dir), "transfer")


@query("profile_canonical_resolution", with_views("transfers_o", extra={"canon": CANON_SQL}) + """
select 'partner_reference' as canonical, partner_reference_source as source, count(*) as n from canon group by 2
union all
select 'partner_txn_id' as canonical, partner_txn_id_source as source, count(*) as n from canon group by 2""")
def profile_canonical_resolution(spark, sf_dir):
    return PF.profile_canonical_resolution(docs(spark, sf_dir))


# --- files: sources and sinks ---------------------------------------------

def _write_ndjson(df_json, path):
    """NDJSON text files, with a whole-line comment row as exports carry."""
    spark = df_json.sparkSession
    header = spark.createDataFrame([("// export of transfer documents",)], "json string")
    header.unionByName(df_json).write.mode("overwrite").text(path)


DOC_IDS = with_views("transfers_o") + "select cast(_id as varchar) as doc_id, provider as paymentProvider from transfers_o"


def _ids(d):
    return d.select(X.read_field("doc", "_id", "string").alias("doc_id"),
                    X.read_field("doc", "paymentProvider", "string").alias("paymentProvider"))


@query("scan_json_docs", DOC_IDS)
def scan_json_docs(spark, sf_dir):
    path = scratch_path(spark, "transfers-ndjson")
    _write_ndjson(D.transfer_documents(spark, sf_dir), path)
    return _ids(D.read_documents(spark, path))


# provider groups written as separate exports under the fixed file names
EXPORT_FILES = {"omnex_transfers.json": ("1", "2"), "checkout_transfers.json": ("3", "4"),
                "nmi_transfers.json": ("5",)}


def _write_exports(spark, sf_dir):
    base = scratch_path(spark, "exports")
    j = D.transfer_documents(spark, sf_dir)
    prov = F.substring(F.get_json_object("json", "$.paymentProvider"), 1, 1)
    for name, prios in EXPORT_FILES.items():
        j.filter(prov.isin(*prios)).write.mode("overwrite").text(f"{base}/{name}")
    return base


@query("union_provider_exports", DOC_IDS)
def union_provider_exports(spark, sf_dir):
    base = _write_exports(spark, sf_dir)
    return _ids(D.read_documents(spark, D.collection_paths(spark, base, "transfer")))


#: documents in an array file at most
ARRAY_DOCUMENTS = 10_000


@query("scan_json_arrays", DOC_IDS)
def scan_json_arrays(spark, sf_dir):
    """The documents of some providers as lines, those of the others as JSON
    arrays in many files."""
    path = scratch_path(spark, "mixed-exports")
    j = D.transfer_documents(spark, sf_dir)
    own = F.coalesce(F.substring(F.get_json_object("json", "$.paymentProvider"), 1, 1), F.lit(""))
    D.export_lines(j.filter(own.isin("1", "2")), f"{path}/lines")
    some = F.floor(F.monotonically_increasing_id() / ARRAY_DOCUMENTS)
    arrays = j.filter(~own.isin("1", "2")).withColumn("part", some).groupBy("part").agg(F.collect_list("json").alias("all"))
    arrays.select("part", F.concat(F.lit("[\n"), F.array_join("all", ",\n"), F.lit("\n]")).alias("value")).write.partitionBy(
        "part").option("compression", "gzip").text(f"{path}/arrays")
    return _ids(D.read_documents(spark, [f"{path}/lines", f"{path}/arrays/*"]))


@query("scan_limit_per_source")
def scan_limit_per_source(spark, sf_dir):
    base = _write_exports(spark, sf_dir)
    return _ids(D.read_documents(spark, D.collection_paths(spark, base, "transfer"), limit_per_file=100))


SHEET_HEADERS = {"folio": "FOLIO (as the sender knows it)", "partner_txn": "UNIQUE TRNX ID @partner", "amount": "AMOUNT",
                 "observations": "Observations // Patterns", "rb_date": "RB_DATE", "agent": "AGENT_CODE"}


@query("chargeback_header_map", with_views("chargebacks_raw", extra={"cb": CHARGEBACKS}) + f"""
select partner_reference, partner_txn_id, {ts_sql('confirmed_date')} as confirmed_date, chargeback_amount, fraud_type
from cb""")
def chargeback_header_map(spark, sf_dir):
    path = scratch_path(spark, "partner-sheet")
    raw = FX.chargebacks_raw(spark, sf_dir).withColumn("agent", F.lit("AG01"))
    SH.write_sheet(raw, path, SHEET_HEADERS)
    parsed = LB.parse_chargebacks(SH.read_partner_sheet(spark, path), SALT)
    return parsed.select("partner_reference", "partner_txn_id", ts_text("confirmed_date").alias("confirmed_date"),
                         "chargeback_amount", "fraud_type")


AMOUNTS = with_views("transfers_o") + "select _id, send_amount from transfers_o"


@query("scan_parquet", AMOUNTS)
def scan_parquet(spark, sf_dir):
    base = scratch_path(spark, "table")
    FX.transfer_table(spark, sf_dir).select("_id", "send_amount").write.parquet(f"{base}.parquet")
    return TB.read_table(spark, base)


@query("sink_roundtrip", AMOUNTS)
def sink_roundtrip(spark, sf_dir):
    """Two batches into one table: the first fixes the schema, the second
    (amounts as text) is cast to it."""
    path = scratch_path(spark, "sink")
    t = FX.transfer_table(spark, sf_dir).select("_id", "send_amount", "date")
    cut = F.lit(FX.EXPORT_CUTOFF).cast("timestamp")
    TB.write_batch(t.filter(F.col("date") < cut).drop("date"), path)
    TB.write_batch(t.filter(~(F.col("date") < cut)).drop("date")
                    .withColumn("send_amount", F.col("send_amount").cast("string")), path)
    return spark.read.parquet(path)


@query("sink_batches", AMOUNTS)
def sink_batches(spark, sf_dir):
    """Batches with ids: one that comes twice is written once."""
    path = scratch_path(spark, "committed")
    t = FX.transfer_table(spark, sf_dir).select("_id", "send_amount", "date")
    cut = F.lit(FX.EXPORT_CUTOFF).cast("timestamp")
    old, new = t.filter(F.col("date") < cut).drop("date"), t.filter(~(F.col("date") < cut)).drop("date")
    for name, batch in (("new", new), ("old", old), ("new", new)):
        CM.commit_batch(batch, path, name)
    return CM.read_committed(spark, path)


@query("sink_if_absent", AMOUNTS)
def sink_if_absent(spark, sf_dir):
    path = scratch_path(spark, "stage")
    t = FX.transfer_table(spark, sf_dir).select("_id", "send_amount")
    TB.write_if_absent(t, path)
    TB.write_if_absent(t, path)        # output exists: skipped
    return spark.read.parquet(path)
