"""Labels from an append-only flag history and partner chargebacks.

Latest flag event per transfer is the verdict (flag -> 1 upheld, unflag -> 0
cleared); a matched chargeback overrides everything (1); a transfer with
neither is assumed legitimate (0) and marked as such.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhawk import contract as K
from tallyhawk.functions.columns import pseudonym, typology


class FlagHistoryError(ValueError):
    """The flag table cannot be turned into labels."""


def flag_history_checks(flags: DataFrame, transfer: str = "transfer", action: str = "action",
                        date: str = "flag_ts") -> DataFrame:
    """One row of counts for the shape checks that must all be zero."""
    ts = F.col(date).cast("timestamp") if date in flags.columns else F.lit(None)
    return flags.agg(
        F.count(F.lit(1)).alias("flag_rows"),
        F.count_if(F.col(transfer).isNull()).alias("null_transfer"),
        F.count_if(F.col(action).isNotNull() & ~F.col(action).isin("flag", "unflag")).alias("unexpected_action"),
        F.count_if(F.col(action).isNotNull() & ts.isNull()).alias("undated"),
    )


def check_flag_history(flags: DataFrame, **names) -> None:
    """Raise before the label job when the history is unusable (one
    aggregate row comes back to the driver)."""
    for col in (names.get("transfer", "transfer"),):
        if col not in flags.columns:
            raise FlagHistoryError(f"flag table has no {col!r} column")
    row = flag_history_checks(flags, **names).first()
    if row["null_transfer"]:
        raise FlagHistoryError(f"{row['null_transfer']} flag rows have a null transfer")
    if row["unexpected_action"]:
        raise FlagHistoryError(f"{row['unexpected_action']} flag rows have an action other than flag/unflag")
    if row["undated"]:
        raise FlagHistoryError(f"{row['undated']} flag rows have an unparseable date")


_SHIFT = "1000000000000000000000"   # 10^21: room for a sequence number below 10^20


def latest_flag_verdict(flags: DataFrame, transfer: str = "transfer", action: str = "action",
                        date: str = "flag_ts", seq: str | None = "seq") -> DataFrame:
    """Latest event per transfer by (date, seq, action).

    The order is packed into one decimal(38,0) key - microseconds x 10^21 +
    seq x 10 + (0 flag, 1 unflag) - so the latest event is a plain ``max``:
    a hash aggregate with map-side partial aggregation, and a transfer with
    a huge history costs one row per task before the shuffle. ``seq`` must
    be a non-negative integer below 10^20.

    Rows without an action are dropped. Any other action than flag or unflag,
    a null transfer and a missing date raise when the plan runs, so no label
    path can skip the checks.
    """
    latest = packed_events(flags, transfer, action, date, seq).groupBy("_id").agg(F.max("_k").alias("_k"))
    return unpacked_verdicts(latest)


def packed_events(flags: DataFrame, transfer: str = "transfer", action: str = "action",
                  date: str = "flag_ts", seq: str | None = "seq") -> DataFrame:
    """(_id, _k): the order key of every event with an action; checks as in
    :func:`latest_flag_verdict`. Without ``seq`` all sequence numbers are 0."""
    dec = "decimal(38,0)"
    stop = lambda what, kind: F.raise_error(F.lit(f"flag history: {what}")).cast(kind)
    us = F.coalesce(F.unix_micros(F.col(date).cast("timestamp")), stop("a row has no usable date", "bigint")).cast(dec)
    bit = (F.when(F.col(action) == "flag", F.lit(0)).when(F.col(action) == "unflag", F.lit(1))
           .otherwise(stop("an action is neither flag nor unflag", "int")).cast(dec))
    owner = F.coalesce(F.col(transfer), stop("a row has no transfer", flags.schema[transfer].dataType))
    number = F.coalesce(F.col(seq), F.lit(0)).cast(dec) if seq and seq in flags.columns else F.lit(0).cast(dec)
    return flags.filter(F.col(action).isNotNull()).select(
        owner.alias("_id"), (us * F.lit(_SHIFT).cast(dec) + number * 10 + bit).cast(dec).alias("_k"))


def unpacked_verdicts(latest: DataFrame) -> DataFrame:
    """_id, label, label_source, verdict_date of the greatest key per ``_id``."""
    dec = "decimal(38,0)"
    k = F.col("_k")
    label = F.when(F.pmod(k, F.lit(10).cast(dec)) == 0, F.lit(1)).otherwise(F.lit(0)).cast("int")
    return latest.select(
        "_id", label.alias("label"),
        F.when(label == 1, F.lit(K.SOURCE_UPHELD)).otherwise(F.lit(K.SOURCE_CLEARED)).alias("label_source"),
        F.timestamp_micros(F.floor(k / F.lit(_SHIFT).cast(dec)).cast("bigint")).alias("verdict_date"))


def flag_history_audit(flags: DataFrame, transfer: str = "transfer") -> DataFrame:
    per = flags.groupBy(transfer).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.count(F.lit(1)).alias("transfers_with_flag_history"),
                   F.count_if(F.col("n") > 1).alias("transfers_with_multiple_events"))


def parse_chargebacks(sheet: DataFrame, salt: str) -> DataFrame:
    """Logical sheet columns (folio, partner_txn, amount, observations or
    reason_code, rb_date) -> hashed join keys, confirmation date, magnitude
    of the debit and a coarse typology (reporting only, never a feature)."""
    cols = set(sheet.columns)
    if not ({"folio", "partner_txn"} & cols):
        raise ValueError(f"no join column found; saw {sorted(cols)}")
    null = F.lit(None).cast("string")
    out = {
        "partner_reference": pseudonym("folio", salt) if "folio" in cols else null,
        "partner_txn_id": pseudonym("partner_txn", salt) if "partner_txn" in cols else null,
    }
    if "rb_date" in cols:
        d = F.try_to_timestamp(F.col("rb_date"), F.lit("MM/dd/yy"))
        d = F.coalesce(d, F.try_to_timestamp(F.col("rb_date").cast("string")))
        # two-digit years resolve to within 50 years of today
        d = F.when(F.year(d) >= F.year(F.current_date()) + 50, F.add_months(d, -1200)).otherwise(d)
        out["confirmed_date"] = d
    else:
        out["confirmed_date"] = F.lit(None).cast("timestamp")
    out["chargeback_amount"] = (F.abs(F.col("amount").try_cast("double")) if "amount" in cols
                                else F.lit(None).cast("double"))
    if "reason_code" in cols:
        out["fraud_type"] = F.col("reason_code").cast("string")
    elif "observations" in cols:
        out["fraud_type"] = typology("observations")
    else:
        out["fraud_type"] = null
    return sheet.withColumns(out)


def canonical_keys(transfers: DataFrame, salt: str) -> DataFrame:
    """partner_reference / partner_txn_id: first non-null alias, hashed."""
    cols = {c.lower(): c for c in transfers.columns}
    out = {}
    for canon, aliases in K.CANONICAL.items():
        present = [F.col(cols[a.lower()]) for a in aliases if a.lower() in cols]
        val = F.coalesce(*present) if present else F.lit(None).cast("string")
        out[canon] = pseudonym(val, salt)
    return transfers.withColumns(out)


def match_to_transfers(cb: DataFrame, transfers: DataFrame) -> DataFrame:
    """Chargeback -> transfer ``_id`` by partner_reference, falling back to
    partner_txn_id. Each key resolves to its lowest ``_id`` (the lookup is a
    partial aggregate, one row per key)."""
    out = cb
    found = []
    for i, key in enumerate(["partner_reference", "partner_txn_id"]):
        if key not in transfers.columns or key not in cb.columns:
            continue
        lookup = (transfers.filter(F.col(key).isNotNull())
                           .groupBy(F.col(key).alias(f"_k{i}")).agg(F.min("_id").alias(f"_m{i}")))
        out = out.join(lookup, out[key] == lookup[f"_k{i}"], "left").drop(f"_k{i}")
        found.append(F.col(f"_m{i}"))
    matched = F.coalesce(*found) if found else F.lit(None)
    return out.withColumn("_id", matched).drop(*[f"_m{i}" for i in range(2)])


def chargeback_match_rate(matched: DataFrame) -> DataFrame:
    r = matched.agg(F.count(F.lit(1)).alias("chargebacks"),
                    F.count("_id").alias("matched"))
    rate = F.coalesce(F.try_divide(F.col("matched") * 100.0, F.col("chargebacks")), F.lit(0.0))
    return r.withColumns({"match_pct": rate, "low_match_warning": rate < 90})


def attach_labels(df: DataFrame, flags: DataFrame | None, chargebacks: DataFrame | None = None,
                  details: bool = False, **flag_names) -> DataFrame:
    """Left-join the label of each ``_id`` onto ``df`` (``_id`` first, then
    df's other columns, then label and label_source; with ``details`` also
    verdict_date and the verdict label before any chargeback override).

    The latest verdict and the chargeback hits are one row per ``_id``, so no
    row of ``df`` is repeated or lost, and a wide frame takes its labels in
    the same joins instead of joining a separately built label table.
    """
    return attach_verdicts(df, None if flags is None else latest_flag_verdict(flags, **flag_names), chargebacks, details)


def attach_verdicts(df: DataFrame, latest: DataFrame | None, chargebacks: DataFrame | None = None,
                    details: bool = False) -> DataFrame:
    """As :func:`attach_labels`, from verdicts that are there already."""
    if latest is not None:
        out = df.join(latest, "_id", "left")
    else:
        out = df.withColumns({"label": F.lit(None).cast("int"), "label_source": F.lit(None).cast("string"),
                              "verdict_date": F.lit(None).cast("timestamp")})
    if chargebacks is not None:
        hits = (chargebacks.filter(F.col("_id").isNotNull()).select("_id").distinct()
                           .withColumn("_cb", F.lit(True)))
        out = out.join(hits, "_id", "left")
        hit = F.coalesce(F.col("_cb"), F.lit(False))
    else:
        hit = F.lit(False)
    never = F.col("label").isNull()
    extra = ["verdict_date", F.col("label").alias("verdict_label")] if details else []
    return out.select(
        "_id", *[c for c in df.columns if c != "_id"],
        F.when(hit, F.lit(1)).when(never, F.lit(0)).otherwise(F.col("label")).cast("int").alias("label"),
        F.when(hit, F.lit(K.SOURCE_CHARGEBACK)).when(never, F.lit(K.SOURCE_ASSUMED))
         .otherwise(F.col("label_source")).alias("label_source"),
        *extra)


def label_details(flags: DataFrame | None, transfers: DataFrame,
                  chargebacks: DataFrame | None = None, **flag_names) -> DataFrame:
    """One row per transfer: _id, label, label_source, verdict_date, plus the
    verdict label before any chargeback override (for the audit)."""
    return attach_labels(transfers.select("_id"), flags, chargebacks, details=True, **flag_names)


def build_labels(flags: DataFrame | None, transfers: DataFrame,
                 chargebacks: DataFrame | None = None, **flag_names) -> DataFrame:
    return label_details(flags, transfers, chargebacks, **flag_names).drop("verdict_label")


def label_audit(details: DataFrame) -> DataFrame:
    src = F.col("label_source")
    r = details.agg(
        F.count(F.lit(1)).alias("total_transfers"),
        F.count_if(src == K.SOURCE_CHARGEBACK).alias("confirmed_fraud_chargeback"),
        F.count_if(src == K.SOURCE_UPHELD).alias("confirmed_fraud_upheld"),
        F.count_if(src == K.SOURCE_CLEARED).alias("confirmed_legit_reviewed"),
        F.count_if(src == K.SOURCE_ASSUMED).alias("assumed_legit_never_flagged"),
        F.count_if((src == K.SOURCE_CHARGEBACK) & (F.col("verdict_label") == 0)).alias("chargebacks_overriding_a_clear"),
        F.avg(F.col("label").cast("double")).alias("fraud_rate"),
        F.avg((src != K.SOURCE_ASSUMED).cast("double")).alias("coverage"))
    return r


def typology_mix(parsed: DataFrame) -> DataFrame:
    return parsed.groupBy("fraud_type").agg(F.count(F.lit(1)).alias("n"))


def orphan_flags(latest: DataFrame, transfers: DataFrame) -> DataFrame:
    return latest.select("_id").join(transfers.select("_id"), "_id", "left_anti")


def chargeback_hits(transfers: DataFrame, matched: DataFrame) -> DataFrame:
    ids = matched.filter(F.col("_id").isNotNull()).select("_id")
    return transfers.select("_id").join(ids, "_id", "left_semi")


def unmatched_chargebacks(matched: DataFrame, transfers: DataFrame) -> DataFrame:
    ids = matched.filter(F.col("_id").isNotNull()).select("_id").distinct()
    return ids.join(transfers.select("_id"), "_id", "left_anti")
