"""Point-in-time features and the training table.

Cardinal rule: a feature for a transfer at time T uses only rows before T.
Velocity frames end one microsecond before the row (ties excluded, lower
bound included); recipient history counts strictly earlier sends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from tallyhawk import contract as K
from tallyhawk.functions.columns import (US_PER_HOUR, days_between, epoch_us, hour_of,
                                         is_legacy_code, lenient_timestamp, strip_ws, weekday_of)
from tallyhawk.operators.ranking import exclusive_prefix, range_bucket
from tallyhawk.operators.timeframes import Frame, with_ranged_frames, with_time_frames

TIME = "_t"


def as_timestamp(df: DataFrame, col: str) -> Column:
    """Typed time columns cast directly; strings parsed leniently (bad -> null)."""
    if isinstance(df.schema[col].dataType, (TimestampType, TimestampNTZType, DateType)):
        return F.col(col).cast("timestamp")
    return lenient_timestamp(col)


def derive_time_features(df: DataFrame, time_col: str = "date") -> DataFrame:
    """Lenient UTC timestamp ``_t`` plus hour and weekday (Monday = 0)."""
    t = as_timestamp(df, time_col)
    return df.withColumn(TIME, t).withColumns({"hour": hour_of(TIME), "weekday": weekday_of(TIME)})


def add_account_ages(df: DataFrame) -> DataFrame:
    """Ages at transfer time from immutable creation dates (tier-1 safe)."""
    specs = [("user__raw_dateCreated", "user_age_days", 1.0),
             ("recipient__raw_date_created", "recipient_age_days", 1.0),
             ("user__raw_dob", "user_age_years", 365.25)]
    cols = {name: days_between(F.col(TIME), as_timestamp(df, src)) / F.lit(div)
            for src, name, div in specs if src in df.columns}
    return df.withColumns(cols) if cols else df


def negative_age_audit(df: DataFrame) -> DataFrame:
    """Count of rows whose referenced record was created after the transfer."""
    names = [c for c in ("user_age_days", "recipient_age_days", "user_age_years") if c in df.columns]
    return df.agg(*[F.count_if(F.col(c) < 0).alias(f"negative_{c}") for c in names])


def derive_user_features(df: DataFrame) -> DataFrame:
    cols = {}
    if {"user__raw_threshold_level", "user__raw_remainingBalance"} <= set(df.columns):
        lvl = F.col("user__raw_threshold_level").try_cast("double")
        rem = F.col("user__raw_remainingBalance").try_cast("double")
        total = lvl + rem
        cols["limit_utilisation"] = F.when(total > 0, lvl / total)
    if {"user__raw_billing_address", "user_country"} <= set(df.columns):
        b = F.upper(strip_ws("user__raw_billing_address"))
        a = F.upper(strip_ws("user_country"))
        cols["billing_country_match"] = F.when(b.isNotNull() & a.isNotNull() & (a != ""),
                                               b.endswith(a).cast("double"))
    return df.withColumns(cols) if cols else df


def derive_transfer_features(df: DataFrame, prefix_len: int = 6) -> DataFrame:
    cols = {}
    if "_raw_previous_recipient" in df.columns:
        cols["n_previous_recipients"] = F.coalesce(F.size("_raw_previous_recipient"), F.lit(0)).cast("bigint")
    if "_raw_isEnabled3Ds" in df.columns:
        cols["threeds_reported"] = F.col("_raw_isEnabled3Ds").isNotNull().cast("bigint")
    if {"_raw_ipDetails__location__country", "sending_from"} <= set(df.columns):
        ipc = F.lower(strip_ws("_raw_ipDetails__location__country"))
        dec = F.lower(strip_ws("sending_from"))
        same = F.substring(ipc, 1, prefix_len) == F.substring(dec, 1, prefix_len)
        cols["ip_country_mismatch"] = F.when(ipc.isNotNull() & dec.isNotNull(), (~same).cast("double"))
    if "send_amount" in df.columns:
        amt = F.col("send_amount").try_cast("double")
        cols["cents"] = amt - F.floor(amt)
    out = df.withColumns(cols) if cols else df
    return out.drop(*[c for c in out.columns if "_raw_" in c])


def normalize_description_code(df: DataFrame, col: str = "description_code") -> DataFrame:
    """24-hex legacy object ids collapse into one 'legacy' value."""
    if col not in df.columns:
        return df
    return df.withColumn(col, F.when(is_legacy_code(col), F.lit("legacy")).otherwise(F.col(col)))


def code_format_ratio(df: DataFrame, col: str = "description_code") -> DataFrame:
    """Short-code / legacy / missing counts and rates, with the majority alert."""
    c = F.col(col)
    legacy = F.count_if(is_legacy_code(col))
    missing = F.count_if(c.isNull())
    total = F.count(F.lit(1))
    r = df.agg(total.alias("total"), legacy.alias("legacy_n"), missing.alias("missing_n"))
    return r.select(
        "total", (F.col("total") - F.col("legacy_n") - F.col("missing_n")).alias("known_n"),
        "legacy_n", "missing_n",
        F.try_divide(F.col("legacy_n"), F.col("total")).alias("legacy_rate"),
        F.coalesce(F.try_divide(F.col("legacy_n"), F.col("total")) > K.LEGACY_RATE_ALERT,
                   F.lit(False)).alias("legacy_alert"))


def add_velocity_features(df: DataFrame, key: str = "user_id", time_col: str = TIME,
                          amount_col: str = "send_amount", windows=K.VELOCITY_WINDOWS_HOURS,
                          bucket_us: int | None = None, ranges: int | None = None) -> DataFrame:
    """Trailing count and sum of ``amount_col`` per key over each window
    (hours), excluding the current row and same-time rows; empty -> 0.
    Rows with no key or time get 0. All windows share one exchange and sort.

    With ``ranges`` rows are dealt by (key, time) into about so many ranges
    instead of by time buckets: for data where one key may hold more rows in
    two weeks than a task should (see :func:`~tallyhawk.operators.timeframes.with_ranged_frames`).
    """
    frames = []
    for h in windows:
        w = int(h) * US_PER_HOUR
        frames.append(Frame(f"{key}_txn_{h}h", "count", "_amt", -w, -1))
        frames.append(Frame(f"{key}_amt_{h}h", "sum", "_amt", -w, -1))
    d = df.withColumns({"_us": epoch_us(time_col), "_amt": F.col(amount_col).try_cast("double")})
    out = (with_time_frames(d, key, "_us", frames, bucket_us=bucket_us) if ranges is None
           else with_ranged_frames(d, key, "_us", frames, ranges))
    fills = {}
    for f in frames:
        zero = F.lit(0).cast("bigint") if f.agg == "count" else F.lit(0.0)
        fills[f.name] = F.coalesce(F.col(f.name), zero)
    return out.withColumns(fills).drop("_us", "_amt")


def add_recipient_history(df: DataFrame, user: str = "user_id", recipient: str = "recipient_id",
                          time_col: str = TIME, id_col: str = "_id", buckets: int | None = None) -> DataFrame:
    """Prior sends by this user to this recipient (strictly earlier in
    (time nulls last, id) order) and the first-send flag.

    Rows are put into ranges of (user, recipient, time, id), whose edges follow
    the data, so a pair with very many rows, in one day or without a time,
    spans as many ranges as it fills, as do rows without a user or a recipient.
    Counts per pair and range are prefix-summed, then rows are numbered inside
    their range.
    """
    d = df.withColumn("_hus", epoch_us(time_col))
    order = [F.col("_hus").asc_nulls_last(), F.col(id_col).asc()]
    d = range_bucket(d, [F.col(user), F.col(recipient), *order], "_hb", buckets)
    out = exclusive_prefix(d, order, "_hb", {"prior_sends_to_recipient": F.lit(1).cast("bigint")}, keys=[user, recipient])
    return (out.withColumn("is_first_send_to_recipient",
                           (F.col("prior_sends_to_recipient") == 0).cast("bigint"))
               .drop("_hus", "_hb"))


def one_per_id(df: DataFrame, key: str = "_id") -> DataFrame:
    """One row per key: of rows that differ the greatest, column by column in
    the order of the frame, so the choice does not depend on the run."""
    rest = [c for c in df.columns if c != key]
    best = df.groupBy(key).agg(F.max(F.struct(*rest)).alias("_row")) if rest else df.select(key).distinct()
    return best.select(*[F.col(c) if c == key else F.col(f"_row.{c}").alias(c) for c in df.columns])


def conflicting_ids(df: DataFrame, key: str = "_id") -> DataFrame:
    """Number of keys whose rows differ (one row); more than zero means that
    an export is inconsistent and :func:`one_per_id` had to choose."""
    digest = F.xxhash64(*[F.col(c) for c in df.columns])
    per = df.groupBy(key).agg(F.min(digest).alias("lo"), F.max(digest).alias("hi"))
    return per.agg(F.count_if(F.col("lo") != F.col("hi")).alias("conflicting_ids"))


def enrich_transfers(transfers: DataFrame, users: DataFrame | None, recipients: DataFrame | None,
                     labels) -> DataFrame:
    """Left-join user (``user_`` prefix) and recipient (``recipient_``
    prefix) columns, then labels: a label table joined on ``_id``, or a
    function that attaches label columns (``labels.attach_labels``). The
    right sides keep one row per key (:func:`one_per_id`) so a repeated key can
    never fan transfers out; AQE picks broadcast or sort-merge from runtime sizes."""
    df = transfers
    if users is not None:
        u = one_per_id(users)
        u = u.select(*[F.col(c).alias("user_id" if c == "_id" else f"user_{c}") for c in u.columns])
        df = df.join(u, "user_id", "left")
    if recipients is not None:
        r = one_per_id(recipients)
        ren = {"_id": "recipient_id", "recipient_email_domain": "recipient_email_domain",
               "bank_name": "recipient_doc_bank_name"}
        r = r.select(*[F.col(c).alias(ren.get(c, f"recipient_{c}")) for c in r.columns])
        df = df.join(r, "recipient_id", "left")
    if callable(labels) and not isinstance(labels, DataFrame):
        df = labels(df)          # attaches label columns in place (one row per _id)
    elif labels is not None:
        df = df.join(one_per_id(labels.select("_id", "label", "label_source")), "_id", "left")
    return df


def join_match_rate(enriched: DataFrame) -> DataFrame:
    ucol, rcol = "user__raw_dateCreated", "recipient__raw_date_created"
    r = enriched.agg(F.count(F.lit(1)).alias("transfers"),
                     (F.avg(F.col(ucol).isNotNull().cast("double")) * 100).alias("user_match_pct"),
                     (F.avg(F.col(rcol).isNotNull().cast("double")) * 100).alias("recipient_match_pct"))
    return r.withColumn("low_match_warning",
                        (F.col("user_match_pct") < 50) | (F.col("recipient_match_pct") < 50))


IDENTITY_DROP = ["_id", "user_id", "recipient_id", TIME, "user_user_id", "recipient_user_id",
                 "partner_reference", "partner_txn_id"]


def assemble(transfers: DataFrame, users: DataFrame | None, recipients: DataFrame | None,
             labels, keep_ids: bool = False) -> DataFrame:
    """Full training table: time, velocity and history on the transfers,
    then enrich, ages, user, transfer (strips staging), code; identities
    dropped at the end.

    Velocity and history need only transfer columns, so they run before the
    enrichment joins, and the history's ranges are fixed on the narrow transfer
    projection instead of the joined rows.
    The left joins keep every transfer exactly once (deduplicated right
    sides), so the order does not change any value. Columns keep the order
    enrich -> time -> derived -> velocity -> history.
    """
    timed = derive_time_features(transfers)
    base = add_recipient_history(add_velocity_features(timed, key="user_id"))
    df = assemble_windowed(base, transfers.columns, users, recipients, labels)
    if keep_ids:
        return df
    return df.drop(*[c for c in IDENTITY_DROP if c in df.columns])


def assemble_windowed(base: DataFrame, raw: list[str], users: DataFrame | None, recipients: DataFrame | None,
                      labels) -> DataFrame:
    """The training table, ids kept, of transfers (columns ``raw``) that
    already have their time, velocity and history columns."""
    known = set(raw)
    moved = [c for c in base.columns if c not in known]
    df = enrich_transfers(base, users, recipients, labels)
    joined = df.columns
    df = add_account_ages(df)
    df = derive_user_features(df)
    df = derive_transfer_features(df)
    df = normalize_description_code(df)
    kept = set(df.columns)
    times = [c for c in (TIME, "hour", "weekday") if c in moved]
    derived = [c for c in df.columns if c not in set(joined)]
    return df.select(*[c for c in joined if c in kept and c not in moved], *times, *derived, *[c for c in moved if c not in times])
