"""Bindings from the driver's tables to the shapes the operators consume.

Each function reads the given parquet tables and derives one logical input
(transfers, flags, chargeback sheet, users, recipients, scored population).
Everything is lazy column arithmetic over whole tables: no id subsets, no
row caps. The oracle side holds the same definitions as SQL text
(``tallyhawk.plans.oracle_views``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# FIXED VALUES: the pseudonymisation salt used for the fixture runs. Real runs
# pass their own salt from configuration.
FIXTURE_SALT = "fixture-salt-7f3a"

# Transfers exported up to this date form the "partial export" used by the
# orphan / unmatched checks (flags and chargebacks may point past it).
EXPORT_CUTOFF = "1998-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def transfers_e(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Microsecond-grained transfers from ``events`` (no (user, ts) ties)."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("_id"),
        F.col("user_id"),
        F.regexp_extract("props", "[0-9]+", 0).try_cast("bigint").alias("recipient_id"),
        F.col("ts").alias("txn_ts"),
        F.col("value").alias("send_amount"),
        F.col("event_type").alias("provider"),
    )


def transfers_o(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day-grained transfers from ``orders`` with provider-variant reference
    fields, fee, realised amount, 3DS flag, previous-recipient list and the
    IP / declared origin countries (from the 25-row ``nation`` dimension)."""
    o = table(spark, sf_dir, "orders")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    ip_n = nation.select(F.col("n_nationkey").alias("_ipk"), F.col("n_name").alias("ip_country"))
    from_n = nation.select(F.col("n_nationkey").alias("_fromk"), F.col("n_name").alias("sending_from"))
    prio = F.substring("o_orderpriority", 1, 1)
    key = F.col("o_orderkey")
    base = o.select(
        key.alias("_id"),
        F.col("o_custkey").alias("user_id"),
        (key % 120).alias("recipient_id"),
        F.col("o_orderdate").alias("txn_ts"),
        F.col("o_totalprice").alias("send_amount"),
        F.col("o_orderpriority").alias("provider"),
        F.when(prio.isin("1", "2"), F.concat(F.lit("JP"), key.cast("string"))).alias("omnexpaymentid"),
        F.when(prio == "3", F.concat(F.lit("R"), key.cast("string"))).alias("payment_receipt_number"),
        F.when(prio != "5", F.concat(F.lit("T"), key.cast("string"))).alias("transaction_id"),
        F.when(F.col("o_orderstatus") == "F", F.lit("64383D62a8649c1fe6386962"))
         .when(F.col("o_orderstatus") == "P", F.lit("10")).alias("description_code"),
        (F.col("o_totalprice") / 100).alias("transfer_fee"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("amount_paid"),
        F.when(prio == "2", (key % 2) == 0).alias("isenabled3ds"),
        F.when(F.col("o_orderstatus") != "O",
               F.array_repeat((key % 120).cast("string"), (key % 4).cast("int"))).alias("previous_recipient"),
        (key % 25).cast("int").alias("_ipk"),
        (F.col("o_custkey") % 25).cast("int").alias("_fromk"),
    )
    # nation has 25 rows at every scale: a fixed-size broadcast
    return (base.join(F.broadcast(ip_n), "_ipk", "left")
                .join(F.broadcast(from_n), "_fromk", "left")
                .drop("_ipk", "_fromk"))


def flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append-only flag history: returned line items flag their order,
    accepted ones clear it; ``seq`` orders events on the same date."""
    li = table(spark, sf_dir, "lineitem")
    return (li.filter(F.col("l_returnflag").isin("A", "R"))
              .select(F.col("l_orderkey").alias("transfer"),
                      F.when(F.col("l_returnflag") == "R", "flag").otherwise("unflag").alias("action"),
                      F.col("l_shipdate").alias("flag_ts"),
                      F.col("l_linenumber").alias("seq")))


def chargebacks_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partner chargeback sheet for pending orders: noisy case/space in ids,
    some without a match, some without any key."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    prio = F.substring("o_orderpriority", 1, 1)
    ks = key.cast("string")
    obs = (F.when(key % 7 == 0, "Error code 43 - Stolen Card.")
            .when(key % 7 == 1, "Unauthorized transaction reported by cardholder.")
            .when(key % 7 == 2, "Romance scam reported by victim.")
            .when(key % 7 == 3, "Account takeover - credentials compromised.")
            .when(key % 7 == 4, "no clear pattern")
            .when(key % 7 == 5, "First party misuse - not recognised by customer."))
    return (o.filter(F.col("o_orderstatus") == "P")
             .select(
                 F.when(key % 400 == 3, F.concat(F.lit("JPX"), ks))
                  .when(prio.isin("1", "2"), F.concat(F.lit("  jp"), ks, F.lit(" ")))
                  .when(prio == "3", F.concat(F.lit("r"), ks)).alias("folio"),
                 F.when(prio == "4", F.concat(F.lit(" T"), ks)).alias("partner_txn"),
                 F.concat(F.lit("-"), F.floor("o_totalprice").cast("bigint").cast("string")).alias("amount"),
                 obs.alias("observations"),
                 F.date_format(F.date_add(F.col("o_orderdate").cast("date"), 45), "MM/dd/yy").alias("rb_date"),
             ))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    nat = F.concat(F.lit("N"), F.col("c_nationkey").cast("string"))
    return c.select(
        k.alias("user_id"),
        F.date_add(F.lit("1990-01-01").cast("date"), (k % 1500).cast("int")).alias("datecreated"),
        nat.alias("country"),
        F.concat(F.col("c_name"), F.lit(", "), F.when(k % 3 == 0, F.lit("XX")).otherwise(nat)).alias("billing_address"),
        F.col("c_acctbal").alias("threshold_level"),
        F.when(k % 10 == 0, F.lit(0) - F.col("c_acctbal")).otherwise(F.lit(5000.0)).alias("remainingbalance"),
        F.concat(F.lit("user"), k.cast("string"), F.lit("@"), F.col("c_mktsegment"), F.lit(".COM ")).alias("email"),
    )


def recipients(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select(
        k.alias("recipient_id"),
        F.date_add(F.lit("1994-06-01").cast("date"), (k * 7 % 400).cast("int")).alias("date_created"),
        F.concat(F.lit("bank"), (k % 30).cast("string")).alias("bank_name"),
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored population: three-decimal scores shifted up for positives."""
    e = table(spark, sf_dir, "events")
    y = F.when(F.col("event_type") == "error", 1).otherwise(0)
    return e.select(
        F.col("event_id").alias("id"),
        y.alias("y"),
        ((250 * y + (F.col("event_id") * 7919) % 750).cast("double") / 1000).alias("score"),
        F.col("value").alias("amount"),
        (F.col("user_id") % 10).cast("string").alias("segment"),
        F.col("ts"),
        F.col("user_id"),
    )


def scored_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scored population with rows that have no score, null or NaN."""
    s = scored(spark, sf_dir)
    return s.withColumn("score", F.when(F.col("id") % 13 == 5, F.lit(float("nan"))).when(F.col("id") % 7 != 2, F.col("score")))


# --- contract-shaped tables (what extraction produces) ----------------------

def transfer_table(spark: SparkSession, sf_dir: str, salt: str = FIXTURE_SALT) -> DataFrame:
    from tallyhawk.operators.labels import canonical_keys
    t = canonical_keys(transfers_o(spark, sf_dir), salt)
    return t.select(
        "_id", "user_id", "recipient_id", F.col("txn_ts").alias("date"), "send_amount",
        "amount_paid", "transfer_fee", F.col("provider").alias("paymentProvider"),
        "description_code", "sending_from", "partner_reference", "partner_txn_id",
        F.col("isenabled3ds").alias("_raw_isEnabled3Ds"),
        F.col("previous_recipient").alias("_raw_previous_recipient"),
        F.col("ip_country").alias("_raw_ipDetails__location__country"))


def user_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = users(spark, sf_dir)
    return u.select(F.col("user_id").alias("_id"), F.col("datecreated").alias("_raw_dateCreated"),
                    "country", F.col("billing_address").alias("_raw_billing_address"),
                    F.col("threshold_level").alias("_raw_threshold_level"),
                    F.col("remainingbalance").alias("_raw_remainingBalance"))


def recipient_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = recipients(spark, sf_dir)
    return r.select(F.col("recipient_id").alias("_id"), F.col("date_created").alias("_raw_date_created"),
                    "bank_name")


def exported_transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partial export: transfers dated before the cutoff."""
    return transfer_table(spark, sf_dir).filter(F.col("date") < F.lit(EXPORT_CUTOFF).cast("timestamp"))
