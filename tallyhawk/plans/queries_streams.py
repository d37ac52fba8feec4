"""Streaming queries: transfers arrive in deliveries, out of order by up to a
day and a half, and each delivery is drained by a run of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhawk.operators.incremental import DailyFeatures
from tallyhawk.plans.catalog import query
from tallyhawk.plans.oracle_views import with_views
from tallyhawk.session import scratch_path
from tallyhawk.sources import fixtures as FX
from tallyhawk.streaming import history as H

HOURS_LATE, DELIVERIES = 36, 3


def deliveries(transfers: DataFrame, time_col: str):
    """The transfers in the order in which they arrive, a frame per delivery,
    then a row that moves the clock past the last one."""
    arrival = F.col(time_col).cast("timestamp") + F.make_dt_interval(hours=F.pmod(F.xxhash64("_id"), F.lit(HOURS_LATE)).cast("int"))
    placed = transfers.withColumn("_arrives", F.unix_seconds(arrival))
    lo, hi = placed.agg(F.min("_arrives"), F.max("_arrives")).first()
    if lo is None:
        yield transfers
        return
    width = (hi - lo) // DELIVERIES + 1
    for n in range(DELIVERIES):
        yield placed.filter(F.floor((F.col("_arrives") - lo) / width) == n).drop("_arrives")
    clock = transfers.sparkSession.range(1).select(*[
        (F.timestamp_seconds(F.lit(hi + 60 * 86_400)).cast(f.dataType) if f.name == time_col else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in transfers.schema.fields])
    yield clock


def drained(transfers: DataFrame, time_col: str, job) -> DataFrame:
    """What ``job(stream, sink, checkpoint)`` has written after all deliveries."""
    spark = transfers.sparkSession
    src, sink, checkpoint = (scratch_path(spark, f"stream-{n}") for n in ("in", "out", "ckpt"))
    for delivery in deliveries(transfers, time_col):
        delivery.write.mode("append").parquet(src)
        job(spark.readStream.schema(transfers.schema).parquet(src), sink, checkpoint)
    return spark.read.parquet(sink)


def _history(spark, sf_dir):
    def job(stream, sink, checkpoint):
        H.run_to_parquet(H.stream_history(stream, f"{HOURS_LATE} hours", time_col="txn_ts"), sink, checkpoint)
    return drained(FX.transfers_e(spark, sf_dir), "txn_ts", job)


_WINDOWS = {h: h * 3_600_000_000 for h in (1, 24, 168)}
_SUMS = ", ".join(
    f"cast(case when user_id is null then 0 else count(send_amount) over w{h} end as bigint) as user_id_txn_{h}h, "
    f"round(case when user_id is null then 0 else coalesce(sum(send_amount) over w{h}, 0) end, 2) as user_id_amt_{h}h" for h in _WINDOWS)
_FRAMES = ", ".join(f"w{h} as (partition by user_id order by _us range between {w} preceding and 1 preceding)" for h, w in _WINDOWS.items())


@query("stream_velocity", with_views("transfers_e") + f"""
select _id, {_SUMS} from (select *, epoch_us(cast(txn_ts as timestamp)) as _us from transfers_e) v window {_FRAMES}""")
def stream_velocity(spark, sf_dir):
    out = _history(spark, sf_dir)
    return out.select("_id", *[c for h in _WINDOWS for c in (
        F.col(f"user_id_txn_{h}h"), F.round(f"user_id_amt_{h}h", 2).alias(f"user_id_amt_{h}h"))])


@query("stream_prior_sends", with_views("transfers_e") + """
select _id, prior as prior_sends_to_recipient, cast(prior = 0 as bigint) as is_first_send_to_recipient
from (select _id, row_number() over (partition by user_id, recipient_id order by txn_ts, _id) - 1 as prior from transfers_e) x""")
def stream_prior_sends(spark, sf_dir):
    return _history(spark, sf_dir).select("_id", "prior_sends_to_recipient", "is_first_send_to_recipient")


@query("incremental_features", with_views("transfers_e") + f"""
select _id, {_SUMS}, prior as prior_sends_to_recipient, cast(prior = 0 as bigint) as is_first_send_to_recipient
from (select *, epoch_us(cast(txn_ts as timestamp)) as _us,
             row_number() over (partition by user_id, recipient_id order by txn_ts nulls last, _id) - 1 as prior from transfers_e) v
window {_FRAMES}""")
def incremental_features(spark, sf_dir):
    """The features of all transfers, taken in by deliveries that re-open only the days they reach."""
    kept = DailyFeatures(spark, scratch_path(spark, "daily"), time_col="txn_ts")
    *batches, _ = deliveries(FX.transfers_e(spark, sf_dir), "txn_ts")
    for n, batch in enumerate(batches):
        kept.add(batch, f"delivery-{n}")
    return kept.features().select("_id", *[c for h in _WINDOWS for c in (
        F.col(f"user_id_txn_{h}h"), F.round(f"user_id_amt_{h}h", 2).alias(f"user_id_amt_{h}h"))],
        "prior_sends_to_recipient", "is_first_send_to_recipient")


@query("stream_score", with_views("transfers_o") + "select _id, true as as_batch from transfers_o")
def stream_score(spark, sf_dir):
    """Raw transfers scored as they arrive get the scores that the batch path gives."""
    from tallyhawk.plans.queries_features import training_table
    from tallyhawk.plans.queries_ml import bundle_of
    from tallyhawk.streaming.jobs import stream_score as run
    bundle = bundle_of(spark, sf_dir)

    def job(stream, sink, checkpoint):
        run(stream, sink, checkpoint, lambda: bundle, lambda: FX.user_table(spark, sf_dir),
            lambda: FX.recipient_table(spark, sf_dir), f"{HOURS_LATE} hours")
    live = drained(FX.transfer_table(spark, sf_dir), "date", job)
    want = bundle.score(training_table(spark, sf_dir, keep_ids=True), keep=["_id"])
    both = live.join(want.select("_id", F.col("probability").alias("p"), F.col("risk_band").alias("b"),
                                 F.col("features_provided").alias("n")), "_id", "full")
    same = (F.abs(F.col("probability") - F.col("p")) < 1e-9) & (F.col("risk_band") == F.col("b")) & (F.col("features_provided") == F.col("n"))
    return both.select("_id", F.coalesce(same, F.lit(False)).alias("as_batch"))
