"""Labels kept up to date by batches.

Two committed tables hold what the label sources have said so far:

- verdicts: per transfer the greatest event (date, seq and action packed into
  one number) and how many events there were, in hash buckets;
- charged: the distinct key pairs of all chargebacks, in hash buckets.

A batch merges by maximum, sum and union and rewrites only the buckets that its
rows fall into; its id is committed with them, so a batch that comes twice
counts once, and the order of batches makes no difference. Labels are the
verdicts and the matched chargebacks joined onto the transfers, by the same
code that builds them from whole histories; a transfer that arrives after its
chargeback is matched like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhawk.operators import labels as LB
from tallyhawk.sources.commits import commit_slots, read_committed

BUCKETS = 64
_KEYS = ["partner_reference", "partner_txn_id"]


class LabelState:
    """The label tables below one folder. ``buckets`` is fixed by the first
    batch and must be given the same later."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def _bucket(self, *cols: str):
        return F.pmod(F.xxhash64(*cols), F.lit(self.buckets))

    def add_flags(self, flags: DataFrame, batch_id: str, **names) -> bool:
        """Take in flag events; False if the batch was taken in before. Bad
        rows raise, and nothing of their batch counts."""
        from tallyhawk.session import materialize
        events = LB.packed_events(flags, **names)
        new = materialize(events.groupBy("_id").agg(F.max("_k").alias("_k"), F.count(F.lit(1)).alias("events"))
                          .withColumn("bucket", self._bucket("_id")))

        def merge(old, new):
            both = new if old is None else old.unionByName(new)
            return both.groupBy("bucket", "_id").agg(F.max("_k").alias("_k"), F.sum("events").alias("events"))
        return commit_slots(new, f"{self.path}/verdicts", batch_id, "bucket", merge)

    def add_chargebacks(self, parsed: DataFrame, batch_id: str) -> bool:
        """Take in parsed chargebacks; those without any key match nothing."""
        from tallyhawk.session import materialize
        keys = parsed.select(*[F.col(k).cast("string").alias(k) for k in _KEYS])
        new = materialize(keys.where(F.coalesce(*_KEYS).isNotNull()).distinct().withColumn("bucket", self._bucket(*_KEYS)))

        def merge(old, new):
            return (new if old is None else old.unionByName(new)).distinct()
        return commit_slots(new, f"{self.path}/charged", batch_id, "bucket", merge)

    def verdicts(self) -> DataFrame | None:
        """The latest verdict per transfer."""
        kept = read_committed(self.spark, f"{self.path}/verdicts")
        return None if kept is None else LB.unpacked_verdicts(kept)

    def details(self, transfers: DataFrame) -> DataFrame:
        """What :func:`~tallyhawk.operators.labels.label_details` gives for all history so far."""
        charged = read_committed(self.spark, f"{self.path}/charged")
        matched = None if charged is None else LB.match_to_transfers(charged, transfers)
        return LB.attach_verdicts(transfers.select("_id"), self.verdicts(), matched, details=True)

    def labels(self, transfers: DataFrame) -> DataFrame:
        return self.details(transfers).drop("verdict_label")

    def audit(self) -> DataFrame:
        """Counts of :func:`~tallyhawk.operators.labels.flag_history_audit`, of events with an action."""
        kept = read_committed(self.spark, f"{self.path}/verdicts")
        if kept is None:
            kept = self.spark.createDataFrame([], "events long")
        return kept.agg(F.count(F.lit(1)).alias("transfers_with_flag_history"),
                        F.count_if(F.col("events") > 1).alias("transfers_with_multiple_events"))
