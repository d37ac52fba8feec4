"""Velocity and recipient history kept up to date day by day.

Three committed tables, each with a slot per day: the transfers, the number of
sends per (user, recipient), and the transfers with their features. A batch
re-opens the days that its rows reach and no others:

- its own days, and the days after them as far as the longest window reaches;
- for history, later days that hold a pair of the batch (for a batch that is
  not late there are none).

A re-opened day reads itself, the days before it that its windows reach, and
the daily counts of its pairs; files of other days are not listed. What is
written does not depend on how the transfers were split into batches.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tallyhawk import contract as K
from tallyhawk.operators.features import add_velocity_features, as_timestamp
from tallyhawk.operators.ranking import exclusive_prefix, range_bucket
from tallyhawk.session import materialize
from tallyhawk.sources.commits import commit_slots, read_committed, read_manifest

#: the day of transfers without a usable time; sorts behind all days
NO_DAY = "none"


def day_of(t: Column) -> Column:
    return F.coalesce(F.date_format(t, "yyyy-MM-dd"), F.lit(NO_DAY))


def _shifted(day: str, days: int) -> str:
    return str(dt.date.fromisoformat(day) + dt.timedelta(days=days))


class DailyFeatures:
    """The three tables below one folder."""

    def __init__(self, spark: SparkSession, path: str, time_col: str = "date", id_col: str = "_id", user: str = "user_id",
                 recipient: str = "recipient_id", amount: str = "send_amount", windows=K.VELOCITY_WINDOWS_HOURS):
        self.spark, self.path = spark, path.rstrip("/")
        self.time_col, self.id_col, self.pair, self.amount, self.windows = time_col, id_col, [user, recipient], amount, windows
        #: days before or after a day that its windows can touch
        self.reach = -(-max(windows) // 24)

    def _table(self, name: str, slots: list[str] | None = None) -> DataFrame | None:
        return read_committed(self.spark, f"{self.path}/{name}", slots)

    def _days(self) -> list[str]:
        return sorted(read_manifest(self.spark, f"{self.path}/transfers").live)

    def add(self, transfers: DataFrame, batch_id: str) -> list[str]:
        """Take in transfers; returns the days that were written anew, none
        for a batch that was taken in before. A run that was killed between
        the tables is finished by giving the batch again."""
        new = materialize(transfers.withColumn("day", day_of(as_timestamp(transfers, self.time_col))))
        commit_slots(new, f"{self.path}/transfers", batch_id, "day", lambda old, rows: rows if old is None else old.unionByName(rows))
        own = sorted(r[0] for r in new.select("day").distinct().collect())     # a row per day
        if not own:
            return []
        counts = self._table("transfers", own).groupBy("day", *self.pair).agg(F.count(F.lit(1)).alias("sends"))
        commit_slots(counts, f"{self.path}/pairs", batch_id, "day")
        days = self._reached(new, own)
        rows = self._rows(days)
        return days if commit_slots(rows, f"{self.path}/features", batch_id, "day") else []

    def _reached(self, new: DataFrame, own: list[str]) -> list[str]:
        there = self._days()
        near = {_shifted(d, n) for d in own if d != NO_DAY for n in range(self.reach + 1)}
        first = own[0]
        later = [d for d in there if d > first]
        first_of = new.groupBy(*self.pair).agg(F.min("day").alias("from_day"))
        held = self._table("pairs", later)
        same = [held[c].eqNullSafe(first_of[c]) for c in self.pair]
        far = held.join(first_of, [*same, held["day"] > first_of["from_day"]], "left_semi").select("day").distinct()
        return [d for d in there if d in near or d in own or d in {r[0] for r in far.collect()}]

    def _rows(self, days: list[str]) -> DataFrame:
        behind = {_shifted(d, -n) for d in days if d != NO_DAY for n in range(1, self.reach + 1)}
        source = self._table("transfers", [d for d in self._days() if d in behind or d in days])
        t = as_timestamp(source, self.time_col)
        timed = source.withColumn("_t", t)
        out = add_velocity_features(timed, key=self.pair[0], time_col="_t", amount_col=self.amount, windows=self.windows)
        out = out.filter(F.col("day").isin(days))
        order = [F.col("_t").asc_nulls_last(), F.col(self.id_col).asc()]
        keys = [*self.pair, "day"]
        ranged = range_bucket(out, [*[F.col(k) for k in keys], *order], "_hb")
        ranked = exclusive_prefix(ranged, order, "_hb", {"_today": F.lit(1).cast("bigint")}, keys=keys).drop("_hb", "_t")
        # sends of the pair on earlier days: only pairs and days that are there, a row each
        counts = self._table("pairs", [d for d in self._days() if d <= max(days)])
        before = Window.partitionBy(*self.pair).orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
        carried = (counts.withColumn("_before", F.coalesce(F.sum("sends").over(before), F.lit(0)))
                   .filter(F.col("day").isin(days)).select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_before"))
        joined = ranked.join(carried, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys], "left").drop(*[f"_k_{k}" for k in keys])
        prior = F.col("_today") + F.coalesce("_before", F.lit(0))
        return (joined.withColumn("prior_sends_to_recipient", prior)
                .withColumn("is_first_send_to_recipient", (F.col("prior_sends_to_recipient") == 0).cast("bigint"))
                .drop("_today", "_before"))

    def features(self, days: list[str] | None = None) -> DataFrame:
        """The transfers with their features, of some days or of all."""
        return self._table("features", days).drop("day")
