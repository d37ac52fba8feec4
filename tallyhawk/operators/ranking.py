"""Exact prefix sums and ranks without a single-task sort.

A window with ``orderBy`` but no ``partitionBy`` moves every row into one
task. Instead rows are put into ordered buckets (a function of the order key
that never decreases along the order), totals per bucket are prefix-summed on
a table with one row per bucket, and each row adds its bucket offset to a
running sum inside its own bucket. Bucket edges follow the data. Exact, and the per-bucket work spreads
over the cluster. With grouping keys the bucket table has one row per (key,
bucket) and a hot key is spread over its buckets.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def range_bucket(df: DataFrame, order: list[Column], out: str, buckets: int | None = None) -> DataFrame:
    """Add ``out``, a bucket number that never decreases along ``order``.

    Spark's range partitioner picks the bucket edges from a sample, so buckets
    hold about as many rows each wherever the values lie, and equal values are
    split by the later order columns. The number of buckets is that of the
    session's shuffle partitions unless given; partitions may be merged at run
    time when they are small. The numbers are fixed in the shared folder:
    computed anew, edges could move.
    """
    from tallyhawk.session import materialize
    ranged = df.repartitionByRange(buckets, *order) if buckets else df.repartitionByRange(*order)
    return materialize(ranged.withColumn(out, F.spark_partition_id().cast("bigint")))


def exclusive_prefix(df: DataFrame, order: list[Column], bucket: str,
                     sums: dict[str, Column], keys: list[str] | None = None) -> DataFrame:
    """Add, for each name in ``sums``, the total of that expression over rows
    that come strictly before this row in ``order`` (within ``keys``).

    ``bucket`` names a column that never decreases along ``order``; ``order``
    must be unique within keys so "before" is well defined. The bucket table
    joins on (keys, bucket), the same keys the final window partitions on, so
    the exchange is shared; its size is left to the runtime to judge.
    """
    keys = list(keys or [])
    vals = {f"_v_{n}": e for n, e in sums.items()}
    d = df.withColumns(vals)
    per_bucket = d.groupBy(*keys, bucket).agg(*[F.sum(c).alias(f"_t_{c}") for c in vals])
    wb = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(*keys, bucket, *[
        F.coalesce(F.sum(f"_t_{c}").over(wb), F.lit(0)).alias(f"_o_{c}") for c in vals])
    if keys:
        joined = d.join(offsets.withColumnsRenamed({k: f"_k_{k}" for k in keys}).withColumnRenamed(bucket, "_kb"),
                        [d[k].eqNullSafe(F.col(f"_k_{k}")) for k in keys] + [d[bucket] == F.col("_kb")], "left") \
                  .drop(*[f"_k_{k}" for k in keys], "_kb")
    else:
        joined = d.join(offsets, bucket, "left")
    wi = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = joined.withColumns({
        n: F.coalesce(F.sum(f"_v_{n}").over(wi), F.lit(0)) + F.coalesce(F.col(f"_o__v_{n}"), F.lit(0))
        for n in sums})
    return out.drop(*vals.keys(), *[f"_o_{c}" for c in vals])


def global_rank(df: DataFrame, order: list[Column], out: str = "_rank", buckets: int | None = None) -> DataFrame:
    """0-based position of each row in ``order`` (unique), in two levels."""
    d = range_bucket(df, order, "_bk", buckets)
    return exclusive_prefix(d, order, "_bk", {out: F.lit(1).cast("bigint")}).drop("_bk")


def row_at(df: DataFrame, order: list[str], positions: list[int] | Callable[[int, int], list[int]],
           buckets: int | None = None) -> list:
    """The rows (columns ``order`` only) at 0-based positions of the ascending
    order of those columns, null for a position past the end. ``positions``
    may be a function of the number of rows and of those without a first
    column. Only these columns are shuffled; one count per bucket and one row
    per position come back, and the search inside buckets is one job that sees
    no other bucket."""
    from tallyhawk.session import passing
    with passing(df.sparkSession):
        return _row_at(range_bucket(df.select(*order), [F.col(c).asc() for c in order], "_bk", buckets), order, positions)


def _row_at(d: DataFrame, order: list[str], positions: list[int] | Callable[[int, int], list[int]]) -> list:
    sizes = d.groupBy("_bk").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(order[0]).isNull()).alias("bad")).orderBy("_bk").collect()
    if callable(positions):
        positions = positions(sum(r["n"] for r in sizes), sum(r["bad"] for r in sizes))
    wanted, before = {}, 0
    for r in sizes:
        wanted.update({p: (r["_bk"], p - before) for p in positions if before <= p < before + r["n"]})
        before += r["n"]
    if not wanted:
        return [None] * len(positions)
    nth = F.row_number().over(Window.partitionBy("_bk").orderBy(*order)) - 1
    inside = d.filter(F.col("_bk").isin(*{b for b, _ in wanted.values()})).withColumn("_nth", nth)
    hit = F.lit(False)
    for b, n in set(wanted.values()):
        hit = hit | ((F.col("_bk") == b) & (F.col("_nth") == n))
    found = {(r["_bk"], r["_nth"]): r for r in inside.filter(hit).collect()}
    return [found.get(wanted.get(p)) for p in positions]
