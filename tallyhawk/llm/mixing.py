"""Mixing sources to target weights by systematic sampling.

Within its source every document is expected ``target / source_size`` times.
Documents are laid out by (size, md5 of the id, id); the running sum of the
expected copies plus one random offset per source crosses some integers, and a
document is emitted once per integer crossed. Laying them out by size keeps the
words taken from a source within about one longest document of its target.

The running sum needs no task that holds a whole source: ranks come from counts
per (source, size), then per (source, size, three hex digits of the md5), and
only then from a window inside one such piece.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhawk.llm.common import fresh, null_key, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2
HEX_DIGITS = 3


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
                   most: int = MOST_COPIES) -> DataFrame:
    """Words to take from each source.

    ``sizes``: one row per source (``key``, ``source``, ``source_size``).
    Sources in code point order, null last, get ``weights`` in turn and share
    ``share`` times all sizes; no target is above ``most`` times its source,
    and what is cut off there is shared anew by weight. With sources in order
    of cap per weight the common level of those that are not cut is the largest
    of (words left) / (weights left), so no loop is needed. The frame has one
    row per source, which is all that the windows without a key see.
    """
    n = len(weights)
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), (F.col("place") % n + 1).cast("int"))
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before = F.coalesce(F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.col("all_weights") - F.coalesce(
        F.sum("weight").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (sizes.withColumn("place", place).withColumn("weight", w)
            .withColumn("cap", F.col("source_size") * most)
            .withColumn("all_sizes", F.sum("source_size").over(whole))
            .withColumn("all_weights", F.sum("weight").over(whole))
            .withColumn("level", (F.col("all_sizes") * F.lit(float(share)) - before) / left)
            .withColumn("level", F.max("level").over(whole))
            .select("key", "source", "source_size",
                    F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level")).alias("target")))


def with_copies(docs: DataFrame, seed: int = 7, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
                most: int = MOST_COPIES, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source") -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the columns size, source_size, target and copies (long),
    under names that clash with none of its own; returns the names too.

    Every row of ``docs`` is kept, with 0 to ``most`` copies. Null and empty
    texts have size 0; a null source is a source of its own; repeated rows are
    rows like any other; null ids come first among equal sizes. No rows give
    no rows. The same rows and seed give the same copies in any partitioning.
    """
    key, size, digest, piece, off, rank, ssz, target, copies, u = fresh(
        docs, "key", "size", "digest", "piece", "off", "rank", "source_size", "target", "copies", "u")
    sized = (docs.withColumn(key, null_key(source_col)).withColumn(size, word_count(text_col))
             .withColumn(digest, F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
             .withColumn(piece, F.substring(digest, 1, HEX_DIGITS)))
    # 1. counts, first per piece, then per size, then per source
    pieces = sized.groupBy(key, size, piece).agg(F.count("*").alias("n"), F.first(source_col).alias("source"))
    steps = pieces.groupBy(key, size).agg(F.sum("n").alias("n"), F.first("source").alias("source"))
    totals = steps.groupBy(F.col(key).alias("key")).agg(
        F.sum(F.col(size) * F.col("n")).alias("source_size"), F.first("source").alias("source"))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{int(seed)}:"), F.col("key"))), 1, 8), 16, 10)
    targets = (source_targets(totals, weights, share, most)
               .select(F.col("key").alias(key), F.col("source_size").alias(ssz), F.col("target").alias(target),
                       (offset.cast("double") / 4294967296.0).alias(u)))
    upto = (Window.unboundedPreceding, -1)
    steps = (steps.withColumn("before", F.coalesce(F.sum("n").over(
        Window.partitionBy(key).orderBy(size).rowsBetween(*upto)), F.lit(0))).drop("n", "source")
        .join(targets, key))
    pieces = (pieces.withColumn(off, F.coalesce(F.sum("n").over(
        Window.partitionBy(key, size).orderBy(piece).rowsBetween(*upto)), F.lit(0))).drop("n", "source")
        .join(steps, [key, size]).withColumn(off, F.col(off) + F.col("before")).drop("before"))
    # 2. ranks of the rows, and the integers that the running sum crosses
    within = Window.partitionBy(key, size, piece).orderBy(digest, id_col)
    crossed = lambda r: F.floor(r * F.col(target) / F.col(ssz) + F.col(u))
    out = (sized.join(pieces, [key, size, piece])
           .withColumn(rank, F.row_number().over(within) + F.col(off))
           .withColumn(copies, F.when(F.col(ssz) == 0, F.lit(0))
                       .when(F.col(target) >= F.col(ssz) * most, F.lit(most))
                       .otherwise(crossed(F.col(rank)) - crossed(F.col(rank) - 1)).cast("long"))
           .select(*docs.columns, size, ssz, target, copies))
    return out, {"size": size, "source_size": ssz, "target": target, "copies": copies}


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the columns of ``docs``, each row once per copy."""
    out, names = with_copies(docs, **options)
    (nth,) = fresh(out, "nth")
    return (out.where(F.col(names["copies"]) > 0)
            .withColumn(nth, F.explode(F.sequence(F.lit(1).cast("long"), F.col(names["copies"]))))
            .select(*docs.columns))
