"""SimHash near-duplicates on a grid of segment popcounts.

A fingerprint of 64 bits is cut into 16 segments; the bit counts of the
segments are a point on the integer grid. The Manhattan distance of two points
is a lower bound of the bit distance of the fingerprints, so fingerprints at 2
bits or fewer are points at distance 2 or less, and such points have a common
grid neighbour (a cell within distance 1 of either). The range join is thus an
equality join: every distinct fingerprint is put in the at most 33 cells within
distance 1 of its point, and only cells with two fingerprints go on. There the
links are verified exactly: inside a cell a fingerprint is expanded to the (at
most 4) fingerprints of that cell that differ from it in one bit or none; two
fingerprints meet in one of these exactly if they differ in 2 bits or fewer.
Everything that meets in one is mutually linked, and that is at most 65
fingerprints, so a star to the smallest keeps all components and no list of
pairs is ever made, however many near copies there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhawk.llm.common import fresh, saved
from tallyhawk.llm.components import connected_components

BITS = 64
SEGMENT = 4
SHINGLE = 3
MAX_DISTANCE = 2
SEED = 42


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Majority bits of the XXH64 of all word shingles, as an unsigned number;
    fewer words than a shingle count as one, no words give zero."""
    import numpy as np
    from xxhash import xxh64_intdigest

    words = text.lower().split()  # on bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    first = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    last = ends[len(words) - n:].tolist()
    hashes = np.fromiter(map(xxh64_intdigest, map(joined.__getitem__, map(slice, first, last)), repeat(SEED)),
                         np.uint64, n)
    counts = np.zeros(BITS, np.int64)
    for i in range(0, n, 1 << 15):
        part = hashes[i:i + (1 << 15)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary() if batch.column(1).type == pa.string() else pa.large_binary())
            found = [fingerprint(t.as_py() or b"", shingle) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x - (1 << 64) if x >> 63 else x for x in found], pa.int64())], ["id", "fp"])
    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) of every row; fp as a signed long; null texts count as empty."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_fingerprints(shingle), "id long, fp long")


def segment_counts(fp: Column) -> Column:
    """Bit counts of the 16 segments, each in 4 bits of a long."""
    odd, pairs = F.lit(0x5555555555555555), F.lit(0x3333333333333333)
    low, high = fp.bitwiseAND(odd), F.shiftrightunsigned(fp, 1).bitwiseAND(odd)
    twos = low.bitwiseXOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))
    return twos.bitwiseAND(pairs) + F.shiftrightunsigned(twos, 2).bitwiseAND(pairs)


def _bit(n: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), n.cast("int"))


def links(fps: DataFrame) -> DataFrame:
    """(u, v) over distinct fingerprints (``fp``): a star over every set that
    meets in one fingerprint, for bit distance 2 or less."""
    # the cells within distance 1: k = 0 is the own one, then one up and one down per segment
    near = fps.select("fp", segment_counts(F.col("fp")).alias("own"),
                      F.explode(F.sequence(F.lit(0), F.lit(2 * BITS // SEGMENT))).alias("k"))
    near = near.withColumn("segment", F.floor((F.col("k") - 1) / 2).cast("int")).withColumn("up", F.col("k") % 2 == 1)
    step = _bit(F.col("segment") * 4)
    held = F.call_function("shiftrightunsigned", F.col("own"), F.greatest(F.col("segment"), F.lit(0)) * 4)
    held = held.bitwiseAND(F.lit(15).cast("long"))
    cells = (near.where((F.col("k") == 0) | F.when(F.col("up"), held < SEGMENT).otherwise(held > 0))
             .select("fp", "k", "segment", "up",
                     F.when(F.col("k") == 0, F.col("own")).when(F.col("up"), F.col("own") + step)
                     .otherwise(F.col("own") - step).alias("cell")))
    shared = cells.groupBy("cell").count().where("count > 1").select("cell")
    met = cells.join(shared, "cell", "left_semi")
    # the fingerprints of that cell which differ in one bit or none
    bits = met.select("fp", "k", "segment", "up", F.explode(F.sequence(F.lit(0), F.lit(SEGMENT - 1))).alias("b"))
    mask = _bit(F.greatest(F.col("segment"), F.lit(0)) * 4 + F.col("b"))
    is_set = F.col("fp").bitwiseAND(mask) != 0
    meets = (bits.where(F.when(F.col("k") == 0, F.col("b") == 0).otherwise(is_set != F.col("up")))
             .select("fp", F.when(F.col("k") == 0, F.col("fp")).otherwise(F.col("fp").bitwiseXOR(mask)).alias("at")))
    stars = meets.groupBy("at").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
    return (stars.select(F.array_min("fps").alias("v"), F.explode("fps").alias("u"))
            .where("u <> v").select("u", "v").distinct())


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, fp, component (smallest id reachable by
    links, itself included), group (a fingerprint that names the component).

    Equal fingerprints are one node, so exact copies cost nothing more. Null
    and empty texts have fingerprint zero and link like any other. Rows
    without an id link like any other but name no component, which is null if
    none of its rows has an id; repeated rows are rows like any other. No rows
    give no rows.
    """
    if max_distance != 2:
        raise ValueError("the grid is made for a bit distance of 2")
    rows = saved(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("id").alias("rep"))
    joined = connected_components(links(nodes.select("fp")))
    nodes = nodes.join(joined.select(F.col("node").alias("fp"), F.col("component").alias("root")), "fp", "left")
    nodes = nodes.withColumn("root", F.coalesce("root", "fp"))
    smallest = nodes.groupBy("root").agg(F.min("rep").alias("component"))
    names = nodes.join(smallest, "root").select("fp", "component", F.col("root").alias("group"))
    return rows.join(names, "fp", "left").select("id", "fp", "component", "group")


def one_per_group(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that stay: of each group the one with the smallest
    id, null ids last; of rows that share it one by the hash of the row."""
    groups = saved(simhash_groups(docs, id_col=id_col, **options), "simhash-groups")
    uid, best = fresh(docs, "uid", "best")
    if not groups.groupBy("id").count().where("count > 1 or id is null").limit(1).count():
        kept = groups.where("id = component").select(F.col("id").alias(uid))
        return docs.join(kept, docs[id_col] == F.col(uid), "left_semi")
    rows = saved(docs.withColumn(uid, F.monotonically_increasing_id()), "numbered-docs")
    groups = simhash_groups(rows, id_col=uid, **options).select(F.col("id").alias(uid), "group")
    rank = F.struct(F.col(id_col).isNull(), F.col(id_col), F.xxhash64(*[F.col(c) for c in docs.columns]), F.col(uid).alias("uid"))
    kept = (rows.select(uid, rank.alias(best)).join(groups, uid).groupBy("group").agg(F.min(best).alias(best))
            .select(F.col(f"{best}.uid").alias(uid)))
    return rows.join(kept, uid, "left_semi").select(*docs.columns)
