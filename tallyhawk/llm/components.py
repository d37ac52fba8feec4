"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhawk.llm.common import saved


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v: long) to (node, component): one row per node that has a
    link to another, with the smallest node it can reach.

    Each round hangs the larger neighbours of a node on its smallest neighbour
    (large star), then the smaller neighbours and the node itself on the
    smallest (small star); the number of rounds grows with the logarithm of
    the longest chain. Neighbourhoods are never gathered: a round is two sums
    per key and two joins, so a node with very many links is split like any
    skewed join key. Rounds are written to the shared folder. Null ends and
    loops are ignored.
    """
    now = saved(edges.where("u <> v").select(F.greatest("u", "v").alias("hi"), F.least("u", "v").alias("lo"))
                .distinct(), "links")
    state = None
    while (new := tuple(now.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first())) != state:
        state = new
        if not state[0]:
            break
        both = now.select(F.col("lo").alias("u"), F.col("hi").alias("v")).union(now.select("hi", "lo"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (now.join(least, now["lo"] == least["u"]).select("hi", F.col("m").alias("lo"))
                 .where("hi <> lo").distinct())
        large = saved(large, "links")
        least = large.groupBy(F.col("hi").alias("u")).agg(F.min("lo").alias("m"))
        small = (large.join(least, large["hi"] == least["u"]).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
                 .where("hi <> lo").union(least.select("u", "m")).distinct())
        now = saved(small, "links")
    roots = now.select("lo").distinct().select(F.col("lo").alias("node"), F.col("lo").alias("component"))
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(roots)
