"""Schema-variance profile of raw documents.

Top-level key presence, fields that appear almost always for one value of a
discriminator and almost never for another, fields outside the contract and
canonical-alias resolution. All are aggregations over the exploded keys of
each document; nothing is held in memory per collection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhawk import contract as K
from tallyhawk.operators.extract import canonical_sources, read_field


def known_fields(doc_type: str) -> list[str]:
    known = {f.split(".")[0] for f, *_ in K.CONTRACTS.get(doc_type, [])}
    known |= {f.split(".")[0] for f in K.DROPPED.get(doc_type, [])}
    known |= {a for aliases in K.CANONICAL.values() for a in aliases}
    return sorted(known)


def _keys(docs: DataFrame, doc: str = "doc", extra: dict | None = None) -> DataFrame:
    return docs.select(*[c.alias(n) for n, c in (extra or {}).items()],
                       F.explode(F.map_keys(F.try_variant_get(F.col(doc), "$", "map<string,variant>"))).alias("field"))


def profile_presence(docs: DataFrame, doc_type: str, doc: str = "doc") -> DataFrame:
    spark = docs.sparkSession
    total = docs.agg(F.count(F.lit(1)).alias("_n"))
    counts = _keys(docs, doc).groupBy("field").agg(F.count(F.lit(1)).alias("n_present"))
    known = spark.createDataFrame([(k,) for k in known_fields(doc_type)], "field string") \
                 .withColumn("in_contract", F.lit(True))
    # one-row total: broadcast (never a constant-key shuffle)
    out = (counts.withColumn("_one", F.lit(1)).join(F.broadcast(total.withColumn("_one", F.lit(1))), "_one")
                 .join(F.broadcast(known), "field", "left"))          # contract-sized table
    return out.select("field", "n_present", (F.col("n_present") / F.col("_n")).alias("rate"),
                      (F.col("n_present") < F.col("_n")).alias("variable"),
                      F.coalesce(F.col("in_contract"), F.lit(False)).alias("in_contract"))


def profile_discriminator_variance(docs: DataFrame, doc_type: str = "transfer", doc: str = "doc",
                                   discriminators: list[str] | None = None) -> DataFrame:
    """(discriminator, field, present_in): variable fields present on > 90%
    of one discriminator value's documents and < 10% of another's. A missing
    discriminator is the group 'None'."""
    from tallyhawk.session import materialize
    names = list(discriminators or K.DISCRIMINATORS)
    groups = F.array(*[F.struct(F.lit(d).alias("discriminator"),
                                F.coalesce(read_field(doc, d, "string"), F.lit("None")).alias("grp")) for d in names])
    keys = F.coalesce(F.map_keys(F.try_variant_get(F.col(doc), "$", "map<string,variant>")), F.array().cast("array<string>"))
    # one scan: per document and discriminator its fields, and a null field that counts the document itself
    counts = (docs.select(groups.alias("gs"), F.concat(keys, F.array(F.lit(None).cast("string"))).alias("fs"))
              .select("fs", F.explode("gs").alias("g")).select("g.*", F.explode("fs").alias("field"))
              .groupBy("discriminator", "grp", "field").agg(F.count(F.lit(1)).alias("c")))
    counts = materialize(counts)        # a row per group and field: all that follows reads this
    sizes = counts.filter(F.col("field").isNull()).select("discriminator", "grp", F.col("c").alias("size"))
    present = counts.filter(F.col("field").isNotNull())
    whole = sizes.groupBy("discriminator").agg(F.sum("size").alias("docs"), F.count(F.lit(1)).alias("groups"))
    seen = (present.filter(F.col("field") == F.substring_index("discriminator", ".", 1))
            .select("discriminator").distinct())
    rates = present.join(sizes, ["discriminator", "grp"]).withColumn("rate", F.col("c") / F.col("size"))
    often = F.when(F.col("rate") > 0.9, F.col("grp"))
    per = rates.groupBy("discriminator", "field").agg(
        F.sum("c").alias("n"), F.max("rate").alias("most"), F.min("rate").alias("least"), F.count(F.lit(1)).alias("in_groups"),
        F.array_sort(F.collect_list(often)).alias("often"))      # at most a value per group of the discriminator
    least = F.when(F.col("in_groups") < F.col("groups"), F.lit(0.0)).otherwise(F.col("least"))
    return (per.join(whole, "discriminator").join(seen, "discriminator", "left_semi")
            .filter((F.col("groups") >= 2) & (F.col("n") < F.col("docs")) & (F.col("most") > 0.9) & (least < 0.1))
            .select("discriminator", "field", F.concat_ws(",", "often").alias("present_in")))


def profile_unknown_fields(docs: DataFrame, doc_type: str, doc: str = "doc", top_n: int = 25) -> DataFrame:
    """Top-level fields outside the contract (dropped by the allowlist),
    first ``top_n`` by name."""
    spark = docs.sparkSession
    known = spark.createDataFrame([(k,) for k in known_fields(doc_type)], "field string")
    keys = _keys(docs, doc).select("field").distinct()
    return keys.join(F.broadcast(known), "field", "left_anti").orderBy("field").limit(top_n)


def profile_canonical_resolution(docs: DataFrame, doc: str = "doc") -> DataFrame:
    src = canonical_sources(docs, doc)
    parts = [src.groupBy(F.col(f"{canon}_source").alias("source")).agg(F.count(F.lit(1)).alias("n"))
                .withColumn("canonical", F.lit(canon)) for canon in K.CANONICAL]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("canonical", "source", "n")
