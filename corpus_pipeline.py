"""Corpus pipeline: quality filter, near-duplicate and repeat removal, source
mix, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet in the shared folder and reads it back as the next one's ``docs``.
All but the last stage return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhawk.llm import bpe, mixing, quality, simhash, suffixes
from tallyhawk.llm.common import fresh, saved, table

#: no SQL: the first and the last stage run a trained network and a tokenizer
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents scored below the threshold go."""
    model = quality.fit(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    (score,) = fresh(docs, "score")
    return (quality.with_score(docs, model, out_col=score).where(F.col(score) >= quality.THRESHOLD)
            .select(*docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash: of each group of near-duplicates the document with the smallest id stays."""
    return simhash.one_per_group(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Suffix arrays: strings of 100 bytes that occur earlier are cut out; n_chars follows the text."""
    out = suffixes.without_repeats(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Systematic sampling: each document as often as the mix takes it."""
    return mixing.mix(docs)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str, path: str | None = None) -> DataFrame:
    """BPE: ids of every text (ids, n_tokens) and, in place of the text, what they decode to."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.encode(docs, path, decoded_col="text").withColumn("n_tokens", F.size("ids"))


STAGES = [
    ("quality classifier", keep_good),
    ("SimHash near-dedup", drop_near_copies),
    ("suffix-array dedup", drop_repeats),
    ("source mix", mix_sources),
    ("BPE tokens", to_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        docs = saved(stage(spark, docs, sf_dir), f"stage-{n}")
    return docs
