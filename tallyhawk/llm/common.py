"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhawk.session import ensure_checkpoint_dir

#: one run of characters other than ASCII white space
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it
    back: cuts the lineage, and survives the loss of executors."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *bases: str) -> list[str]:
    """Working column names that clash with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    names = []
    for base in bases:
        name = f"_{base}"
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        names.append(name)
    return names


def word_count(text: Column | str) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def null_key(c: Column | str) -> Column:
    """A never-null text that tells a null from every string, for joins."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), c.cast("string")))


def cut(batch: pa.RecordBatch, sizes: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most`` of ``sizes`` at most, one row at least."""
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield batch.slice(at, to - at)
        at = to
