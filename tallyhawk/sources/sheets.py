"""Partner chargeback sheets with drifting headers.

Headers are resolved on the driver (names only): each logical column takes
the first header whose normalised text contains one of its aliases, trying
aliases in order. The sheet is read all-string, so ids never turn into
numbers and a blank cell is null, not "nan".
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhawk import contract as K

CSV_OPTIONS = {"header": "true", "inferSchema": "false",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def header_map(columns: list[str]) -> dict[str, str]:
    """Logical column -> header. Every (alias, header) pair that fits is
    ranked by the place of the alias, then of the header; the first wins."""
    plain = [" ".join(str(c).split()).lower() for c in columns]
    ranked = {key: [(a, h) for a, alias in enumerate(aliases) for h, text in enumerate(plain) if alias in text]
              for key, aliases in K.COLUMN_ALIASES.items()}
    return {key: columns[min(pairs)[1]] for key, pairs in ranked.items() if pairs}


def logical_sheet(raw: DataFrame) -> DataFrame:
    """Select the recognised columns under their logical names."""
    m = header_map(raw.columns)
    if "folio" not in m and "partner_txn" not in m:
        raise ValueError(f"no join column found; saw {raw.columns}")
    return raw.select(*[F.col(f"`{c}`").alias(k) for k, c in m.items()])


def read_partner_sheet(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.options(**CSV_OPTIONS).csv(path)
    return logical_sheet(raw)


def write_sheet(df: DataFrame, path: str, headers: dict[str, str]) -> None:
    """Write a sheet as CSV with the given header names (column -> header)."""
    out = df.select(*[F.col(c).alias(h) for c, h in headers.items()])
    out.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
