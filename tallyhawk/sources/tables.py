"""Table sources and sinks: Parquet first, CSV as fallback, schema fixed by
the first write, skip when the output already exists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def path_exists(spark: SparkSession, path: str) -> bool:
    """File-system metadata check on the driver (works for any Hadoop FS)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_table(spark: SparkSession, path_no_ext: str, schema: str | None = None) -> DataFrame:
    """``<path>.parquet`` if present, else ``<path>.csv`` (all-string unless a
    schema is given), else FileNotFoundError."""
    pq, csv = f"{path_no_ext}.parquet", f"{path_no_ext}.csv"
    if path_exists(spark, pq):
        return spark.read.parquet(pq)
    if path_exists(spark, csv):
        r = spark.read.option("header", "true").option("inferSchema", "false")
        return (r.schema(schema) if schema else r).csv(csv)
    raise FileNotFoundError(f"neither {pq} nor {csv} exists")


def write_batch(df: DataFrame, path: str) -> DataFrame:
    """Append a batch to a Parquet table. The first batch fixes the schema;
    later batches are cast to it (ANSI casts raise on a real conflict) and a
    column set that differs raises. Returns the batch as written."""
    spark = df.sparkSession
    if path_exists(spark, path):
        target = spark.read.parquet(path).schema
        names = [f.name for f in target.fields]
        if sorted(names) != sorted(df.columns):
            raise ValueError(f"batch columns {sorted(df.columns)} differ from table columns {sorted(names)}")
        batch = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.fields])
        batch.write.mode("append").parquet(path)
        return batch
    df.write.mode("overwrite").parquet(path)
    return df


def write_if_absent(df: DataFrame, path: str) -> bool:
    """Write unless the finished output exists; True when written (stage skip
    flag). A folder without the mark that a finished job leaves is what a
    killed job left, and is written anew."""
    if path_exists(df.sparkSession, f"{path.rstrip('/')}/_SUCCESS"):
        return False
    df.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(path)
    return True
