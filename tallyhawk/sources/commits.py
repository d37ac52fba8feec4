"""Tables that change by whole batches.

A table is a folder with data folders and one small manifest per version. The
manifest names the batches that are done and, per slot, the folder that holds
its rows. A batch writes its rows into a folder of its own and becomes visible
when the next manifest is put in place by a rename that fails if another
writer was first (then the batch looks at what that writer left and tries
again). So a killed batch leaves nothing that a reader sees, a batch id that is
done is not written twice, and readers keep the version they began with.

The rename must be atomic and refuse a target that exists, as on HDFS; on other
file systems one writer at a time must be arranged.

A slot is a batch of an appended table, or a partition of a table whose
partitions are replaced (a hash bucket, a day).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SLOT = "slot"


@dataclass
class Manifest:
    version: int = 0
    schema: str | None = None
    done: list[str] = field(default_factory=list)
    live: dict[str, str] = field(default_factory=dict)  # slot -> folder below the table


class Conflict(Exception):
    """Another writer has put the next version in place."""


def _fs(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def read_manifest(spark: SparkSession, path: str) -> Manifest:
    """The latest version; version 0 of a table that is not there yet."""
    fs, top = _fs(spark, f"{path}/_manifests")
    names = [s.getPath().getName() for s in fs.listStatus(top)] if fs.exists(top) else []
    names = [n for n in names if n.endswith(".json") and n[:-5].isdigit()]
    if not names:
        return Manifest()
    fs, where = _fs(spark, f"{path}/_manifests/{max(names)}")
    stream = fs.open(where)
    try:
        return Manifest(**json.loads(bytes(stream.readAllBytes()).decode()))
    finally:
        stream.close()


def _put_manifest(spark: SparkSession, path: str, m: Manifest) -> None:
    fs, draft = _fs(spark, f"{path}/_manifests/draft-{uuid.uuid4().hex}")
    final = _fs(spark, f"{path}/_manifests/{m.version:012d}.json")[1]
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(m.__dict__).encode()))
    out.close()
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise Conflict(f"version {m.version} of {path} is there already")


def read_committed(spark: SparkSession, path: str, slots: list[str] | None = None) -> DataFrame | None:
    """The rows of the latest version (of some slots only, if given): only the
    folders of these slots are listed and read. None before the first batch."""
    m = read_manifest(spark, path)
    if m.schema is None:
        return None
    schema = StructType.fromJson(json.loads(m.schema))
    folders = [f"{path}/{m.live[s]}" for s in (m.live if slots is None else slots) if s in m.live]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def commit_batch(df: DataFrame, path: str, batch_id: str) -> bool:
    """Append a batch; False if it was done before. The first batch fixes the
    schema; a later one is cast to it, and other columns raise."""
    return _commit(df.sparkSession, path, batch_id, lambda _: df.withColumn(SLOT, F.lit(batch_id)), [batch_id])


def commit_slots(df: DataFrame, path: str, batch_id: str, slot: str,
                 merge: Callable[[DataFrame | None, DataFrame], DataFrame] | None = None) -> bool:
    """Replace the slots that the rows of ``df`` are in (column ``slot``); all
    other slots stay as they are. ``merge(old, new)`` makes the new rows of the
    touched slots from their old ones (None for a new table) and ``df``; it is
    run again if another writer came first. The number of slots is the
    caller's choice and must be bounded."""
    spark = df.sparkSession
    found = [r[0] for r in df.select(F.col(slot).cast("string")).distinct().collect()]
    if None in found:
        raise ValueError(f"rows without a {slot} belong to no slot")
    touched = sorted(found)

    def rows(_):
        new = df if merge is None else merge(read_committed(spark, path, touched), df)
        return new.withColumn(SLOT, F.col(slot).cast("string"))
    return _commit(spark, path, batch_id, rows, touched)


def _commit(spark: SparkSession, path: str, batch_id: str, rows: Callable, touched: list[str]) -> bool:
    path = path.rstrip("/")
    while True:
        m = read_manifest(spark, path)
        if batch_id in m.done:
            return False
        df = rows(m)
        data = df.drop(SLOT)
        schema = data.schema
        if m.schema is not None:
            schema = StructType.fromJson(json.loads(m.schema))
            if sorted(schema.fieldNames()) != sorted(data.columns):
                raise ValueError(f"batch columns {sorted(data.columns)} differ from table columns {sorted(schema.fieldNames())}")
            df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields], SLOT)
        folder = f"data/{uuid.uuid4().hex}"
        numbers = {s: n for n, s in enumerate(touched)}  # folder names that any slot value can have
        stray = F.raise_error(F.lit("a merged row is in a slot that the batch does not touch")).cast("int")
        known = F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair]) if touched else None
        number = stray if known is None else F.coalesce(F.try_element_at(known, F.col(SLOT)), stray)
        df.withColumn(SLOT, number).write.partitionBy(SLOT).parquet(f"{path}/{folder}")
        fs, _ = _fs(spark, path)
        live = dict(m.live)
        for s, n in numbers.items():
            if fs.exists(_fs(spark, f"{path}/{folder}/{SLOT}={n}")[1]):
                live[s] = f"{folder}/{SLOT}={n}"
            else:
                live.pop(s, None)
        nullable = StructType.fromJson(json.loads(schema.json()))
        for f in nullable.fields:
            f.nullable = True
        try:
            _put_manifest(spark, path, Manifest(m.version + 1, json.dumps(nullable.jsonValue()), [*m.done, batch_id], live))
            return True
        except Conflict:
            continue
