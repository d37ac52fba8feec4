"""Session helpers.

Library code never builds its own session: every operator takes DataFrames
and uses ``df.sparkSession``. These helpers are for tests, the bench and
command-line use.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql.types import NullType

# Settings the engine relies on. Times are UTC everywhere; AQE re-plans joins
# (broadcast only when runtime statistics prove the side small) and coalesces
# small shuffle partitions.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # the pseudonymisation salt is a literal in plans; keep it out of explain text
    "spark.sql.redaction.string.regex": "(?i)salt",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tallyhawk") -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    for k, v in ENGINE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used
    as is. Only on a local master (tests) a scratch folder is created when it is
    unset; on a cluster that would be a folder other machines cannot see.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if sc.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="tallyhawk-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory, for tables a
    job writes and reads back (derived documents, sheets, stream sinks)."""
    return f"{ensure_checkpoint_dir(spark)}/tables/{name}-{uuid.uuid4().hex[:12]}"


#: while a frame is fixed: times as 64 bits, and shuffle files go as soon as the rows are written
_FIXING = {"spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
           "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
_scopes = threading.local()


def _fixed(df):
    """(frame, folder that it lies in)."""
    spark = df.sparkSession
    if any(isinstance(f.dataType, NullType) for f in df.schema.fields):
        ensure_checkpoint_dir(spark)
        return df.checkpoint(eager=True), None  # Parquet knows no column without a type
    path = scratch_path(spark, "fixed")
    before = {k: spark.conf.get(k, None) for k in _FIXING}
    try:
        for k, v in _FIXING.items():
            spark.conf.set(k, v)
        df.write.option("compression", "zstd").parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path), path


def _passes(path: str | None) -> None:
    """The innermost open :func:`passing` block, if any, removes the folder."""
    if path and getattr(_scopes, "open", None):
        _scopes.open[-1].append(path)


def materialize(df, stays: bool = False):
    """Cut lineage for a frame read by several passes: compressed columns in
    the shared checkpoint folder (survive executor loss, and a pass reads only
    the columns that it needs). ``stays``: beyond a :func:`passing` block."""
    found, path = _fixed(df)
    _passes(None if stays else path)
    return found


@contextmanager
def passing(spark: SparkSession):
    """What is materialized inside is removed at the end of the block: no
    frame that is used later may read it."""
    if not hasattr(_scopes, "open"):
        _scopes.open = []
    _scopes.open.append([])
    try:
        yield
    finally:
        for path in _scopes.open.pop():
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def settled(spark: SparkSession, build, stays: bool = True):
    """The frame ``build()``, materialized; what was materialized on the way is
    removed. Unless it ``stays``, an outer :func:`passing` block removes it."""
    with passing(spark):
        found, path = _fixed(build())
    _passes(None if stays else path)
    return found
