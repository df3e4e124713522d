"""Session settings the library relies on, and the shared scratch location."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Settings that results depend on (time zone) or that the plans are written for (AQE).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # The JVM never compiles methods above 8000 bytes of bytecode. Wide cleaning projections can get
    # there; Spark then does better with smaller generated methods than with one interpreted one.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app: str = "barloom", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or fetch) a session carrying the required settings plus ``conf``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**REQUIRED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_session(spark: SparkSession) -> SparkSession:
    """Apply the required runtime settings to a session somebody else created."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    A temporary folder serves only where driver and executors are one process (tests, local runs);
    on a cluster each machine would write to a disk of its own, so there the setting is demanded.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="barloom-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other call uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


#: Copies made by ``cut_lineage`` that nobody has removed yet.
_COPIES: set[str] = set()


def cut_lineage(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there, with a plan that starts at a scan.

    Parquet rather than ``checkpoint()``: later steps read only the columns they need. Results that
    are still to be read need the copy, so it stays until ``remove_copies`` (or the caller) removes it.
    """
    path = path or scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    _COPIES.add(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def temporary_copies(spark: SparkSession):
    """Remove the copies that are made inside the block, also when it fails, but for paths added to the set it yields."""
    before, keep = set(_COPIES), set()
    try:
        yield keep
    finally:
        for path in _COPIES - before - keep:
            remove_path(spark, path)


def remove_copies(spark: SparkSession) -> int:
    """Remove all copies made so far; results built on them can no longer be read. Returns how many."""
    paths = set(_COPIES)
    for path in paths:
        remove_path(spark, path)
    return len(paths)


def hadoop_path(spark: SparkSession, path: str):
    """The path and its file system, as Hadoop objects."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    target, fs = hadoop_path(spark, path)
    return fs.exists(target)


def remove_path(spark: SparkSession, path: str) -> None:
    target, fs = hadoop_path(spark, path)
    fs.delete(target, True)
    _COPIES.discard(path)
