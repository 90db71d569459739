"""Intermediate tables in the shared folder of the cluster."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCAL_DIR = "emberlog.local.scratch.dir"  # set by local sessions only


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir`` (or the context's checkpoint folder).

    Only a local session that names no such folder gets a temporary one; on a
    cluster a machine-local folder would be lost with its machine.
    """
    root = (
        spark.conf.get(_CHECKPOINT_DIR, None)
        or spark.sparkContext.getCheckpointDir()
        or spark.conf.get(_LOCAL_DIR, None)
    )
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError(f"set {_CHECKPOINT_DIR} to a folder all executors share")
        root = tempfile.mkdtemp(prefix="emberlog-")
        spark.conf.set(_LOCAL_DIR, root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write once, read many times: the plan above restarts from the written table.

    The shuffle files of the write go with its end instead of with the driver's next collection of garbage.
    """
    return _written(df, scratch_dir(df.sparkSession, purpose))


@contextmanager
def passing(df: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """``staged`` for a table that nothing reads after the block: its files go with the block."""
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    try:
        yield _written(df, path)
    finally:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _written(df: DataFrame, path: str) -> DataFrame:
    spark = df.sparkSession
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Spread an input of fewer splits than cores; larger inputs stay as they are scanned."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
