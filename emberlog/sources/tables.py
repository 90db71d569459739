"""Result tables: one folder per table, one partition per analysed file and run.

The rows of a run are never touched again. A run writes its tables into partitions of its own
and then adds commits, which say for every file and table that this run is the current one; readers
follow the newest commit. A run that stops before its commit changes nothing for them, and rows
of former runs are removed only after it.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

ANOMALIES, ALERTS, STATISTICS, REJECTS = "anomalies", "alerts", "statistics", "rejects"
ENTITIES, PATTERNS, SUMMARIES = "entities", "error_patterns", "summaries"
ALL = (ANOMALIES, ALERTS, STATISTICS, REJECTS, ENTITIES, PATTERNS, SUMMARIES)
COMMITS = "commits"


def write_partitions(df: DataFrame, path: str, *keys: str) -> None:
    """Replace exactly the partitions present in ``df``.

    The rebalance hint lets adaptive execution cut a hot file into several
    write tasks and pack small files into few.
    """
    keys = keys or ("file_id",)
    (
        df.hint("rebalance", *[F.col(k) for k in keys])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )


def write_table(df: DataFrame, root: str, table: str, run_id: str) -> None:
    """Add the rows of a run; a hot file is written by several tasks."""
    rows = df.withColumn("run_id", F.lit(run_id))
    rows.hint("rebalance", F.col("file_id")).write.mode("append").partitionBy("file_id", "run_id").parquet(f"{root}/{table}")


def write_commits(files: DataFrame, root: str, written: dict[str, StructType], run_id: str) -> None:
    """Say for each file and table that ``run_id`` is the current run; ``written`` has the columns of the tables."""
    names = [F.struct(F.lit(t).alias("table"), F.lit(schema.json()).alias("schema")) for t, schema in written.items()]
    rows = files.distinct().select("file_id", F.inline(F.array(*names)), F.lit(run_id).alias("run_id"), F.lit(time.time_ns()).alias("committed"))
    rows.hint("rebalance").write.mode("append").parquet(f"{root}/{COMMITS}")


def current_runs(spark: SparkSession, root: str) -> DataFrame:
    """file_id, table and run_id of the newest commit of each file and table."""
    commits = spark.read.parquet(f"{root}/{COMMITS}")
    return commits.groupBy("file_id", "table").agg(F.max_by("run_id", "committed").alias("run_id"))


def read_table(spark: SparkSession, root: str, table: str, file_id: str | None = None) -> DataFrame:
    """The current rows of a result table, pruned to one analysis if asked."""
    df = _stored(spark, root, table)
    if file_id is not None:
        df = df.filter(F.col("file_id") == file_id)
    try:
        current = current_runs(spark, root)
    except AnalysisException as missing:  # a table written on its own has no commits
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return df.drop("run_id")
    # one row for each file; both keys are partition columns, so only current partitions are read
    return df.join(current.filter(F.col("table") == table).drop("table"), ["file_id", "run_id"], "left_semi").drop("run_id")


def remove_former_runs(spark: SparkSession, root: str, table: str, files: DataFrame) -> int:
    """Remove partitions of ``files`` that belong to a committed run which is not the current one.

    Runs without a commit are left alone: they may still be writing. Returns the partitions removed.
    """
    committed = spark.read.parquet(f"{root}/{COMMITS}").filter(F.col("table") == table)
    current = current_runs(spark, root).filter(F.col("table") == table)
    former = committed.join(files.select("file_id").distinct(), "file_id", "left_semi").join(current, ["file_id", "table", "run_id"], "left_anti")
    paths = former.select("file_id", "run_id").distinct()
    places = spark._jvm.org.apache.hadoop.fs
    removed = 0
    for row in paths.toLocalIterator():  # one partition after another
        file = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(row.file_id)
        place = places.Path(f"{root}/{table}/file_id={file}/run_id={row.run_id}")
        removed += bool(place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True))
    return removed


def _stored(spark: SparkSession, root: str, table: str) -> DataFrame:
    try:
        df = spark.read.parquet(f"{root}/{table}")
    except AnalysisException as missing:
        if missing.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        df = _no_rows(spark, root, table)
    return df.withColumns({c: F.col(c).cast("string") for c in ("file_id", "run_id") if c in df.columns})


def _no_rows(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table of which every current run is empty: its columns stand in the commits."""
    schema = spark.read.parquet(f"{root}/{COMMITS}").filter(F.col("table") == table).agg(F.max_by("schema", "committed")).first()[0]
    empty = spark.createDataFrame([], StructType.fromJson(json.loads(schema)))
    return empty.withColumn("run_id", F.lit(None).cast("string"))


def write_lines(df: DataFrame, path: str, column: str = "value") -> None:
    """Text sink for already ordered lines; file order is row order."""
    df.select(F.col(column).alias("value")).write.text(path)
