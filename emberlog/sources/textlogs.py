"""Text log sources: scan, file identity, line counts and line numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

from emberlog.sources.scratch import staged

LOG_FILE_GLOB = "*.{log,txt}"

# Bytes of text of one micro-batch, unless the caller says otherwise.
STREAM_BATCH_BYTES = 64 << 30

# The block table is one row per input split.  Up to this many rows (some 200 MB)
# it is broadcast; beyond, the join is left to Spark.
MAX_BROADCAST_BLOCKS = 1_000_000


def file_id(nested: bool = False) -> Column:
    """``name_mtime``: identity of one version of a file.

    Names are unique within one folder only; ``nested`` adds a hash of the path.
    """
    parts = [
        F.col("_metadata.file_name"),
        F.unix_seconds("_metadata.file_modification_time").cast("string"),
    ]
    if nested:
        parts.append(F.hex(F.xxhash64("_metadata.file_path")))
    return F.concat_ws("_", *parts)


def log_files(reader: DataFrameReader | DataStreamReader, nested: bool = False):
    """The reader restricted to log files, with subfolders if ``nested``."""
    reader = reader.option("pathGlobFilter", LOG_FILE_GLOB)
    return reader.option("recursiveFileLookup", "true") if nested else reader


def scan_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``value STRING``, one row per line of the given files."""
    return spark.read.text(paths)


def scan_log_files(spark: SparkSession, paths: str | list[str], nested: bool = False) -> DataFrame:
    """All ``.log`` and ``.txt`` files of the paths, in one scan.

    ``nested`` also looks into subfolders.  ``file_id, file_name, file_path, file_size`` come from the file metadata;
    the scan prunes what a query does not read.
    """
    return log_files(spark.read, nested).text(paths).select(
        "value",
        file_id(nested).alias("file_id"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_size"),
    )


def stream_lines(
    spark: SparkSession, directory: str, max_files: int | None = None, max_bytes: int = STREAM_BATCH_BYTES
) -> DataFrame:
    """Streaming ``value STRING`` over files placed atomically in a directory.

    Every file is read once; checkpoint offsets say which ones are done.
    Appending to a file already seen is not picked up.  A batch takes files up to
    ``max_bytes``, so a first batch over a full directory is no larger than any other;
    ``max_files`` limits by number instead.
    """
    reader: DataStreamReader = log_files(spark.readStream, nested=True)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    else:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.text(directory)


def line_counts(lines: DataFrame) -> DataFrame:
    """Lines per file."""
    return lines.groupBy("file_id").agg(F.count("*").alias("line_count"))


def numbered_lines(spark: SparkSession, paths: str | list[str], nested: bool = False) -> DataFrame:
    """``file_id, file_name, file_path, line_number, value``, numbered from 1 per file.

    The lines themselves are not shuffled.  A first scan counts the lines of
    every input split; a running sum over that small table gives the number of
    lines before each split.  The second scan adds the position inside the
    split.  Both scans plan the same splits; should the layout change between
    them, the position falls outside its split and the job fails instead of
    handing out wrong numbers.
    """
    raw = log_files(spark.read, nested).text(paths).select(
        "value",
        file_id(nested).alias("file_id"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("position"),
    )
    block = ["file_path", "block_start"]
    earlier = (
        Window.partitionBy("file_path")
        .orderBy("block_start")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    blocks = staged(
        raw.groupBy(*block)
        .agg(F.min("position").alias("first"), F.count("*").alias("n"))
        .withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))),
        "line-blocks",
    )
    if blocks.count() <= MAX_BROADCAST_BLOCKS:
        blocks = F.broadcast(blocks)
    inside = F.col("position") - F.col("first")
    return raw.join(blocks, block, "left").select(
        "file_id",
        "file_name",
        "file_path",
        F.when((inside >= 0) & (inside < F.col("n")), F.col("before") + inside + 1)
        .otherwise(F.raise_error(F.lit("input splits changed between two scans")).cast("bigint"))
        .alias("line_number"),
        "value",
    )
