"""File inventory of log directories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.functions.columns import human_size


def file_inventory(spark: SparkSession, directories: str | list[str]) -> DataFrame:
    """Name, readable size and modification time of every file, newest first.

    Only file metadata is selected, so file contents are never read.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(directories)
        .select("path", "modificationTime", "length")
    )
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        human_size("length").alias("size"),
        "length",
        F.date_format("modificationTime", "yyyy-MM-dd HH:mm:ss").alias("created"),
        "path",
    ).orderBy(F.desc("created"), "path")
