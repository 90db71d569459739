"""Analysis of a whole directory of log files as one job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.functions.params import AnalysisOptions
from emberlog.operators.centers import CenterModel
from emberlog.operators.statistics import file_totals
from emberlog.plans.analyze import Analysis, analyze_trained
from emberlog.sources.textlogs import file_id, log_files, numbered_lines


def analyze_directory(
    spark: SparkSession,
    directory: str,
    model: CenterModel | None = None,
    options: AnalysisOptions = AnalysisOptions(),
    nested: bool = False,
) -> tuple[Analysis, DataFrame]:
    """Analyse every ``.log`` and ``.txt`` file; return the analysis and the per-file results."""
    lines = numbered_lines(spark, directory, nested)
    analysis = analyze_trained(lines.select("file_id", "line_number", "value"), model, options, stage=True)
    return analysis, per_file_results(spark, directory, analysis.statistics, nested)


def per_file_results(
    spark: SparkSession, directory: str, statistics: DataFrame, nested: bool = False
) -> DataFrame:
    """File list with size, success and counts; a file without valid lines fails."""
    files = (
        log_files(spark.read.format("binaryFile"), nested)
        .load(directory)
        .select(
            file_id(nested).alias("file_id"),
            F.col("_metadata.file_name").alias("file_name"),
            F.col("_metadata.file_size").alias("file_size"),
        )
    )
    ok = F.coalesce(F.col("total_logs"), F.lit(0)) > 0
    return files.join(statistics, "file_id", "left").select(
        "file_id",
        "file_name",
        "file_size",
        ok.alias("success"),
        F.when(~ok, "no line of this file has a level and a service").alias("message"),
        F.coalesce("total_logs", F.lit(0)).alias("total_logs"),
        F.coalesce("anomalies_found", F.lit(0)).alias("anomalies_found"),
        F.coalesce("critical_alerts", F.lit(0)).alias("critical_alerts"),
    )


def batch_summary(per_file: DataFrame) -> DataFrame:
    return file_totals(per_file)
