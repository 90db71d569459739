"""Statistics records of an analysis and what is derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlog.functions import columns as C
from emberlog.functions.params import Thresholds
from emberlog.operators import aggregates as A
from emberlog.sources.scratch import staged


def analysis_statistics(
    scored: DataFrame,
    is_anomaly: Column,
    by: list[str] | None = None,
    score: str = "anomaly_score",
    generate_alerts: bool = True,
    thresholds: Thresholds = Thresholds(),
) -> DataFrame:
    """One record per analysed file (or per ``by`` group), in one pass over all rows.

    Lists that grow with the data are separate row tables
    (:func:`emberlog.operators.aggregates.distinct_entities`,
    :func:`~emberlog.operators.aggregates.error_patterns`); the record has their sizes.
    """
    hit = F.coalesce(is_anomaly, F.lit(False))
    alerting = hit & (F.col(score) >= thresholds.alert) & F.lit(generate_alerts)
    label = C.severity(score)

    def seen(column: Column | str) -> Column:
        value = F.col(column) if isinstance(column, str) else column
        return F.count_distinct(F.when(hit & (value != ""), value))

    dated_hit = F.when(hit & F.col("timestamp").isNotNull(), F.col("line_number"))
    return scored.groupBy(*(by or [])).agg(
        F.count("*").alias("total_logs"),
        F.count_if(hit).alias("anomalies_found"),
        F.count_if(alerting & (label == "critical")).alias("critical_alerts"),
        F.count_if(alerting & (label == "high")).alias("high_risk_alerts"),
        F.count_if(alerting & (label == "medium")).alias("medium_risk_alerts"),
        F.count_if(alerting & (label == "low")).alias("low_risk_alerts"),
        F.count_if(F.col("level") == "ERROR").alias("error_logs"),
        seen("service").alias("services_count"),
        seen("ip_address").alias("suspicious_ips_count"),
        F.count_distinct(F.when(hit, A.error_pattern())).alias("error_patterns_count"),
        F.min_by("timestamp", dated_hit).alias("first_timestamp"),
        F.max_by("timestamp", dated_hit).alias("last_timestamp"),
    )


def summary_rates(statistics: DataFrame) -> DataFrame:
    """Anomaly and critical percentages and list sizes of statistics records."""
    keys = [c for c in ("file_id",) if c in statistics.columns]
    return statistics.select(
        *keys,
        C.percentage(F.col("anomalies_found"), F.col("total_logs")).alias("anomaly_rate"),
        C.percentage(F.col("critical_alerts"), F.col("anomalies_found")).alias("critical_rate"),
        "services_count",
        "suspicious_ips_count",
        "error_patterns_count",
    )


def trained_statistics(
    scored: DataFrame,
    score: str = "anomaly_score",
    top_ips: int = 10,
    thresholds: Thresholds = Thresholds(),
    by: tuple[str, ...] = (),
) -> DataFrame:
    """One record (per ``by`` group): volumes, severity bands, response time, time range, busiest addresses.

    The rows are reduced to one row per address first; the totals and the top
    list are both taken from that small table, so the log is read once.
    """
    s = F.col(score)
    hit = s > thresholds.trained_anomaly
    bands = A.severity_counts(F.when(hit, s), floor=thresholds.trained_anomaly)
    per_ip = staged(
        scored.groupBy(*by, "ip_address").agg(
            F.count("*").alias("total_logs"),
            F.count_if(hit).alias("anomalies_found"),
            *bands,
            F.count_if(F.col("level") == "ERROR").alias("error_logs"),
            F.count_if(F.col("level") == "WARN").alias("warn_logs"),
            F.sum("response_time").alias("response_sum"),
            F.count("response_time").alias("response_n"),
            F.max("response_time").alias("max_response_time"),
            F.min("timestamp").alias("start_time"),
            F.max("timestamp").alias("end_time"),
        ),
        "per-address",
    )
    def total(name: str, alias: str | None = None) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).alias(alias or name)

    totals = per_ip.groupBy(*by).agg(
        total("total_logs"),
        total("anomalies_found"),
        total("critical", "critical_alerts"),
        total("high", "high_risk_alerts"),
        total("medium", "medium_risk_alerts"),
        total("low", "low_risk_alerts"),
        total("error_logs"),
        total("warn_logs"),
        F.try_divide(F.sum("response_sum"), F.sum("response_n")).alias("avg_response_time"),
        F.max("max_response_time").alias("max_response_time"),
        F.min("start_time").alias("start_time"),
        F.max("end_time").alias("end_time"),
    )
    if not by:
        return totals.withColumn("top_ips", _listed(per_ip.orderBy(F.desc("total_logs"), "ip_address").limit(top_ips)).scalar())
    # each task keeps the first rows of a group before they are sent
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("total_logs"), "ip_address"))
    busiest = per_ip.withColumn("place", place).filter(F.col("place") <= top_ips)
    return totals.join(_listed(busiest, *by), list(by))


def _listed(busiest: DataFrame, *by: str) -> DataFrame:
    """Addresses as one array, most lines first."""
    rows = F.array_sort(F.collect_list(F.struct((-F.col("total_logs")).alias("n"), "ip_address")))
    return busiest.groupBy(*by).agg(F.transform(rows, lambda e: e["ip_address"]).alias("top_ips"))


def file_totals(per_file: DataFrame) -> DataFrame:
    """Totals over per-file records with ``success`` and ``anomalies_found``."""
    return per_file.agg(
        F.count("*").alias("total_files"),
        F.count_if("success").alias("successful"),
        F.count_if(~F.col("success")).alias("failed"),
        F.coalesce(F.sum(F.when(F.col("success"), F.col("anomalies_found"))), F.lit(0)).alias(
            "total_anomalies"
        ),
    )


def live_counters(scored: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """Running totals: every line counts once, anomalies are a subset of them."""
    hit = F.col("anomaly_score") > thresholds.live_anomaly
    return scored.agg(
        F.count("*").alias("total_logs"),
        F.count_if(hit).alias("total_anomalies"),
        F.count_if(hit & (F.col("anomaly_score") > thresholds.live_critical)).alias("critical_alerts"),
    ).withColumn(
        "anomaly_rate",
        F.coalesce(F.try_divide("total_anomalies", "total_logs"), F.lit(0.0)),
    )
