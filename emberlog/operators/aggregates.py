"""Aggregations over parsed rows and anomaly records.

All group-bys aggregate on the map side first, so a key that holds a third of
the rows reaches the shuffle as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.functions import columns as C

# ------------------------------------------------------------- over log rows


# What the windowed metrics read of a line, and the one feature they use.
WINDOW_FIELDS = ("timestamp", "level", "service", "ip_address", "response_time")
WINDOW_FEATURES = ("suspicious_ip",)


def windowed_metrics(features: DataFrame, duration: str = "1 minute", slide: str | None = None) -> DataFrame:
    """Tumbling (or sliding) window x service; works on batches and streams."""
    bucket = F.window("timestamp", duration, slide)
    return (
        features.groupBy(bucket, "service")
        .agg(
            F.count("*").alias("log_count"),
            F.avg("response_time").alias("avg_response_time"),
            F.stddev("response_time").alias("stddev_response_time"),
            F.count_if(F.col("level") == "ERROR").alias("error_count"),
            F.count_if(F.col("level") == "WARN").alias("warn_count"),
            F.count_if(F.col("suspicious_ip") == 1).alias("suspicious_ip_count"),
        )
    )


TREND_FIELDS = ("level", "service", "response_time")
TREND_FEATURES = ("level_error", "level_warn")


def service_trend(features: DataFrame) -> DataFrame:
    """Errors, warnings and mean response time per service."""
    return features.groupBy("service").agg(
        F.sum("level_error").alias("error_count"),
        F.sum("level_warn").alias("warn_count"),
        F.avg("response_time").alias("avg_response_time"),
    )


def counts_by(df: DataFrame, column: str, name: str = "log_count") -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias(name))


def top_counts(df: DataFrame, column: str, n: int = 10, name: str = "log_count") -> DataFrame:
    """The ``n`` most frequent values; equal counts are ordered by value."""
    return counts_by(df, column, name).orderBy(F.desc(name), column).limit(n)


def log_totals(parsed: DataFrame) -> DataFrame:
    """Volume, errors, warnings and response time in one pass."""
    return parsed.agg(*_total_columns())


def _total_columns() -> list[Column]:
    return [
        F.count("*").alias("total_logs"),
        F.count_if(F.col("level") == "ERROR").alias("error_logs"),
        F.count_if(F.col("level") == "WARN").alias("warn_logs"),
        F.avg("response_time").alias("avg_response_time"),
        F.max("response_time").alias("max_response_time"),
    ]


def time_range(parsed: DataFrame) -> DataFrame:
    return parsed.agg(
        F.min("timestamp").alias("start_time"), F.max("timestamp").alias("end_time")
    )


def column_summary(df: DataFrame, numeric: Sequence[str], text: Sequence[str] = ()) -> DataFrame:
    """Count, mean, sample deviation, min and max per column, from one pass."""
    blank = F.lit(None).cast("double")
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.count(name).alias("n"),
            (F.avg(name) if name in numeric else blank).alias("mean"),
            (F.stddev(name) if name in numeric else blank).alias("stddev"),
            F.min(name).cast("string").alias("min_value"),
            F.max(name).cast("string").alias("max_value"),
        )
        for name in [*numeric, *text]
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


# --------------------------------------------------------- over anomaly rows


def severity_counts(score: Column | str = "anomaly_score", floor: float = 0.0) -> list[Column]:
    """One count per severity band; ``low`` starts at ``floor``."""
    s = F.col(score) if isinstance(score, str) else score
    label = C.severity(s)
    return [
        F.count_if(label == "critical").alias("critical"),
        F.count_if(label == "high").alias("high"),
        F.count_if(label == "medium").alias("medium"),
        F.count_if((label == "low") & (s >= floor)).alias("low"),
    ]


def severity_totals(anomalies: DataFrame, floor: float = 0.0) -> DataFrame:
    return anomalies.agg(*severity_counts(floor=floor))


def severity_distribution(anomalies: DataFrame) -> DataFrame:
    """Anomalies per severity; bands without rows are present with zero."""
    return severity_totals(anomalies).select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(name).alias("severity"), F.col(name).alias("anomaly_count"))
                    for name in ("critical", "high", "medium", "low")
                ]
            )
        )
    )


def alert_totals(alerts: DataFrame) -> DataFrame:
    """Alerts per severity label; anything unnamed counts as low."""
    label = F.col("severity")
    return alerts.agg(
        F.count_if(label == "CRITICAL").alias("critical_alerts"),
        F.count_if(label == "HIGH").alias("high_risk_alerts"),
        F.count_if(label == "MEDIUM").alias("medium_risk_alerts"),
        F.count_if(~label.isin("CRITICAL", "HIGH", "MEDIUM")).alias("low_risk_alerts"),
    )


def timeline_minute(anomalies: DataFrame) -> DataFrame:
    return (
        anomalies.filter(F.col("timestamp").isNotNull())
        .groupBy(F.date_trunc("minute", "timestamp").alias("minute"))
        .agg(F.count("*").alias("anomaly_count"))
    )


def timeline_hour(anomalies: DataFrame) -> DataFrame:
    """Count and severity bands per hour, in time order."""
    return (
        anomalies.filter(F.col("timestamp").isNotNull())
        .groupBy(F.date_trunc("hour", "timestamp").alias("hour"))
        .agg(F.count("*").alias("anomaly_count"), *severity_counts())
        .orderBy("hour")
    )


def error_pattern() -> Column:
    """Message of an ERROR row, NULL for other levels."""
    return F.when(F.col("level") == "ERROR", F.col("message"))


def error_patterns(anomalies: DataFrame) -> DataFrame:
    return (
        anomalies.filter(F.col("level") == "ERROR")
        .groupBy(error_pattern().alias("pattern"))
        .agg(F.count("*").alias("error_count"))
    )


def _seen_columns() -> list[Column]:
    return [F.count("*").alias("anomaly_count"), F.min("timestamp").alias("first_seen"), F.max("timestamp").alias("last_seen")]


def _day() -> Column:
    return F.to_date("timestamp").alias("day")


def entity_summary(anomalies: DataFrame) -> DataFrame:
    """Services and addresses of anomalies by file and day: count, first and last time.

    Rows of any files and days add up (:func:`summed`), so lists over a whole log are sums of
    small stored tables instead of a pass over all anomalies. Undated rows have a null day.
    """
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("entity")) for k in ("service", "ip_address")])
    rows = anomalies.select("file_id", "timestamp", F.inline(kinds)).filter(F.col("entity") != "")
    return rows.groupBy("file_id", _day(), "kind", "entity").agg(*_seen_columns())


def pattern_summary(anomalies: DataFrame) -> DataFrame:
    """Messages of ERROR anomalies by file and day: count, first and last time."""
    rows = anomalies.select("file_id", "timestamp", error_pattern().alias("pattern")).filter(F.col("pattern").isNotNull())
    return rows.groupBy("file_id", _day(), "pattern").agg(*_seen_columns())


def summed(summary: DataFrame, *by: str) -> DataFrame:
    """A stored summary over fewer keys."""
    return summary.groupBy(*by).agg(
        F.sum("anomaly_count").alias("anomaly_count"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen")
    )


def list_sizes(entities: DataFrame, patterns: DataFrame) -> DataFrame:
    """Numbers of services, addresses and error patterns of each file, from the stored lists."""
    kinds = summed(entities, "file_id", "kind", "entity").groupBy("file_id").agg(
        F.count_if(F.col("kind") == "service").alias("services_count"), F.count_if(F.col("kind") == "ip_address").alias("suspicious_ips_count")
    )
    messages = summed(patterns, "file_id", "pattern").groupBy("file_id").agg(F.count("*").alias("error_patterns_count"))
    sizes = kinds.join(messages, "file_id", "full")
    return sizes.select("file_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("services_count", "suspicious_ips_count", "error_patterns_count")])


def distinct_entities(anomalies: DataFrame) -> DataFrame:
    """Services and addresses seen among anomalies, one row each.

    Rows rather than arrays: the number of addresses grows with the data.
    """
    return (
        anomalies.select(
            F.inline(
                F.array(
                    F.struct(F.lit("service").alias("kind"), F.col("service").alias("entity")),
                    F.struct(F.lit("ip_address").alias("kind"), F.col("ip_address").alias("entity")),
                )
            )
        )
        .filter(F.col("entity") != "")
        .distinct()
    )


def _dated(column: str) -> Column:
    return F.when(F.col("timestamp").isNotNull(), F.col(column))


def first_last_columns(order: str = "line_number") -> list[Column]:
    """Timestamps of the first and the last dated row in line order."""
    return [
        F.min_by("timestamp", _dated(order)).alias("first_timestamp"),
        F.max_by("timestamp", _dated(order)).alias("last_timestamp"),
    ]


def first_last(anomalies: DataFrame, order: str = "line_number") -> DataFrame:
    return anomalies.agg(*first_last_columns(order))
