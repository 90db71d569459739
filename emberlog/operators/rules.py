"""Rule scores, anomaly records and alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.functions import columns as C
from emberlog.functions.params import Thresholds

RECORD_COLUMNS = [
    "timestamp", "level", "service", "message", "ip_address", "user", "response_time",
    "anomaly_score", "file_id", "analysis_type", "cluster", "line_number",
]


# What the rule score reads of a line; parse only these (and what the query shows).
SCORE_FIELDS = ("level", "message", "response_time")


def with_pattern_score(parsed: DataFrame) -> DataFrame:
    return C.computed_once(parsed, {"anomaly_score": C.pattern_score()})


def pattern_anomalies(parsed: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """Rows whose rule score reaches the analysis threshold."""
    return with_pattern_score(parsed).filter(
        F.col("anomaly_score") >= thresholds.analysis_anomaly
    )


def with_severity(scored: DataFrame, score: str = "anomaly_score") -> DataFrame:
    return scored.withColumns({"severity": C.severity(score), "priority": C.priority(score)})


def anomaly_records(
    scored: DataFrame,
    analysis_type: str,
    score: str = "anomaly_score",
    cluster: Column | None = None,
) -> DataFrame:
    """The common record shape of all detection methods."""
    cluster = F.lit(None).cast("int") if cluster is None else cluster
    derived = {
        "anomaly_score": F.col(score),
        "analysis_type": F.lit(analysis_type),
        "cluster": cluster,
    }
    return scored.select(
        *[derived[c].alias(c) if c in derived else F.col(c) for c in RECORD_COLUMNS]
    )


def alerts(anomalies: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """One alert per anomaly from the alert cut-off on.

    The id is made of file and line, so a repeated run yields the same ids.
    """
    label = F.upper(C.severity())
    headline = F.concat(
        label, F.lit(" anomaly in "), F.col("service"), F.lit(": "), F.col("message"),
    )
    return anomalies.filter(F.col("anomaly_score") >= thresholds.alert).select(
        F.concat_ws("_", F.lit("alert"), "file_id", F.col("line_number").cast("string")).alias("id"),
        label.alias("severity"),
        C.priority().alias("priority"),
        headline.alias("message"),
        "service",
        "ip_address",
        "timestamp",
        "anomaly_score",
        "line_number",
        "file_id",
        F.current_timestamp().alias("created_at"),
        F.struct("level", "user", "response_time", "analysis_type").alias("details"),
    )
