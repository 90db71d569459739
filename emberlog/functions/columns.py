"""Column expressions: parsing, features, scores and labels.

Everything here is built from native Spark functions, so it stays on the JVM
and inside generated code, in batch and on streams alike.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.functions import fixed



def computed_once(df: DataFrame, columns: dict[str, Column], keep: list[str] | None = None) -> DataFrame:
    """Add columns that later filters read but never re-evaluate.

    A filter on a plain computed column is pushed below the projection and runs
    the expression again, which doubles the cost of regular expressions.
    Unpacking a one-element array of structs keeps the filter above it.
    """
    row = F.struct(*[expr.alias(name) for name, expr in columns.items()])
    return df.select(*(["*"] if keep is None else keep), F.inline(F.array(row)))


# ------------------------------------------------------------------ parsing


def parsed_columns(value: Column | str = "value") -> dict[str, Column]:
    """The seven typed fields of a raw line.

    Text fields that do not match are empty strings; ``timestamp`` and
    ``response_time`` are NULL when absent or not valid, also under ANSI mode.
    The pattern fixes the shape of the timestamp, so the plain string cast reads
    it (same result as a format-driven parse at half the cost).
    """
    line = F.col(value) if isinstance(value, str) else value

    def group(pattern: str) -> Column:
        return F.regexp_extract(line, pattern, 1)

    return {
        "timestamp": group(fixed.TIMESTAMP_PATTERN).try_cast("timestamp"),
        "level": group(fixed.LEVEL_PATTERN),
        "service": group(fixed.SERVICE_PATTERN),
        "message": group(fixed.MESSAGE_PATTERN),
        "ip_address": group(fixed.IP_PATTERN),
        "user": group(fixed.USER_PATTERN),
        "response_time": group(fixed.RESPONSE_TIME_PATTERN).try_cast("int"),
    }


def rendered_line() -> Column:
    """The canonical text of a parsed row (the inverse of parsing)."""
    return F.concat(
        F.date_format("timestamp", fixed.TIMESTAMP_FORMAT),
        F.lit(" ["), F.col("level"), F.lit("] "), F.col("service"),
        F.lit(" - "), F.col("message"),
        F.lit(" | IP: "), F.col("ip_address"),
        F.lit(" | User: "), F.col("user"),
        F.lit(" | ResponseTime: "), F.col("response_time").cast("string"), F.lit("ms"),
    )


def is_valid() -> Column:
    return (F.col("level") != "") & (F.col("service") != "")


# ----------------------------------------------------------------- features


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def feature_columns() -> dict[str, Column]:
    return {
        "level_error": _flag(F.col("level") == "ERROR"),
        "level_warn": _flag(F.col("level") == "WARN"),
        "level_info": _flag(F.col("level") == "INFO"),
        "hour": F.hour("timestamp"),
        "minute": F.minute("timestamp"),
        "message_length": F.length("message"),
        "has_error_keyword": _flag(F.col("message").rlike(fixed.ERROR_KEYWORD_PATTERN)),
        "suspicious_ip": _flag(F.col("ip_address").rlike(fixed.SUSPICIOUS_IP_PATTERN)),
        "high_response_time": _flag(F.col("response_time") > fixed.HIGH_RESPONSE_MS),
        "very_high_response_time": _flag(
            F.col("response_time") > fixed.VERY_HIGH_RESPONSE_MS
        ),
    }


# ------------------------------------------------------------------- scores


def pattern_score() -> Column:
    """Rule score: level, response time, then one step per keyword found.

    A flat left-to-right sum: the doubles depend on that order, and nesting the
    running total inside every branch would double the expression per keyword.
    """
    level, slow = F.col("level"), F.col("response_time")
    message = F.lower("message")
    steps = [
        F.when(level == "ERROR", fixed.PATTERN_ERROR_WEIGHT)
        .when(level == "WARN", fixed.PATTERN_WARN_WEIGHT)
        .otherwise(0.0),
        F.when(slow > fixed.VERY_HIGH_RESPONSE_MS, fixed.PATTERN_VERY_SLOW_WEIGHT)
        .when(slow > fixed.HIGH_RESPONSE_MS, fixed.PATTERN_SLOW_WEIGHT)
        .otherwise(0.0),
    ] + [
        F.when(message.contains(word), fixed.PATTERN_KEYWORD_WEIGHT).otherwise(0.0)
        for word in fixed.PATTERN_KEYWORDS
    ]
    return reduce(add, steps)


def linear_distance_score(distance: Column | str = "distance_to_center") -> Column:
    """Distance on a straight scale, 1.0 from three units on; 0.5 if unknown."""
    d = F.col(distance) if isinstance(distance, str) else distance
    return F.when(
        d.isNotNull(), F.least(d / fixed.LINEAR_DISTANCE_SCALE, F.lit(1.0))
    ).otherwise(fixed.NO_MODEL_SCORE)


def enhanced_score(base: Column | str, rare_cluster: Column) -> Column:
    """Base score raised by rare clusters, slow calls, sensitive services and odd IPs."""
    base = F.col(base) if isinstance(base, str) else base
    slow = F.coalesce("response_time", F.lit(0))
    sensitive = F.col("service").isin(fixed.SENSITIVE_SERVICES)
    ip = F.coalesce("ip_address", F.lit(""))
    odd_ip = reduce(
        lambda a, b: a | b,
        [ip.contains(part) for part in fixed.ENHANCED_IP_PARTS],
        ip.startswith(fixed.ENHANCED_IP_PREFIX),
    )
    total = (
        base
        + F.when(rare_cluster, fixed.ENHANCED_RARE_CLUSTER_WEIGHT).otherwise(0.0)
        + F.when(slow > fixed.ENHANCED_VERY_SLOW_MS, fixed.ENHANCED_VERY_SLOW_WEIGHT)
        .when(slow > fixed.ENHANCED_SLOW_MS, fixed.ENHANCED_SLOW_WEIGHT)
        .otherwise(0.0)
        + F.when(sensitive & (F.col("level") == "ERROR"), fixed.ENHANCED_ERROR_WEIGHT)
        .when(sensitive & (F.col("level") == "WARN"), fixed.ENHANCED_WARN_WEIGHT)
        .otherwise(0.0)
        + F.when(odd_ip, fixed.ENHANCED_IP_WEIGHT).otherwise(0.0)
    )
    return F.least(total, F.lit(1.0))


def zscore_score(distance: Column, mean: Column, spread: Column) -> Column:
    """z-score of a distance mapped from [-3, 3] to [0, 1] and clipped."""
    raw = ((distance - mean) / spread + 3) / 6
    return F.when(raw < 0, 0.0).when(raw > 1, 1.0).otherwise(raw)


def usable_spread(spread: Column) -> Column:
    """Standard deviation with missing or zero spread replaced by one."""
    return F.coalesce(F.nullif(spread, F.lit(0.0)), F.lit(1.0))


# ------------------------------------------------------------------- labels


def severity(score: Column | str = "anomaly_score") -> Column:
    s = F.col(score) if isinstance(score, str) else score
    return (
        F.when(s >= fixed.SEVERITY_CRITICAL, "critical")
        .when(s >= fixed.SEVERITY_HIGH, "high")
        .when(s >= fixed.SEVERITY_MEDIUM, "medium")
        .otherwise("low")
    )


def priority(score: Column | str = "anomaly_score") -> Column:
    s = F.col(score) if isinstance(score, str) else score
    return (
        F.when(s >= fixed.SEVERITY_CRITICAL, 1)
        .when(s >= fixed.SEVERITY_HIGH, 2)
        .when(s >= fixed.SEVERITY_MEDIUM, 3)
        .otherwise(4)
    )


def human_size(length: Column | str = "length") -> Column:
    n = F.col(length) if isinstance(length, str) else length
    kib, mib = 1024, 1024 * 1024
    return (
        F.when(n < kib, F.format_string("%d B", n))
        .when(n < mib, F.format_string("%.2f KB", n / kib))
        .otherwise(F.format_string("%.2f MB", n / mib))
    )


def percentage(part: Column, whole: Column) -> Column:
    """100 * part / whole to two places; an empty whole counts as one."""
    return F.round(100.0 * part / F.greatest(whole, F.lit(1)), 2)
