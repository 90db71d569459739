"""Views over result tables: pages, recent rows, annotated lines, lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlog.functions import columns as C
from emberlog.sources.scratch import staged


# Up to this many skipped rows a page is a plain top-n.
DEEP_OFFSET = 100_000


def page(
    df: DataFrame,
    order: Sequence[Column | str],
    number: int = 1,
    per_page: int = 50,
) -> DataFrame:
    """Rows of one page plus ``page, total, pages``.

    ``order`` must end in a unique key.  The first pages are a top-n per task;
    behind ``DEEP_OFFSET`` rows the page is found by position instead, because a
    top-n keeps offset + limit rows in every task.
    """
    total = df.agg(F.count("*").alias("n")).scalar()
    skipped = (number - 1) * per_page
    if skipped <= DEEP_OFFSET:
        rows = df.orderBy(*order).offset(skipped).limit(per_page)
    else:
        rows = _rows_at(df, order, skipped, per_page)
    return rows.withColumns(
        {
            "page": F.lit(number),
            "total": total,
            "pages": F.ceil(total / per_page),
        }
    )


def _rows_at(df: DataFrame, order: Sequence[Column | str], first: int, count: int) -> DataFrame:
    """Rows ``first`` to ``first + count - 1`` in the given order.

    Sorts by range once, then counts rows per sorted part; a running sum over
    the parts (one row per shuffle partition) places every row.
    """
    sorted_rows = staged(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns(
            {
                "_part": F.spark_partition_id(),
                "_place": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1),
            }
        ),
        "sorted",
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        sorted_rows.groupBy("_part")
        .agg(F.count("*").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .select("_part", "_before")
    )
    place = F.col("_before") + F.col("_place")
    return (
        sorted_rows.join(F.broadcast(parts), "_part")  # one row per shuffle partition
        .filter((place >= first) & (place < first + count))
        .orderBy(*order)
        .select(*df.columns)
    )


def page_after(
    df: DataFrame, after: tuple[str, int] | None, per_page: int = 50
) -> DataFrame:
    """The page behind a given (file_id, line_number): a range filter that reaches the scan."""
    if after is not None:
        file_id, line = after
        df = df.filter(
            (F.col("file_id") > file_id)
            | ((F.col("file_id") == file_id) & (F.col("line_number") > line))
        )
    return df.orderBy("file_id", "line_number").limit(per_page)


def filter_anomalies(
    anomalies: DataFrame, min_score: float | None = None, service: str | None = None
) -> DataFrame:
    if min_score is not None:
        anomalies = anomalies.filter(F.col("anomaly_score") >= min_score)
    if service is not None:
        anomalies = anomalies.filter(F.col("service") == service)
    return anomalies


def anomaly_page(
    anomalies: DataFrame,
    number: int = 1,
    per_page: int = 50,
    min_score: float | None = None,
    service: str | None = None,
) -> DataFrame:
    chosen = filter_anomalies(anomalies, min_score, service)
    return page(chosen, ["file_id", "line_number"], number, per_page)


def alert_page(
    alerts: DataFrame, number: int = 1, per_page: int = 20, severity: str | None = None
) -> DataFrame:
    """Alerts, most urgent first and newest first within a priority."""
    if severity is not None:
        alerts = alerts.filter(F.col("severity") == severity.upper())
    return page(alerts, alert_order(), number, per_page)


def alert_order() -> list[Column]:
    return [
        F.asc("priority"), F.desc_nulls_last("timestamp"), F.asc("file_id"), F.asc("line_number"),
    ]


_LINE_KEY = ["file_id", "line_number"]


def annotated_lines(lines: DataFrame, anomalies: DataFrame, anomalies_only: bool = False) -> DataFrame:
    """Lines with their anomaly score and severity; blank lines keep their number but are not shown.

    The key is unique on both sides, so no join key is hot.
    """
    marks = anomalies.select(*_LINE_KEY, "anomaly_score")
    return _marked(_shown(lines).join(marks, _LINE_KEY, "inner" if anomalies_only else "left"))


def _shown(lines: DataFrame) -> DataFrame:
    return lines.select(*_LINE_KEY, F.trim("value").alias("content")).filter(F.col("content") != "")


def _marked(joined: DataFrame) -> DataFrame:
    hit = F.col("anomaly_score").isNotNull()
    mark = {
        "is_anomaly": hit,
        "anomaly_score": F.coalesce("anomaly_score", F.lit(0.0)),
        "severity": F.when(hit, C.severity()).otherwise("normal"),
    }
    return joined.withColumns(mark)


def log_view(
    lines: DataFrame,
    anomalies: DataFrame,
    number: int = 1,
    per_page: int = 100,
    anomalies_only: bool = False,
) -> DataFrame:
    """One page of annotated lines.

    Without the anomaly filter the page is cut first: its few rows are written
    once and broadcast, and neither the lines nor the anomalies are shuffled.
    """
    if anomalies_only:
        return page(annotated_lines(lines, anomalies, True), _LINE_KEY, number, per_page)
    rows = staged(page(_shown(lines), _LINE_KEY, number, per_page), "page")
    marks = anomalies.select(*_LINE_KEY, "anomaly_score").join(
        F.broadcast(rows.select(*_LINE_KEY)), _LINE_KEY, "left_semi"  # at most per_page rows
    )
    return _marked(rows.join(F.broadcast(marks), _LINE_KEY, "left"))


def recent_anomalies(anomalies: DataFrame, n: int = 100) -> DataFrame:
    """The last ``n`` anomalies by time."""
    return anomalies.orderBy(
        F.desc_nulls_last("timestamp"), F.desc("file_id"), F.desc("line_number")
    ).limit(n)


def file_name(file_id: Column | str = "file_id") -> Column:
    """Name of the file an analysis belongs to: its identity without time and path hash."""
    return F.regexp_replace(file_id, r"(_\d{9,}_[0-9A-F]+|_\d+)$", "")


def analysis_list(statistics: DataFrame) -> DataFrame:
    """One row per analysis, newest first."""
    return statistics.select(
        "file_id",
        file_name().alias("filename"),
        "analysis_completed",
        "status",
        "total_logs",
        "anomalies_found",
        "critical_alerts",
        "processing_time",
    ).orderBy(F.desc("analysis_completed"), "file_id")


def analysis_result(statistics: DataFrame, anomalies: DataFrame, alerts: DataFrame, file_id: str) -> DataFrame:
    """Record of one analysis with its numbers of anomalies and alerts."""

    def rows(df: DataFrame) -> Column:
        return df.filter(F.col("file_id") == file_id).agg(F.count("*").alias("n")).scalar()

    return statistics.filter(F.col("file_id") == file_id).withColumns(
        {"anomalies_count": rows(anomalies), "alerts_count": rows(alerts)}
    )
