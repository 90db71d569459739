"""Text report of an analysis as rows (section, ord, detail, line)."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlog.functions import columns as C
from emberlog.functions import fixed
from emberlog.operators import aggregates as A
from emberlog.operators import readside
from emberlog.operators.readside import alert_order

# Report rows are ordered by these three columns.
ORDER = ["section", "ord", "detail"]

_HEAD, _SUMMARY, _SEVERITY, _DETAILS, _ANOMALIES, _ALERTS, _ADVICE, _END = range(8)


@dataclass(frozen=True)
class Limits:
    """Rows of each list that a report shows."""

    anomalies: int = 50
    alerts: int = 30
    addresses: int = 10


def report_lines(
    title_id: str, statistics: DataFrame, anomalies: DataFrame, alerts: DataFrame, method: str, limits: Limits = Limits()
) -> DataFrame:
    """All report rows.  Inputs are result tables, which hold the whole lists; ``limits`` says how much of them is shown."""
    totals = statistics.agg(
        *_origin(statistics),
        *[
            F.coalesce(F.sum(c), F.lit(0)).alias(c)
            for c in (
                "total_logs", "anomalies_found", "error_logs",
                "critical_alerts", "high_risk_alerts", "medium_risk_alerts", "low_risk_alerts",
            )
        ]
    )
    parts = [
        _fixed_rows(totals, title_id, method, limits),
        _service_rows(anomalies),
        _address_rows(anomalies, limits.addresses),
        _anomaly_rows(anomalies, limits.anomalies),
        _alert_rows(alerts, limits.alerts),
    ]
    return reduce(DataFrame.unionByName, parts)


def _origin(statistics: DataFrame) -> list[Column]:
    """What the records say of the run; records that were not written yet say less."""
    kinds = {"file_id": "string", "analysis_completed": "timestamp", "processing_time": "double"}
    have = {c: F.col(c) if c in statistics.columns else F.lit(None).cast(kind) for c, kind in kinds.items()}
    return [
        F.count_distinct(have["file_id"]).alias("files"), F.min(readside.file_name(have["file_id"])).alias("first_file"),
        F.max(have["analysis_completed"]).alias("completed"), F.max(have["processing_time"]).alias("seconds"),
    ]


def ordered_report(lines: DataFrame) -> DataFrame:
    """Report text in order, ready for the text sink."""
    return lines.orderBy(*ORDER).select(F.col("line").alias("value"))


def _row(section: int, order: int | Column, line: str | Column, detail: Column | None = None) -> Column:
    order = F.lit(order) if isinstance(order, int) else order
    line = F.lit(line) if isinstance(line, str) else line
    return F.struct(
        F.lit(section).alias("section"),
        order.cast("bigint").alias("ord"),
        (F.lit("") if detail is None else detail).alias("detail"),
        line.alias("line"),
    )


def _heading(section: int, text: str | Column) -> list[Column]:
    rule = "-" * fixed.REPORT_WIDTH
    return [_row(section, i, t) for i, t in enumerate(["", rule, text, rule], start=-4)]


def _fixed_rows(totals: DataFrame, title_id: str, method: str, limits: Limits) -> DataFrame:
    double_rule = "=" * fixed.REPORT_WIDTH
    names = fixed.REPORT_SECTIONS
    alerts = (
        F.col("critical_alerts") + F.col("high_risk_alerts")
        + F.col("medium_risk_alerts") + F.col("low_risk_alerts")
    )
    errors = F.coalesce(F.try_divide("error_logs", "total_logs"), F.lit(0.0))

    def number(label: str, value: Column | str) -> Column:
        return F.concat(F.lit(f"{label}: "), F.format_number(value, 0))

    head = [double_rule, fixed.REPORT_TITLE, double_rule, "", f"Analysis: {title_id}"]
    rows = [_row(_HEAD, i, text) for i, text in enumerate(head)]
    origin = [
        F.when(F.col("files") == 1, F.concat(F.lit("Source: "), "first_file")).when(F.col("files") > 1, F.format_string("Source: %d files", "files")),
        F.concat(F.lit("Analysed: "), F.date_format("completed", "yyyy-MM-dd HH:mm:ss")),
        F.when(F.col("seconds").isNotNull(), F.format_string("Seconds taken: %.2f", "seconds")),
    ]
    rows += [_row(_HEAD, len(head) + i, line) for i, line in enumerate(origin)]
    summary = [
        number("Lines read", "total_logs"),
        number("Lines marked", "anomalies_found"),
        number("Alerts", alerts),
        F.lit(f"Method: {method}"),
    ]
    severity = [
        F.concat(F.lit(f"{label}: "), F.col(column).cast("string"))
        for label, column in (
            ("critical", "critical_alerts"),
            ("high", "high_risk_alerts"),
            ("medium", "medium_risk_alerts"),
            ("low", "low_risk_alerts"),
        )
    ]
    details = [F.concat(F.lit("Share of errors: "), F.format_string("%.2f%%", F.round(errors * 100, 2)))]
    advice = [
        F.when(F.col("critical_alerts") > 0, fixed.ADVICE_CRITICAL),
        F.when(F.col("high_risk_alerts") > fixed.ADVICE_HIGH_COUNT, fixed.ADVICE_HIGH),
        F.when(F.col("anomalies_found") > F.col("total_logs") * fixed.ADVICE_RATE_SHARE, fixed.ADVICE_RATE),
        F.when(errors > fixed.ADVICE_ERROR_SHARE, fixed.ADVICE_ERRORS),
        F.lit(fixed.ADVICE_ARCHIVE),
        F.lit(fixed.ADVICE_SCHEDULE),
    ]
    for section, name, lines in (
        (_SUMMARY, "summary", summary),
        (_SEVERITY, "severity", severity),
        (_DETAILS, "details", details),
        (_ADVICE, "advice", advice),
    ):
        rows += _heading(section, names[name])
        rows += [_row(section, i, line) for i, line in enumerate(lines)]
    rows += _heading(_ANOMALIES, _first_of("anomalies", limits.anomalies, F.col("anomalies_found")))
    rows += _heading(_ALERTS, _first_of("alerts", limits.alerts, alerts))
    rows += [_row(_END, i, t) for i, t in enumerate(["", double_rule, fixed.REPORT_END, double_rule])]
    return totals.select(F.inline(F.array(*rows))).filter(F.col("line").isNotNull())


def _first_of(section: str, n: int, count: Column) -> Column:
    return F.concat(
        F.lit(f"{fixed.REPORT_SECTIONS[section]} ({n} listed of "), count.cast("string"), F.lit(")")
    )


def _service_rows(anomalies: DataFrame) -> DataFrame:
    """Affected services by name, and again by falling number of anomalies."""
    counts = A.counts_by(anomalies.filter(F.col("service") != ""), "service", "n")
    service, n = F.col("service"), F.col("n")
    listed = counts.select(
        F.inline(
            F.array(
                _row(_DETAILS, 101, F.concat(F.lit("  - "), service), service),
                _row(
                    _DETAILS,
                    F.lit(2**62) - n,
                    F.concat(F.lit("  - "), service, F.lit(": "), n.cast("string"), F.lit(" lines")),
                    service,
                ),
            )
        )
    )
    titles = anomalies.sparkSession.range(1).select(
        F.inline(
            F.array(
                _row(_DETAILS, 100, "Services with marked lines:"),
                _row(_DETAILS, 2**61, "Services by marked lines:"),
            )
        )
    )
    return titles.unionByName(listed)


def _address_rows(anomalies: DataFrame, n: int) -> DataFrame:
    top = A.top_counts(
        anomalies.filter(F.col("ip_address") != ""), "ip_address", n, "n"
    )
    rank = F.row_number().over(Window.orderBy(F.desc("n"), "ip_address"))  # over the top rows only
    listed = top.withColumn("rank", rank).select(
        F.inline(
            F.array(
                _row(
                    _DETAILS,
                    F.col("rank") + 200,
                    F.concat(F.lit("  "), F.col("rank").cast("string"), F.lit(". "), F.col("ip_address")),
                )
            )
        )
    )
    title = anomalies.sparkSession.range(1).select(
        F.inline(F.array(_row(_DETAILS, 200, f"Addresses by marked lines ({n} listed):")))
    )
    return title.unionByName(listed)


def _known(column: str | Column) -> Column:
    return F.coalesce(F.nullif(F.col(column) if isinstance(column, str) else column, F.lit("")), F.lit("N/A"))


def _stamp() -> Column:
    return _known(F.date_format("timestamp", fixed.TIMESTAMP_FORMAT))


def _listed(df: DataFrame, order: list[Column | str], limit: int, section: int, title: str, fields: dict[str, Column]) -> DataFrame:
    """A numbered block of labelled lines for each of the first ``limit`` rows."""
    top = df.orderBy(*order).limit(limit)
    ranked = top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))  # at most ``limit`` rows
    first = F.col("rank") * 10
    lines = [
        _row(section, first, ""),
        _row(section, first + 1, F.concat(F.lit(f"[{title} "), F.col("rank").cast("string"), F.lit("]"))),
    ]
    for i, (label, value) in enumerate(fields.items(), start=2):
        lines.append(_row(section, first + i, F.concat(F.lit(f"  {label}: "), value)))
    return ranked.select(F.inline(F.array(*lines)))


def _anomaly_rows(anomalies: DataFrame, n: int) -> DataFrame:
    return _listed(
        anomalies, [F.asc("file_id"), F.asc("line_number")], n, _ANOMALIES, "Line",
        {
            "time": _stamp(),
            "service": _known("service"),
            "level": _known("level"),
            "message": _known("message"),
            "address": _known("ip_address"),
            "score": F.format_string("%.4f", "anomaly_score"),
            "severity": C.severity(),
        },
    )


def _alert_rows(alerts: DataFrame, n: int) -> DataFrame:
    return _listed(
        alerts, alert_order(), n, _ALERTS, "Alert",
        {
            "time": _stamp(),
            "service": _known("service"),
            "severity": F.col("severity"),
            "text": _known("message"),
        },
    )
