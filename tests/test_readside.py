"""Pages, annotated lines, lists and the report."""

from datetime import datetime, timedelta

import pytest
from conftest import log_line
from pyspark.sql import functions as F

from emberlog.functions.params import AnalysisOptions
from emberlog.operators import readside, report
from emberlog.plans.analyze import METHOD_LABELS, analyze_rules
from emberlog.sources import tables, textlogs


@pytest.fixture
def rows(spark):
    def make(n):
        return spark.range(1, n + 1).select(
            F.lit("f").alias("file_id"), F.col("id").alias("line_number"),
            (F.col("id") / 100.0).cast("double").alias("anomaly_score"),
            F.when(F.col("id") % 2 == 0, "even").otherwise("odd").alias("service"),
        )

    return make


@pytest.mark.parametrize(
    "n,number,first,count,pages",
    [(0, 1, None, 0, 0), (50, 1, 1, 50, 1), (51, 2, 51, 1, 2), (120, 3, 101, 20, 3), (120, 4, None, 0, 3)],
)
def test_pages(rows, n, number, first, count, pages):
    got = readside.anomaly_page(rows(n), number=number).collect()
    assert len(got) == count
    if got:
        assert got[0].line_number == first
        assert {(r.page, r.total, r.pages) for r in got} == {(number, n, pages)}


@pytest.mark.parametrize("number", [1, 2, 5, 8, 9])
def test_deep_pages_equal_plain_pages(rows, number, monkeypatch):
    df = rows(400).repartition(7)
    order = [F.desc("service"), F.asc("line_number")]
    plain = readside.page(df, order, number, 50).collect()
    monkeypatch.setattr(readside, "DEEP_OFFSET", -1)
    assert readside.page(df, order, number, 50).collect() == plain


def test_page_filters(rows):
    got = readside.anomaly_page(rows(100), min_score=0.9, service="even").collect()
    assert [r.line_number for r in got] == [90, 92, 94, 96, 98, 100]
    assert got[0].total == 6


def test_walking_pages_by_key_visits_every_row_once(rows):
    seen, after = [], None
    while True:
        got = readside.page_after(rows(23), after, 5).collect()
        if not got:
            break
        seen += [r.line_number for r in got]
        after = (got[-1].file_id, got[-1].line_number)
    assert seen == list(range(1, 24))


def test_alert_order_is_most_urgent_then_newest(spark):
    t = datetime(2024, 1, 1)
    data = [(3, t, "MEDIUM", 1), (1, t, "CRITICAL", 2), (1, t + timedelta(1), "CRITICAL", 3), (1, None, "CRITICAL", 4), (2, t, "HIGH", 5)]
    df = spark.createDataFrame(data, "priority int, timestamp timestamp, severity string, line_number bigint").withColumn("file_id", F.lit("f"))
    assert [r.line_number for r in readside.alert_page(df).collect()] == [3, 2, 4, 5, 1]
    assert [r.line_number for r in readside.alert_page(df, severity="high").collect()] == [5]


def test_log_view_skips_blank_lines_but_keeps_numbers(spark, tmp_path):
    (tmp_path / "a.log").write_text("\n".join([log_line(), "", "   ", log_line(level="ERROR", rt=9000, message="timeout")]) + "\n")
    lines = textlogs.numbered_lines(spark, str(tmp_path))
    found = analyze_rules(lines).anomalies
    got = readside.log_view(lines, found).orderBy("line_number").collect()
    assert [(r.line_number, r.is_anomaly, r.severity, r.total) for r in got] == [(1, False, "normal", 2), (4, True, "high", 2)]
    assert got[0].anomaly_score == 0.0
    only = readside.log_view(lines, found, anomalies_only=True).collect()
    assert [r.line_number for r in only] == [4]
    columns = ["line_number", "content", "is_anomaly", "anomaly_score", "severity"]
    whole = readside.annotated_lines(lines, found).select(columns).orderBy("line_number").collect()
    assert whole == [tuple(r[c] for c in columns) for r in got]


def test_recent_anomalies(spark):
    df = spark.range(150).select(
        F.timestamp_seconds(F.col("id")).alias("timestamp"), F.lit("f").alias("file_id"), F.col("id").alias("line_number"))
    got = readside.recent_anomalies(df).collect()
    assert [r.line_number for r in got] == list(range(149, 49, -1))


@pytest.fixture
def written(spark, lines, tmp_path):
    def make(*values):
        root = str(tmp_path / "r")
        analyze_rules(lines(*values), AnalysisOptions(use_ml=False), stage=True).write(root)
        return [tables.read_table(spark, root, t) for t in (tables.STATISTICS, tables.ANOMALIES, tables.ALERTS)]

    return make


def test_list_and_result(written):
    statistics, found, alerts = written(log_line(), log_line(level="ERROR", rt=9000))
    row = readside.analysis_list(statistics).first()
    assert (row.filename, row.status, row.total_logs, row.anomalies_found) == ("a.log", "completed", 2, 1)
    one = readside.analysis_result(statistics, found, alerts, "a.log_1").first()
    assert (one.anomalies_count, one.alerts_count) == (1, 1)
    assert readside.analysis_result(statistics, found, alerts, "missing").count() == 0


def test_report_text(written):
    bad = log_line(level="ERROR", rt=9000, message="critical attack")
    statistics, found, alerts = written(*([log_line()] * 1200), *([bad] * 60), "[ERROR] - x")
    text = [r.value for r in report.ordered_report(
        report.report_lines("a.log_1", statistics, found, alerts, METHOD_LABELS["pattern_spark"])).collect()]
    assert text[1] == "Findings in service logs" and text[-2] == "(end)"
    for line in (
        "Analysis: a.log_1", "Lines read: 1,261", "Lines marked: 61", "critical: 60",
        "Marked lines in order (50 listed of 61)", "Most urgent alerts (30 listed of 60)",
        "  1. 192.168.1.1", "  - db-service: 60 lines", "[Line 50]", "[Alert 30]", "Share of errors: 4.84%",
        "- Look at the critical alerts first.",
    ):
        assert line in text, line
    assert "[Line 51]" not in text and "[Alert 31]" not in text
    assert not any("Many high" in l or "a tenth" in l or "in twenty" in l for l in text)
    at = text.index("[Line 1]")
    assert text[at + 1: at + 8] == [
        "  time: 2024-01-01 10:30:45.123", "  service: db-service", "  level: ERROR",
        "  message: critical attack", "  address: 192.168.1.1", "  score: 1.1000", "  severity: critical"]
    order = [text.index(t) for t in ("Overview", "Alerts by severity", "Errors, services, addresses", "What to do")]
    assert order == sorted(order)


def test_report_says_where_it_comes_from(written):
    statistics, found, alerts = written(log_line(), log_line(level="ERROR", rt=9000))
    head = lambda rows: [r.value for r in report.ordered_report(report.report_lines("x", rows, found, alerts, "m")).collect()][4:9]
    lines_ = head(statistics)
    assert lines_[:2] == ["Analysis: x", "Source: a.log"]
    assert lines_[2].startswith("Analysed: 20") and lines_[3].startswith("Seconds taken: ") and lines_[4] == ""
    two = statistics.unionByName(statistics.withColumns({"file_id": F.lit("b.log_2"), "processing_time": F.lit(99.5)}))
    assert "Source: 2 files" in head(two) and "Seconds taken: 99.50" in head(two)
    # records that were never written say what they can
    assert head(statistics.drop("analysis_completed", "processing_time"))[:3] == ["Analysis: x", "Source: a.log", ""]


def test_report_advice(written):
    high = log_line(level="ERROR", rt=9000)
    statistics, found, alerts = written(*([high] * 12), *([log_line()] * 20))
    text = [r.value for r in report.ordered_report(report.report_lines("f", statistics, found, alerts, "m")).collect()]
    assert "- Many high alerts: check which addresses they come from." in text
    assert "- More than a tenth of the lines are marked: check sources and threshold." in text
    assert "- More than one line in twenty is an error: check the services above." in text
    assert "- Look at the critical alerts first." not in text
