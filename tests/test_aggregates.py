"""Aggregates and statistics on small inputs."""

from datetime import datetime

import pytest
from conftest import log_line
from pyspark.sql import functions as F

from emberlog.operators import aggregates as A
from emberlog.operators import rules
from emberlog.operators import statistics as S
from emberlog.operators.parse import extract_features, parse_lines, valid_lines


def features(df):
    return extract_features(valid_lines(parse_lines(df)))


def test_tumbling_and_sliding_windows(lines):
    df = features(lines(
        log_line(ts="2024-01-01 00:00:05.000", rt=100, level="ERROR"),
        log_line(ts="2024-01-01 00:00:55.000", rt=300, level="WARN", ip="10.0.0.666"),
        log_line(ts="2024-01-01 00:01:00.000", rt=50),
        log_line(ts="2024-02-30 00:00:00.000"),
    ))
    rows = A.windowed_metrics(df).orderBy("window").collect()
    assert [r.log_count for r in rows] == [2, 1]
    first = rows[0]
    assert (first.avg_response_time, first.error_count, first.warn_count, first.suspicious_ip_count) == (200.0, 1, 1, 1)
    assert first.stddev_response_time == pytest.approx(141.4213562)
    assert rows[1].stddev_response_time is None
    sliding = A.windowed_metrics(df, "30 seconds", "10 seconds")
    assert sliding.agg(F.sum("log_count")).first()[0] == 9
    assert sliding.filter("window.start = timestamp'2023-12-31 23:59:40'").count() == 1


def test_service_trend_and_totals(lines):
    df = features(lines(log_line(level="ERROR", rt=10), log_line(level="WARN", rt=20), log_line(service="x-y", rt=5)))
    trend = {r.service: (r.error_count, r.warn_count, r.avg_response_time) for r in A.service_trend(df).collect()}
    assert trend == {"db-service": (1, 1, 15.0), "x-y": (0, 0, 5.0)}
    total = A.log_totals(df).first()
    assert (total.total_logs, total.error_logs, total.warn_logs, total.max_response_time) == (3, 1, 1, 20)


def test_top_counts_break_ties_by_value(lines):
    df = parse_lines(lines(*[log_line(ip=f"1.1.1.{i % 15}") for i in range(30)]))
    assert [r.ip_address for r in A.top_counts(df, "ip_address").collect()] == sorted(f"1.1.1.{i}" for i in range(15))[:10]


def test_empty_input_gives_zero_records(lines):
    none = rules.with_pattern_score(parse_lines(lines("x"))).filter("false")
    stats = S.analysis_statistics(none, F.col("anomaly_score") >= 0.4)
    row = stats.first()
    assert row.total_logs == 0 and row.anomalies_found == 0 and row.first_timestamp is None
    rates = S.summary_rates(stats).first()
    assert (rates.anomaly_rate, rates.critical_rate) == (0.0, 0.0)
    assert S.live_counters(none).first().anomaly_rate == 0.0
    assert {r.anomaly_count for r in A.severity_distribution(none).collect()} == {0}


def test_rates_without_anomalies(lines):
    stats = S.analysis_statistics(rules.with_pattern_score(parse_lines(lines(log_line()))), F.col("anomaly_score") >= 0.4)
    row = S.summary_rates(stats).first()
    assert (row.anomaly_rate, row.critical_rate, row.services_count) == (0.0, 0.0, 0)


def test_first_and_last_follow_line_order_and_skip_undated(lines):
    df = parse_lines(lines(
        log_line(ts="2024-02-30 00:00:00.000"), log_line(ts="2024-01-05 00:00:00.000"),
        log_line(ts="2024-01-01 00:00:00.000"), log_line(ts="2024-01-03 00:00:00.000"),
        "no date",
    ))
    row = A.first_last(df).first()
    assert row.first_timestamp == datetime(2024, 1, 5) and row.last_timestamp == datetime(2024, 1, 3)


def test_error_patterns_use_the_whole_message(lines):
    df = parse_lines(lines(
        log_line(level="ERROR", message="a" * 80 + "1"), log_line(level="ERROR", message="a" * 80 + "1"),
        log_line(level="WARN", message="w"),
    ))
    assert [tuple(r) for r in A.error_patterns(df).collect()] == [("a" * 80 + "1", 2)]


def test_live_counters_count_each_line_once(spark):
    df = spark.createDataFrame([(0.1,), (0.6,), (0.7,), (0.8,), (0.81,)], "anomaly_score double")
    row = S.live_counters(df).first()
    assert (row.total_logs, row.total_anomalies, row.critical_alerts, row.anomaly_rate) == (5, 3, 1, 0.6)


def test_trained_statistics(lines):
    scored = features(lines(
        log_line(ip="1.1.1.1", rt=10, level="ERROR", ts="2024-01-02 00:00:00.000"),
        log_line(ip="1.1.1.1", rt=20), log_line(ip="2.2.2.2", rt=30, level="WARN"),
        log_line(ip="3.3.3.3", rt=40),
    )).withColumn("anomaly_score", F.element_at(F.array(*map(F.lit, (0.95, 0.45, 0.4, 0.7))), F.col("line_number").cast("int")))
    row = S.trained_statistics(scored, top_ips=2).first()
    assert (row.total_logs, row.anomalies_found, row.error_logs, row.warn_logs) == (4, 3, 1, 1)
    assert (row.critical_alerts, row.high_risk_alerts, row.medium_risk_alerts, row.low_risk_alerts) == (1, 1, 0, 1)
    assert row.avg_response_time == 25.0 and row.max_response_time == 40
    assert row.start_time < row.end_time == datetime(2024, 1, 2)
    assert row.top_ips == ["1.1.1.1", "2.2.2.2"]


def test_file_totals(spark):
    df = spark.createDataFrame([(True, 4), (False, 9), (True, 1)], "success boolean, anomalies_found bigint")
    assert tuple(S.file_totals(df).first()) == (3, 2, 1, 5)
