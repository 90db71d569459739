"""Parsing, validity and features on hand-made lines."""

from datetime import datetime

import pytest
from conftest import log_line
from pyspark.sql import functions as F

from emberlog.functions import fixed
from emberlog.operators.parse import (
    complete_rows, extract_features, parse_lines, rejected_rows, render_lines, valid_lines,
)


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_good_line_keeps_milliseconds(lines):
    row = one(parse_lines(lines(log_line())))
    assert row.timestamp == datetime(2024, 1, 1, 10, 30, 45, 123000)
    assert (row.level, row.service, row.message) == ("INFO", "db-service", "request served")
    assert (row.ip_address, row.user, row.response_time) == ("192.168.1.1", "user_0001", 100)
    assert (row.file_id, row.line_number) == ("a.log_1", 1)


@pytest.mark.parametrize("value", ["", "free text without structure"])
def test_text_without_structure(lines, value):
    row = one(parse_lines(lines(value)))
    assert row.timestamp is None and row.response_time is None
    assert row.level == row.service == row.message == row.ip_address == row.user == ""


def test_null_line_is_null_and_invalid(lines):
    df = parse_lines(lines(None))
    assert one(df).level is None
    assert valid_lines(df).count() == 0


def test_unknown_level_and_service_names(lines):
    rows = parse_lines(
        lines(log_line(level="FATAL"), log_line(service="db2-service"), log_line(service="Db-service"))
    ).collect()
    assert rows[0].level == ""
    assert rows[1].service == "" and rows[2].service == ""
    assert valid_lines(parse_lines(lines(log_line(level="FATAL"), log_line(service="Api")))).count() == 0


def test_message_stops_at_first_bar_and_starts_at_first_dash(lines):
    row = one(parse_lines(lines(log_line(message="a - b | c"))))
    assert row.message == "a - b"


def test_bad_values_are_null_under_ansi(spark, lines):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    bad_date = one(parse_lines(lines(log_line(ts="2024-02-30 00:00:00.000"))))
    assert bad_date.timestamp is None and bad_date.level == "INFO"
    assert one(parse_lines(lines(log_line(ts="2024-01-01 10:30:45")))).timestamp is None
    assert one(parse_lines(lines(log_line(rt=99999999999)))).response_time is None
    assert one(parse_lines(lines("2024-01-01 10:30:45.123 [INFO] a-b - m | IP: 1.1.1.1"))).response_time is None


def test_fields_limits_columns_and_keeps_order(lines):
    df = parse_lines(lines(log_line()), ("service", "level"))
    assert df.columns == ["file_id", "line_number", "level", "service"]


def test_render_is_the_inverse_of_parse(lines):
    text = log_line(level="WARN", message="slow call", rt=2500)
    assert one(render_lines(parse_lines(lines(text)))).value == text


@pytest.mark.parametrize(
    "rt,high,very_high",
    [(0, 0, 0), (1000, 0, 0), (1001, 1, 0), (2000, 1, 0), (5000, 1, 0), (5001, 1, 1)],
)
def test_response_time_flags(lines, rt, high, very_high):
    row = one(extract_features(parse_lines(lines(log_line(rt=rt)))))
    assert (row.high_response_time, row.very_high_response_time) == (high, very_high)


def test_missing_response_time_gives_zero_flags(lines):
    row = one(extract_features(parse_lines(lines("[INFO] a-b - m | IP: 1.1.1.1"))))
    assert (row.high_response_time, row.very_high_response_time) == (0, 0)
    assert row.hour is None and row.minute is None


@pytest.mark.parametrize(
    "ip,flag",
    [("10.0.0.0", 1), ("0.0.0.0", 1), ("0.1.2.3", 0), ("1.666.2.3", 1), ("99.9.1.1", 0), ("172.16.0.1", 0)],
)
def test_suspicious_ip(lines, ip, flag):
    assert one(extract_features(parse_lines(lines(log_line(ip=ip))))).suspicious_ip == flag


@pytest.mark.parametrize(
    "message,flag",
    [("Timeout!", 1), ("ERROR", 1), ("exception", 1), ("failed", 1), ("Critical", 1), ("denied", 1),
     ("exhausted", 1), ("deadlock", 1), ("breach", 0), ("attack", 0), ("fine", 0)],
)
def test_error_keyword(lines, message, flag):
    assert one(extract_features(parse_lines(lines(log_line(message=message))))).has_error_keyword == flag


def test_levels_time_and_length(lines):
    rows = extract_features(
        parse_lines(lines(*[log_line(level=l) for l in ("ERROR", "WARN", "INFO", "DEBUG")]))
    ).orderBy("line_number").collect()
    assert [(r.level_error, r.level_warn, r.level_info) for r in rows] == [
        (1, 0, 0), (0, 1, 0), (0, 0, 1), (0, 0, 0),
    ]
    assert (rows[0].hour, rows[0].minute, rows[0].message_length) == (10, 30, len("request served"))


def test_rejects_complement_complete_rows(lines):
    df = extract_features(
        parse_lines(lines(log_line(), "[WARN] a-b - m | IP: 1.1.1.1", log_line(ts="2024-02-30 00:00:00.000")))
    )
    for names in (fixed.FEATURES_8, fixed.FEATURES_11):
        good = complete_rows(df, names).count()
        bad = rejected_rows(df, names).count()
        assert good + bad == 3
    assert rejected_rows(df, fixed.FEATURES_8).count() == 1
    assert rejected_rows(df, fixed.FEATURES_11).count() == 2


def test_filters_do_not_run_the_patterns_again(lines):
    plan = (
        valid_lines(parse_lines(lines(log_line()))).filter(F.col("message") != "")
        ._jdf.queryExecution().optimizedPlan().toString()
    )
    assert plan.count("regexp_extract(value") == 7
