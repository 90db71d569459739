"""Rule scores, severities, alerts and the enhanced score."""

import pytest
from conftest import log_line
from pyspark.sql import functions as F

from emberlog.functions import columns as C
from emberlog.operators import centers, rules
from emberlog.operators.parse import parse_lines

KEYWORDS = "timeout error exception failed critical denied exhausted deadlock breach attack".split()


def scores(df):
    return [r.anomaly_score for r in rules.with_pattern_score(parse_lines(df)).orderBy("line_number").collect()]


def test_pattern_score_parts(lines):
    df = lines(
        log_line(), log_line(level="ERROR"), log_line(level="WARN"),
        log_line(rt=1000), log_line(rt=1001), log_line(rt=5000), log_line(rt=5001),
    )
    assert scores(df) == [0.0, 0.4, 0.2, 0.0, 0.1, 0.1, 0.3]


def test_each_keyword_counts_once_and_sums(lines):
    assert scores(lines(*[log_line(message=f"x {w.upper()} {w} y") for w in KEYWORDS])) == [0.2] * 10
    assert scores(lines(log_line(message="timeout then deadlock"))) == [0.4]
    assert scores(lines(log_line(level="ERROR", rt=6000, message=" ".join(KEYWORDS)))) == [
        0.4 + 0.3 + 0.2 + 0.2 + 0.2 + 0.2 + 0.2 + 0.2 + 0.2 + 0.2 + 0.2 + 0.2
    ]


def test_double_order_keeps_a_near_miss_high(lines):
    df = lines(log_line(level="ERROR", rt=5001, message="timeout"))
    row = rules.with_severity(rules.with_pattern_score(parse_lines(df))).first()
    assert row.anomaly_score == 0.8999999999999999
    assert (row.severity, row.priority) == ("high", 2)


@pytest.mark.parametrize(
    "score,label,priority",
    [(0.3999, "low", 4), (0.4, "low", 4), (0.4999, "low", 4), (0.5, "medium", 3), (0.6999, "medium", 3),
     (0.7, "high", 2), (0.8999999999999999, "high", 2), (0.9, "critical", 1), (1.3, "critical", 1)],
)
def test_severity_boundaries(spark, score, label, priority):
    row = spark.range(1).select(C.severity(F.lit(score)).alias("s"), C.priority(F.lit(score)).alias("p")).first()
    assert (row.s, row.p) == (label, priority)


def test_alerts_need_half_a_point_and_are_reproducible(lines):
    df = lines(
        log_line(level="ERROR"),                                      # 0.4, no alert
        log_line(level="ERROR", rt=2000, message="x" * 150),           # 0.5
        log_line(level="ERROR", rt=9000, message="timeout failed"),    # 1.1
    )
    found = rules.anomaly_records(rules.pattern_anomalies(parse_lines(df)), "pattern_spark")
    assert found.columns == rules.RECORD_COLUMNS and found.count() == 3
    rows = rules.alerts(found).orderBy("line_number").collect()
    assert [r.severity for r in rows] == ["MEDIUM", "CRITICAL"]
    assert [r.priority for r in rows] == [3, 1]
    assert rows[0].message.startswith("MEDIUM anomaly in db-service: " + "x" * 101)
    assert rows[0].id == "alert_a.log_1_2"
    assert rows[1].details.asDict() == {
        "level": "ERROR", "user": "user_0001", "response_time": 9000, "analysis_type": "pattern_spark",
    }


@pytest.mark.parametrize(
    "service,level,ip,rt,cluster,expected",
    [
        ("db-service", "ERROR", "1.1.1.1", 2000, 0, 0.2),
        ("db-service", "INFO", "1.1.1.1", 2001, 0, 0.2 + 0.1),
        ("db-service", "INFO", "1.1.1.1", 5001, 0, 0.2 + 0.3),
        ("auth-service", "ERROR", "1.1.1.1", None, 0, 0.2 + 0.2),
        ("security-service", "WARN", "1.1.1.1", 0, 0, 0.2 + 0.1),
        ("db-service", "INFO", "0.1.2.3", 0, 0, 0.2 + 0.25),
        ("db-service", "INFO", "10.0.0.0", 0, 0, 0.2),
        ("db-service", "INFO", "1.666.0.0", 0, 2, 0.2 + 0.25),
        ("db-service", "INFO", "1.1.1.1", 0, 3, 0.2 + 0.2),
        ("auth-service", "ERROR", "9.999.1.1", 9000, 4, 1.0),
    ],
)
def test_enhanced_score(spark, service, level, ip, rt, cluster, expected):
    df = spark.createDataFrame(
        [(service, level, ip, rt, cluster, 0.6)],
        "service string, level string, ip_address string, response_time int, cluster int, distance_to_center double",
    )
    row = centers.enhanced_scores(df, centers.rare_cluster_by_id()).first()
    assert row.anomaly_score == pytest.approx(expected)


def test_linear_score_without_distance_is_a_half(spark):
    df = spark.createDataFrame([(None,), (0.0,), (1.5,), (3.0,), (99.0,)], "distance_to_center double")
    got = [r.anomaly_score for r in centers.linear_scores(df).collect()]
    assert got == [0.5, 0.0, 0.5, 1.0, 1.0]


def test_human_sizes_and_percentages(spark):
    sizes = [r[0] for r in spark.createDataFrame([(0,), (1023,), (1024,), (1048576,)], "length bigint").select(C.human_size()).collect()]
    assert sizes == ["0 B", "1023 B", "1.00 KB", "1.00 MB"]
    row = spark.range(1).select(
        C.percentage(F.lit(0), F.lit(0)).alias("none"), C.percentage(F.lit(1), F.lit(3)).alias("third")
    ).first()
    assert (row.none, row.third) == (0.0, 33.33)
