"""Physical plans: what must and must not be in them."""

import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
QUERIES = entry.queries()

# Queries that are pure column expressions, grouping and sorting.
RULE_QUERIES = [
    "parse_lines", "features", "pattern_anomalies", "alerts", "tumbling_service", "sliding_service",
    "timeline_hour", "service_trend", "log_totals", "top_ips", "analysis_statistics", "graph_edges",
    "graph_vertices", "summary_rates", "recent_anomalies",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", RULE_QUERIES)
def test_rule_queries_stay_on_the_jvm_and_read_the_input_once(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "Python" not in text and "Pandas" not in text and "Join" not in text
    assert text.count("FileScan parquet") == 1


@pytest.mark.parametrize("name,n", [("top_ips", 10), ("top_edges", 10), ("recent_anomalies", 100)])
def test_top_lists_sort_per_task(spark, name, n):
    assert f"TakeOrderedAndProject(limit={n}" in plan(QUERIES[name](spark, SF_DIR))


def test_scan_reads_only_what_is_needed(spark):
    text = plan(QUERIES["service_counts"](spark, SF_DIR))
    schema = text.split("ReadSchema: struct<")[1].split(">")[0]
    assert "props" not in schema
    # level and service only: two patterns
    assert text.count("regexp_extract(value") == 2


def test_groupings_aggregate_before_the_shuffle(spark):
    for name in ("timeline_hour", "service_trend", "graph_edges"):
        text = plan(QUERIES[name](spark, SF_DIR))
        assert "partial_count" in text or "partial_sum" in text
