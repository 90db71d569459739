"""Interaction graph on hand-made rows."""

import json

import pytest
from conftest import log_line

from emberlog.operators import graph
from emberlog.operators.parse import parse_lines, valid_lines

EDGES = "src_type string, src string, dst string, weight bigint, avg_response_time double, error_count bigint"


def typed(df):
    return graph.typed_edges(graph.edge_measures(df))


def as_set(df):
    return {tuple(r) for r in df.collect()}


@pytest.fixture
def small(lines):
    return valid_lines(parse_lines(lines(
        log_line(ip="1.1.1.1", user="u1", service="a-svc", rt=100, level="ERROR"),
        log_line(ip="1.1.1.1", user="u2", service="a-svc", rt=300),
        log_line(ip="2.2.2.2", user="u1", service="b-svc", rt=50),
        "[INFO] b-svc - m | IP: 2.2.2.2 | User: u1",
    )))


def test_edges_and_vertices(small):
    assert as_set(graph.graph_edges(small)) == {
        ("1.1.1.1", "a-svc", 2, 200.0, 1), ("2.2.2.2", "b-svc", 2, 50.0, 0),
        ("u1", "a-svc", 1, 100.0, 1), ("u2", "a-svc", 1, 300.0, 0), ("u1", "b-svc", 2, 50.0, 0),
    }
    expected = {
        ("a-svc", "service"), ("b-svc", "service"), ("1.1.1.1", "ip"), ("2.2.2.2", "ip"),
        ("u1", "user"), ("u2", "user"),
    }
    assert as_set(graph.graph_vertices(small)) == expected
    assert as_set(graph.vertices_of(typed(small))) == expected


def test_edge_without_response_times_has_no_average(lines):
    df = parse_lines(lines("[INFO] b-svc - m | IP: 2.2.2.2 | User: u1"))
    assert {r.avg_response_time for r in graph.graph_edges(df).collect()} == {None}


def test_node_statistics_with_and_without_joins(spark, small):
    edges = typed(small).unionByName(spark.createDataFrame(
        [("user", "a-svc", "b-svc", 7, 1.0, 0), ("ip", None, "b-svc", 3, 1.0, 0)], EDGES))
    columns = ["id", "type", "out_degree", "total_interactions", "in_degree", "total_incoming"]
    joined = as_set(graph.node_statistics(graph.vertices_of(edges), edges).select(columns))
    assert joined == as_set(graph.node_statistics_of(edges).select(columns))
    # an id in two roles is two vertices with the degrees of the id
    assert ("a-svc", "service", 1, 7, 3, 4) in joined and ("a-svc", "user", 1, 7, 3, 4) in joined
    assert (None, "ip", 0, 0, 0, 0) in joined


def test_merging_measures_equals_one_pass(lines, small):
    a, b = small.filter("line_number <= 2"), small.filter("line_number > 2")
    parts = graph.edge_measures(a).unionByName(graph.edge_measures(b))
    assert as_set(graph.typed_edges(graph.merge_measures(parts))) == as_set(typed(small))


def test_node_score_steps(spark):
    # mean out-degree of the addresses: 40 / 4 = 10
    nodes = [("i1", "ip", 5), ("i2", "ip", 15), ("i3", "ip", 0), ("i4", "ip", 20), ("u", "user", 99)]
    df = spark.createDataFrame(nodes, "id string, type string, out_degree bigint")
    got = {r.id: (r.degree_anomaly_score, r.graph_anomaly_score) for r in graph.node_scores(df).collect()}
    assert got == {"i1": (0.5, 0.1), "i2": (1.5, 0.1), "i3": (0.0, 0.1), "i4": (2.0, 0.5), "u": (1.0, 0.1)}


@pytest.mark.parametrize("ratio_degree,score", [(16, 0.5), (21, 0.8), (30, 0.8), (31, 1.0)])
def test_node_score_just_above(spark, ratio_degree, score):
    # the fixed mean of 10 is kept by one compensating address
    rows = [("x", "ip", ratio_degree), ("y", "ip", 40 - ratio_degree), ("z", "ip", 0), ("w", "ip", 0)]
    df = spark.createDataFrame(rows, "id string, type string, out_degree bigint")
    assert {r.id: r.graph_anomaly_score for r in graph.node_scores(df).collect()}["x"] == score


def test_no_addresses_and_zero_mean(spark):
    schema = "id string, type string, out_degree bigint"
    row = graph.node_scores(spark.createDataFrame([("u", "user", 3)], schema)).first()
    assert (row.degree_anomaly_score, row.graph_anomaly_score) == (1.0, 0.1)
    row = graph.node_scores(spark.createDataFrame([("i", "ip", 0)], schema)).first()
    assert row.degree_anomaly_score == 0.0


def test_edge_score_order(spark):
    rows = [("ip", "s", "d", 1, a, e) for e, a in [(6, 0.0), (5, 2001.0), (2, 2001.0), (3, 2000.0), (2, 2000.0), (0, None)]]
    got = [r.edge_anomaly_score for r in graph.edge_scores(spark.createDataFrame(rows, EDGES)).collect()]
    assert got == [0.9, 0.8, 0.8, 0.6, 0.2, 0.2]


def test_suspicious_addresses_and_their_targets(spark):
    scored = spark.createDataFrame(
        [("i1", "ip", 9, 1.0), ("i2", "ip", 5, 0.8), ("i3", "ip", 1, 0.5), ("s", "service", 0, 1.0)],
        "id string, type string, out_degree bigint, graph_anomaly_score double",
    )
    edges = spark.createDataFrame(
        [("ip", "i1", "a", 1, 1.0, 2), ("ip", "i2", "a", 1, 1.0, 3), ("ip", "i1", "b", 1, 1.0, 0),
         ("ip", "i3", "b", 1, 1.0, 9)], EDGES)
    ips = graph.suspicious_ips(scored)
    assert {r.id for r in ips.collect()} == {"i1", "i2"}
    rows = graph.targeted_services(graph.suspicious_connections(edges, ips)).collect()
    assert [tuple(r) for r in rows] == [("a", 2, 5, 0.9), ("b", 1, 0, 1.0)]


def test_export_skips_unusable_ends(spark):
    vertices = spark.createDataFrame(
        [("a", "service"), ("i", "ip"), ("", "ip"), (" ", "user"), ("None", "user"), (None, "ip"), ("t", None)],
        "id string, type string")
    edges = spark.createDataFrame(
        [("ip", "i", "a", 5, 1.0, 0), ("ip", "", "a", 1, 1.0, 0), ("ip", None, "a", 1, 1.0, 0),
         ("ip", "None", "a", 1, 1.0, 0), ("ip", "i", "gone", 1, 1.0, 0), ("ip", " i ", "a", None, 1.0, 0)], EDGES)
    nodes = graph.export_nodes(vertices)
    assert as_set(nodes) == {("a", "service", "a"), ("i", "ip", "i"), ("t", "unknown", "t")}
    assert sorted(map(tuple, graph.export_links(nodes, edges).collect())) == [("i", "a", 1), ("i", "a", 5)]
    assert graph.skipped_links(nodes, edges).count() == 4
    doc = json.loads(graph.graph_json(vertices, edges, 10, 10).first().value)
    assert [n["id"] for n in doc["nodes"]] == ["a", "i", "t"]
    assert doc["links"][0] == {"source": "i", "target": "a", "value": 5}
    assert (doc["nodes_left_out"], doc["links_left_out"]) == (0, 0)


def test_export_is_whole_and_the_preview_says_what_it_leaves_out(spark):
    vertices = spark.range(400).selectExpr("concat('n', lpad(id, 4, '0')) as id", "'user' as type")
    edges = spark.range(400).selectExpr(
        "'user' as src_type", "concat('n', lpad(id, 4, '0')) as src", "'n0000' as dst", "id + 1 as weight",
        "1.0D as avg_response_time", "0L as error_count")
    kinds = [r.kind for r in graph.graph_lines(vertices, edges).collect()]
    assert (kinds.count("node"), kinds.count("link")) == (400, 400)
    doc = json.loads(graph.graph_json(vertices, edges, 150, 100).first().value)
    assert [n["id"] for n in doc["nodes"]] == [f"n{i:04d}" for i in range(150)]
    assert [l["value"] for l in doc["links"]] == list(range(150, 50, -1))  # both ends are in the document
    assert (doc["nodes_left_out"], doc["links_left_out"]) == (250, 300)


def test_empty_graph(spark):
    empty = spark.createDataFrame([], EDGES)
    doc = json.loads(graph.graph_json(graph.vertices_of(empty), empty, 10, 10).first().value)
    assert doc == {"nodes": [], "links": [], "nodes_left_out": 0, "links_left_out": 0}
    assert graph.graph_lines(graph.vertices_of(empty), empty).count() == 0
