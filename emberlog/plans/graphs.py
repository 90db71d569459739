"""Graphs: build, score and export."""

from __future__ import annotations

from pyspark.sql import DataFrame

from emberlog.operators import graph
from emberlog.sources.scratch import staged


def build_graph(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Vertices and edges; the edges are written once and everything else reads them."""
    edges = staged(graph.typed_edges(graph.edge_measures(parsed)), "edges")
    return graph.vertices_of(edges), edges


def graph_anomalies(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Scored nodes and scored edges of a built graph."""
    nodes = staged(graph.node_statistics_of(edges), "nodes")
    return graph.node_scores(nodes), graph.edge_scores(edges)


def anomalous_patterns(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Suspicious addresses and the services they target."""
    ips = graph.suspicious_ips(nodes)
    return ips, graph.targeted_services(graph.suspicious_connections(edges, ips))


def export_graph(vertices: DataFrame, edges: DataFrame, path: str) -> None:
    """Write the whole graph as JSON lines, one folder for nodes and one for links.

    A failure is raised; what an earlier export wrote elsewhere stays readable.
    """
    graph.graph_lines(vertices, edges).write.mode("overwrite").partitionBy("kind").text(path)
