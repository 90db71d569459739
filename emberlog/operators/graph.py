"""Interaction graph of addresses, users and services.

The graph is two DataFrames.  Edges come from one grouped pass over the log;
everything else (vertices, degrees, scores) is derived from the edges, which
are far fewer than the lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.functions import columns as C
from emberlog.functions import fixed
from emberlog.functions.params import Thresholds

GRAPH_FIELDS = ("level", "service", "ip_address", "user", "response_time")
_KEY = ["src_type", "src", "dst"]


# -------------------------------------------------------------------- build


def edge_measures(parsed: DataFrame) -> DataFrame:
    """Mergeable edge measures: counts and sums per (source, service).

    Each row feeds its address edge and its user edge, so the log is parsed and
    shuffled once for both kinds.
    """
    ends = F.array(
        F.struct(F.lit("ip").alias("src_type"), F.col("ip_address").alias("src")),
        F.struct(F.lit("user").alias("src_type"), F.col("user").alias("src")),
    )
    return (
        parsed.select(F.inline(ends), F.col("service").alias("dst"), "response_time", "level")
        .groupBy(*_KEY)
        .agg(
            F.count("*").alias("weight"),
            F.sum("response_time").alias("response_sum"),
            F.count("response_time").alias("response_n"),
            F.count_if(F.col("level") == "ERROR").alias("error_count"),
        )
    )


def merge_measures(measures: DataFrame) -> DataFrame:
    """Combine measures of several batches into one row per edge."""
    return measures.groupBy(*_KEY).agg(
        *[F.sum(c).alias(c) for c in ("weight", "response_sum", "response_n", "error_count")]
    )


def typed_edges(measures: DataFrame) -> DataFrame:
    return measures.select(
        *_KEY,
        "weight",
        F.try_divide("response_sum", "response_n").alias("avg_response_time"),
        "error_count",
    )


def graph_edges(parsed: DataFrame) -> DataFrame:
    """``src, dst, weight, avg_response_time, error_count``: address and user edges."""
    return typed_edges(edge_measures(parsed)).drop("src_type")


def graph_vertices(parsed: DataFrame) -> DataFrame:
    """``id, type``: the distinct services, addresses and users.

    An id that occurs in two roles is two vertices.
    """
    return parsed.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.col(column).alias("id"), F.lit(kind).alias("type"))
                    for column, kind in (("service", "service"), ("ip_address", "ip"), ("user", "user"))
                ]
            )
        )
    ).distinct()


def vertices_of(edges: DataFrame) -> DataFrame:
    """The same vertices, taken from typed edges."""
    return edges.select(
        F.inline(
            F.array(
                F.struct(F.col("src").alias("id"), F.col("src_type").alias("type")),
                F.struct(F.col("dst").alias("id"), F.lit("service").alias("type")),
            )
        )
    ).distinct()


# ------------------------------------------------------------------ degrees


def out_degree(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("src").alias("node_id")).agg(
        F.count("*").alias("out_degree"), F.sum("weight").alias("total_interactions")
    )


def in_degree(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("dst").alias("node_id")).agg(
        F.count("*").alias("in_degree"), F.sum("weight").alias("total_incoming")
    )


def node_statistics(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Vertices left-joined with their degrees; missing numbers become zero."""
    out = out_degree(edges).withColumnRenamed("node_id", "id")
    into = in_degree(edges).withColumnRenamed("node_id", "id")
    return vertices.join(out, "id", "left").join(into, "id", "left").fillna(0)


def node_statistics_of(edges: DataFrame) -> DataFrame:
    """:func:`node_statistics` straight from typed edges, without any join.

    Each edge is seen once from its source and once from its service; one
    grouping by id adds up both sides.  Degrees belong to the id, so an id with
    two types gives two vertices with equal degrees, and NULL ids have none.
    """
    zero = F.lit(0).cast("bigint")
    one = F.lit(1).cast("bigint")
    sides = F.array(
        F.struct(
            F.col("src").alias("id"), F.col("src_type").alias("type"),
            one.alias("o"), F.col("weight").alias("ow"), zero.alias("i"), zero.alias("iw"),
        ),
        F.struct(
            F.col("dst").alias("id"), F.lit("service").alias("type"),
            zero.alias("o"), zero.alias("ow"), one.alias("i"), F.col("weight").alias("iw"),
        ),
    )

    def degree(name: str) -> Column:
        return F.when(F.col("id").isNotNull(), F.col(name)).otherwise(zero)

    by_id = (
        edges.select(F.inline(sides))
        .groupBy("id")
        .agg(
            F.collect_set("type").alias("types"),  # at most three values
            *[F.sum(c).alias(c) for c in ("o", "ow", "i", "iw")],
        )
    )
    return by_id.select(
        "id",
        F.explode("types").alias("type"),
        degree("o").alias("out_degree"),
        degree("ow").alias("total_interactions"),
        degree("i").alias("in_degree"),
        degree("iw").alias("total_incoming"),
    )


# ------------------------------------------------------------------- scores


def _steps(value: Column) -> Column:
    score = F.lit(fixed.NODE_SCORE_DEFAULT)
    for bound, level in reversed(fixed.NODE_SCORE_STEPS):
        score = F.when(value > bound, level).otherwise(score)
    return score


def node_scores(nodes: DataFrame) -> DataFrame:
    """Degree score of addresses against the mean address degree, and its step score.

    The mean is a scalar subquery: one number, computed once.  Pass nodes that
    are backed by a written table when they are expensive to compute.
    """
    mean = nodes.filter(F.col("type") == "ip").agg(
        C.usable_spread(F.avg("out_degree")).alias("mean")
    )
    return nodes.withColumn(
        "degree_anomaly_score",
        F.when(F.col("type") == "ip", F.col("out_degree") / mean.scalar()).otherwise(1.0),
    ).withColumn("graph_anomaly_score", _steps(F.col("degree_anomaly_score")))


def edge_scores(edges: DataFrame) -> DataFrame:
    errors, slow = F.col("error_count"), F.col("avg_response_time")
    return edges.withColumn(
        "edge_anomaly_score",
        F.when(errors > fixed.EDGE_MANY_ERRORS, fixed.EDGE_MANY_ERRORS_SCORE)
        .when(slow > fixed.EDGE_SLOW_MS, fixed.EDGE_SLOW_SCORE)
        .when(errors > fixed.EDGE_SOME_ERRORS, fixed.EDGE_SOME_ERRORS_SCORE)
        .otherwise(fixed.EDGE_SCORE_DEFAULT),
    )


def suspicious_ips(scored_nodes: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    return scored_nodes.filter(
        (F.col("type") == "ip") & (F.col("graph_anomaly_score") > thresholds.suspicious_node)
    ).select("id", "graph_anomaly_score", "out_degree")


def suspicious_nodes(scored_nodes: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    return scored_nodes.filter(F.col("graph_anomaly_score") > thresholds.suspicious_node)


def suspicious_connections(edges: DataFrame, ips: DataFrame) -> DataFrame:
    """Edges that start at a suspicious address.

    No broadcast hint: how many addresses are suspicious depends on the data,
    so the join strategy follows their measured size.
    """
    return edges.join(ips, edges["src"] == ips["id"]).select(
        F.col("src").alias("suspicious_ip"),
        F.col("dst").alias("target_service"),
        "weight",
        "error_count",
        "graph_anomaly_score",
    )


def targeted_services(connections: DataFrame) -> DataFrame:
    return (
        connections.groupBy("target_service")
        .agg(
            F.count("*").alias("attack_count"),
            F.sum("error_count").alias("total_errors"),
            F.avg("graph_anomaly_score").alias("avg_anomaly_score"),
        )
        .orderBy(F.desc("attack_count"), "target_service")
    )


def top_edges(edges: DataFrame, n: int = 10) -> DataFrame:
    return edges.orderBy(F.desc("weight"), "src", "dst").limit(n)


# ------------------------------------------------------------------- export


def _named(column: str) -> Column:
    return (F.trim(column) != "") & (F.col(column) != "None")


def export_nodes(vertices: DataFrame) -> DataFrame:
    """``id, type, label`` of vertices with a usable id."""
    return vertices.filter(_named("id")).select(
        "id", F.coalesce(F.nullif("type", F.lit("")), F.lit("unknown")).alias("type"),
        F.col("id").alias("label"),
    )


def export_links(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``source, target, value`` of edges whose two ends are exported nodes.

    One service can be the target of a third of all edges.  Its membership is
    decided on the distinct targets, a small table, so the edges are not
    shuffled by a hot key.
    """
    ids = nodes.select("id").distinct()
    links = edges.filter(_named("src") & _named("dst")).select(
        F.trim("src").alias("source"),
        F.trim("dst").alias("target"),
        F.greatest(F.coalesce("weight", F.lit(1)), F.lit(1)).alias("value"),
    )
    targets = (
        links.select("target").distinct()
        .join(ids.withColumnRenamed("id", "target"), "target", "left_semi")
    )
    return links.join(targets, "target", "left_semi").join(
        ids.withColumnRenamed("id", "source"), "source", "left_semi"
    )


def skipped_links(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges that :func:`export_links` leaves out."""
    kept = export_links(nodes, edges).select("source", "target").distinct()
    return edges.join(
        kept,
        (F.trim(edges["src"]) == kept["source"]) & (F.trim(edges["dst"]) == kept["target"]),
        "left_anti",
    )


def graph_lines(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """The whole graph as JSON rows: ``kind`` (node or link) and ``value``."""
    nodes = export_nodes(vertices)
    links = export_links(nodes, edges)
    as_rows = lambda df, kind: df.select(F.lit(kind).alias("kind"), F.to_json(F.struct(*df.columns)).alias("value"))
    return as_rows(nodes, "node").unionByName(as_rows(links, "link"))


def graph_json(vertices: DataFrame, edges: DataFrame, max_nodes: int, max_links: int) -> DataFrame:
    """A preview of the graph as one JSON document, ``value STRING``.

    It holds the first nodes by id and the heaviest links between them, as many as the
    caller asks for, and says how many it leaves out.  The whole graph is
    :func:`graph_lines`; a graph of any size does not fit one document.
    """
    nodes = export_nodes(vertices)
    links = export_links(nodes, edges)
    shown = nodes.orderBy("id", "type").limit(max_nodes)
    inside = export_links(shown, edges).orderBy(F.desc("value"), "source", "target").limit(max_links)
    node_list = shown.agg(F.array_sort(F.collect_list(F.struct("id", "type", "label"))).alias("nodes"))
    link_list = inside.agg(
        F.transform(
            F.array_sort(
                F.collect_list(F.struct((-F.col("value")).alias("order"), "source", "target", "value"))
            ),
            lambda e: F.struct(e["source"].alias("source"), e["target"].alias("target"), e["value"].alias("value")),
        ).alias("links")
    )
    count = lambda df: df.agg(F.count("*")).scalar()
    return node_list.select("nodes", link_list.scalar().alias("links")).select(
        F.to_json(
            F.struct(
                "nodes", "links",
                (count(nodes) - F.size("nodes")).alias("nodes_left_out"),
                (count(links) - F.size("links")).alias("links_left_out"),
            )
        ).alias("value")
    )
