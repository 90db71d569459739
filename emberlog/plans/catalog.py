"""Registered queries: every operator over the whole events table.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame.  Times are
rendered as text with milliseconds and doubles are rounded to six places, so
that results compare exactly with the oracle.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlog.functions import columns as C
from emberlog.functions import fixed
from emberlog.functions.params import AnalysisOptions, Thresholds
from emberlog.operators import aggregates as A
from emberlog.operators import centers, graph, iforest, kmeans, readside, report, rules
from emberlog.operators import statistics as S
from emberlog.operators.parse import (
    complete_rows,
    extract_features,
    parse_lines,
    rejected_rows,
    render_lines,
    valid_lines,
)
from emberlog.plans import analyze, batch, graphs
from emberlog.sources import inventory, models, tables, textlogs
from emberlog.sources.event_lines import log_lines
from emberlog.sources.scratch import scratch_dir, staged
from emberlog.streaming import detect

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# Literal centres in the scaled space of the eight features, for exact checks.
FIXED_CENTERS = [
    [-0.6, -0.5, -0.5, 0.9, -0.6, -0.6, -0.25, -0.7],
    [0.0, 2.0, -0.5, -1.1, 1.2, 1.6, 0.0, 0.0],
    [0.0, -0.5, 2.0, -1.1, 1.2, 1.6, 0.0, 0.0],
    [1.2, -0.5, -0.5, 0.9, -0.6, -0.6, -0.25, 1.3],
    [3.5, 0.0, 0.0, 0.0, 0.0, 0.0, 5.0, 1.3],
]

# A literal forest over four of the features: (tree, node, feature, split, below, above, path), -1 for a leaf.
FOREST_FEATURES = ["response_time", "message_length", "level_error", "suspicious_ip"]
FIXED_FOREST = [
    (0, 0, 0, 700.0, 1, 2, 0.0), (0, 1, 2, 0.5, 3, 4, 0.0), (0, 2, 0, 1500.0, 5, 6, 0.0), (0, 3, -1, 0.0, 0, 0, 9.5),
    (0, 4, -1, 0.0, 0, 0, 5.0), (0, 5, 3, 0.5, 7, 8, 0.0), (0, 6, -1, 0.0, 0, 0, 2.5), (0, 7, -1, 0.0, 0, 0, 6.5), (0, 8, -1, 0.0, 0, 0, 3.0),
    (1, 0, 3, 0.5, 1, 2, 0.0), (1, 1, 1, 16.5, 3, 4, 0.0), (1, 2, 0, 400.0, 5, 6, 0.0), (1, 3, 0, 250.0, 7, 8, 0.0),
    (1, 4, 2, 0.5, 9, 10, 0.0), (1, 5, -1, 0.0, 0, 0, 4.0), (1, 6, -1, 0.0, 0, 0, 2.0), (1, 7, -1, 0.0, 0, 0, 10.0),
    (1, 8, -1, 0.0, 0, 0, 8.5), (1, 9, -1, 0.0, 0, 0, 7.0), (1, 10, -1, 0.0, 0, 0, 4.5),
    (2, 0, 1, 20.5, 1, 2, 0.0), (2, 1, -1, 0.0, 0, 0, 9.0), (2, 2, 0, 900.0, 3, 4, 0.0), (2, 3, -1, 0.0, 0, 0, 6.0), (2, 4, -1, 0.0, 0, 0, 1.5),
]

# Rotation of the text files that source and streaming queries write and read.
LINES_PER_FILE = 4000
LINES_PER_STREAM_FILE = 1_000_000
REPORT_ID = "events"
REPORT_TIME, REPORT_SECONDS = "2024-02-01 08:30:00", 12.5


def query(fn: Query) -> Query:
    """Register under the function's own name, with comparable output values."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        zone = spark.conf.get("spark.sql.session.timeZone")
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        try:
            return comparable(fn(spark, sf_dir))  # the plan keeps the zone it was analysed in
        finally:
            spark.conf.set("spark.sql.session.timeZone", zone)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


def comparable(df: DataFrame) -> DataFrame:
    def shown(f: T.StructField):
        if isinstance(f.dataType, T.TimestampType):
            return F.date_format(f.name, fixed.TIMESTAMP_FORMAT).alias(f.name)
        if isinstance(f.dataType, T.DoubleType):
            return F.round(f.name, 6).alias(f.name)
        return F.col(f.name)

    return df.select(*[shown(f) for f in df.schema.fields])


# ------------------------------------------------------------------ inputs


def parsed(spark: SparkSession, sf: str, *fields: str) -> DataFrame:
    """Parsed lines with the named fields (all if none are named)."""
    lines = log_lines(spark, sf)
    return parse_lines(lines, fields) if fields else parse_lines(lines)


def valid(spark: SparkSession, sf: str, *fields: str) -> DataFrame:
    return valid_lines(parsed(spark, sf, *fields, *(("level", "service") if fields else ())))


def features(spark: SparkSession, sf: str) -> DataFrame:
    return extract_features(valid(spark, sf))


def anomalies(spark: SparkSession, sf: str, *fields: str) -> DataFrame:
    """Rule anomalies with the named fields besides those the score reads (all if none)."""
    return rules.pattern_anomalies(parsed(spark, sf, *(fields and (*rules.SCORE_FIELDS, *fields))))


def records(spark: SparkSession, sf: str) -> DataFrame:
    return rules.anomaly_records(anomalies(spark, sf), analyze.RULES_TYPE)


def flat_alerts(alerts: DataFrame) -> DataFrame:
    """Alerts with the details unpacked and without the creation time."""
    return alerts.select("*", "details.*").drop("details", "created_at")


def fixed_model(spark: SparkSession, rows: DataFrame) -> centers.CenterModel:
    means, stds = centers.standardisation(rows, fixed.FEATURES_8)
    return centers.CenterModel(fixed.FEATURES_8, means, stds, FIXED_CENTERS)


def staged_numbers(spark: SparkSession, sf: str, names: list[str] = fixed.FEATURES_8) -> DataFrame:
    """Row keys and features of the valid lines, written once for the passes of a model."""
    return staged(features(spark, sf).select("file_id", "line_number", *names), "features")


def fixed_assignment(spark: SparkSession, sf: str) -> DataFrame:
    """Row keys and features assigned to the literal centres."""
    rows = staged_numbers(spark, sf)
    return fixed_model(spark, complete_rows(rows)).assign(rows)


def fixed_forest() -> iforest.IsolationForest:
    nodes = pd.DataFrame(FIXED_FOREST, columns=["tree", "node", "feature", "split", "below", "above", "path"])
    return iforest.IsolationForest(FOREST_FEATURES, fixed.ISOLATION_SAMPLE, nodes)


def fixed_analysis(spark: SparkSession, sf: str) -> analyze.Analysis:
    """The ML analysis with the literal centres, their distances by cluster size, and the literal forest."""
    rows = complete_rows(staged_numbers(spark, sf))
    model = fixed_model(spark, rows).sized(rows)
    return analyze.analyze_with(log_lines(spark, sf), model, fixed_forest())


def stream_model(spark: SparkSession, sf: str) -> centers.CenterModel:
    """The literal centres, with the standardisation taken in one pass over the lines."""
    fields = ("level", "message", "service", "ip_address", "response_time")
    names = [n for n in fixed.FEATURES_8 if n != "response_time"]
    return fixed_model(spark, complete_rows(extract_features(valid(spark, sf, *fields), names)))


def figured_assignment(spark: SparkSession, sf: str) -> tuple[DataFrame, centers.CenterModel]:
    """Valid lines with all fields assigned to the literal centres, and the figures of the model."""
    rows = staged(features(spark, sf), "features")
    complete = complete_rows(rows)
    model = fixed_model(spark, complete).with_figures(complete)
    return model.assign(rows), model


def results(spark: SparkSession, sf: str, *names: str) -> list[DataFrame]:
    """Result tables of the rule analysis, written to a fresh folder and read back."""
    root = scratch_dir(spark, "results")
    analyze.analyze_rules(log_lines(spark, sf), stage=len(names) > 1).write(root, names)
    return [tables.read_table(spark, root, name) for name in names]


def log_directory(spark: SparkSession, sf: str, corrupt_apart: bool = False) -> str:
    """The lines as rotated text files, one folder per file, in line order.

    ``corrupt_apart``: corrupt records go to files of their own, in which no line is valid.
    """
    path = scratch_dir(spark, "logs")
    number = F.floor((F.col("line_number") - 1) / LINES_PER_FILE)
    (
        log_lines(spark, sf)
        .withColumn("file", F.concat(_rotated_prefix(corrupt_apart), F.lpad(number.cast("string"), 9, "0")))
        .repartition("file")
        .sortWithinPartitions("file", "line_number")
        .select("file", "value")
        .write.partitionBy("file")
        .text(path)
    )
    return path


def _rotated_prefix(corrupt_apart: bool):
    return F.when(F.lit(corrupt_apart) & F.col("value").startswith("corrupt record"), "corrupt-").otherwise("server-")


def rotated_name():
    """Name of the rotated file a scanned line comes from."""
    return F.regexp_extract("file_path", "file=([^/]+)/", 1).alias("file")


# ------------------------------------------------------- parse and features


@query
def parse_lines_query(spark, sf):
    return parsed(spark, sf)


@query
def valid_lines_query(spark, sf):
    return valid(spark, sf)


@query
def features_query(spark, sf):
    return extract_features(parsed(spark, sf)).select(
        "file_id", "line_number", *fixed.FEATURES_11
    )


@query
def rejected_lines(spark, sf):
    rows = extract_features(valid(spark, sf))
    return rejected_rows(rows).select("file_id", "line_number", "level", "service")


@query
def render_lines_query(spark, sf):
    return render_lines(valid(spark, sf)).select("file_id", "line_number", "value")


# -------------------------------------------------- rules, alerts, entities


@query
def pattern_score(spark, sf):
    scored = rules.with_pattern_score(parsed(spark, sf, *rules.SCORE_FIELDS))
    return scored.select("file_id", "line_number", "anomaly_score")


@query
def pattern_anomalies(spark, sf):
    return anomalies(spark, sf)


@query
def severity(spark, sf):
    scored = rules.with_pattern_score(parsed(spark, sf, *rules.SCORE_FIELDS))
    return rules.with_severity(scored).select("file_id", "line_number", "severity", "priority")


@query
def alerts(spark, sf):
    return flat_alerts(rules.alerts(records(spark, sf)))


@query
def error_patterns(spark, sf):
    return A.error_patterns(anomalies(spark, sf, "message"))


@query
def distinct_entities(spark, sf):
    return A.distinct_entities(anomalies(spark, sf, "service", "ip_address"))


@query
def first_last(spark, sf):
    return A.first_last(anomalies(spark, sf, "timestamp"))


@query
def entities_by_file(spark, sf):
    """Services and addresses of the anomalies by file and day, from the stored table."""
    return results(spark, sf, tables.ENTITIES)[0].withColumn("day", F.col("day").cast("string"))


@query
def error_patterns_by_file(spark, sf):
    return results(spark, sf, tables.PATTERNS)[0].withColumn("day", F.col("day").cast("string"))


@query
def entity_totals(spark, sf):
    """Entities of the whole log, as sums of the stored table."""
    return A.summed(results(spark, sf, tables.ENTITIES)[0], "kind", "entity")


@query
def stored_list_sizes(spark, sf):
    """Per file the sizes of the stored lists, beside those its statistics record says."""
    statistics, entities, patterns = results(spark, sf, tables.STATISTICS, tables.ENTITIES, tables.PATTERNS)
    sizes = A.list_sizes(entities, patterns)
    names = ("services_count", "suspicious_ips_count", "error_patterns_count")
    said = statistics.select("file_id", *[F.col(c).alias(f"recorded_{c}") for c in names])
    return said.join(sizes, "file_id", "left")


# ------------------------------------------------------ windows, timelines


def _windows(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "*"
    ).drop("window")


def _window_input(spark, sf):
    return extract_features(valid(spark, sf, *A.WINDOW_FIELDS), A.WINDOW_FEATURES)


@query
def tumbling_service(spark, sf):
    return _windows(A.windowed_metrics(_window_input(spark, sf)))


@query
def sliding_service(spark, sf):
    return _windows(A.windowed_metrics(_window_input(spark, sf), detect.WINDOW, detect.SLIDE))


@query
def timeline_minute(spark, sf):
    return A.timeline_minute(anomalies(spark, sf, "timestamp"))


@query
def timeline_hour(spark, sf):
    """The flagship: parse, validate, score, select and bucket in one pass."""
    return A.timeline_hour(
        rules.pattern_anomalies(valid(spark, sf, "timestamp", *rules.SCORE_FIELDS))
    )


# --------------------------------------------------- statistics over lines


@query
def service_trend(spark, sf):
    return analyze.historical_report(log_lines(spark, sf))


@query
def service_counts(spark, sf):
    return A.counts_by(valid(spark, sf, "service"), "service")


@query
def log_totals(spark, sf):
    return A.log_totals(valid(spark, sf, "response_time"))


@query
def top_ips(spark, sf):
    return A.top_counts(valid(spark, sf, "ip_address"), "ip_address")


@query
def time_range(spark, sf):
    return A.time_range(valid(spark, sf, "timestamp"))


@query
def describe(spark, sf):
    return A.column_summary(
        features(spark, sf), fixed.FEATURES_11, ["level", "service", "message", "ip_address", "user"]
    )


@query
def severity_counts(spark, sf):
    return A.severity_totals(anomalies(spark, sf, "level"))


@query
def alert_counts(spark, sf):
    return A.alert_totals(rules.alerts(records(spark, sf)))


@query
def service_dist(spark, sf):
    return A.counts_by(anomalies(spark, sf, "service"), "service", "anomaly_count")


@query
def severity_dist(spark, sf):
    return A.severity_distribution(anomalies(spark, sf, "level"))


@query
def top_anomalous_ips(spark, sf):
    return A.top_counts(anomalies(spark, sf, "ip_address"), "ip_address", name="anomaly_count")


def _rule_statistics(spark, sf, by):
    fields = (*rules.SCORE_FIELDS, "timestamp", "service", "ip_address")
    scored = rules.with_pattern_score(parsed(spark, sf, *fields))
    return S.analysis_statistics(scored, F.col("anomaly_score") >= Thresholds.analysis_anomaly, by)


@query
def summary_rates(spark, sf):
    return S.summary_rates(_rule_statistics(spark, sf, ["file_id"]))


@query
def analysis_statistics(spark, sf):
    return _rule_statistics(spark, sf, None)


@query
def file_totals(spark, sf):
    per_file = _rule_statistics(spark, sf, ["file_id"]).withColumn("success", F.col("total_logs") > 0)
    return S.file_totals(per_file)


# ------------------------------------------------------------------- graph


def _graph_input(spark, sf):
    return valid(spark, sf, *graph.GRAPH_FIELDS)


def _built_graph(spark, sf):
    return graphs.build_graph(_graph_input(spark, sf))


def _scored_nodes(spark, sf):
    _, edges = _built_graph(spark, sf)
    return graphs.graph_anomalies(edges)[0], edges


@query
def graph_vertices(spark, sf):
    return graph.graph_vertices(_graph_input(spark, sf))


@query
def graph_edges(spark, sf):
    return graph.graph_edges(_graph_input(spark, sf))


@query
def vertex_counts(spark, sf):
    return A.counts_by(graph.graph_vertices(_graph_input(spark, sf)), "type", "vertex_count")


@query
def graph_size(spark, sf):
    """Total vertices and edges."""
    vertices, edges = _built_graph(spark, sf)
    return edges.agg(F.count("*").alias("edge_count")).withColumn(
        "vertex_count", vertices.agg(F.count("*").alias("n")).scalar()
    )


@query
def out_degree(spark, sf):
    return graph.out_degree(graph.graph_edges(_graph_input(spark, sf)))


@query
def in_degree(spark, sf):
    return graph.in_degree(graph.graph_edges(_graph_input(spark, sf)))


@query
def node_stats(spark, sf):
    return graph.node_statistics(*_built_graph(spark, sf))


@query
def node_scores(spark, sf):
    return _scored_nodes(spark, sf)[0]


@query
def suspicious_nodes(spark, sf):
    return graph.suspicious_nodes(_scored_nodes(spark, sf)[0])


@query
def edge_scores(spark, sf):
    return graph.edge_scores(graph.graph_edges(_graph_input(spark, sf)))


@query
def suspicious_ips(spark, sf):
    return graph.suspicious_ips(_scored_nodes(spark, sf)[0])


@query
def suspicious_connections(spark, sf):
    nodes, edges = _scored_nodes(spark, sf)
    return graph.suspicious_connections(edges, graph.suspicious_ips(nodes))


@query
def targeted_services(spark, sf):
    return graphs.anomalous_patterns(*_scored_nodes(spark, sf))[1]


@query
def top_edges(spark, sf):
    return graph.top_edges(graph.graph_edges(_graph_input(spark, sf)))


def _whole_graph(spark, sf):
    """Graph of all lines, corrupt ones included: they give edges without usable ends."""
    vertices, edges = graphs.build_graph(parsed(spark, sf, *graph.GRAPH_FIELDS))
    return vertices, edges.drop("src_type")


@query
def graph_links(spark, sf):
    vertices, edges = _whole_graph(spark, sf)
    return graph.export_links(graph.export_nodes(vertices), edges)


@query
def skipped_links(spark, sf):
    vertices, edges = _whole_graph(spark, sf)
    return graph.skipped_links(graph.export_nodes(vertices), edges)


@query
def graph_json(spark, sf):
    """The exported graph, written and read back."""
    path = scratch_dir(spark, "graph")
    graphs.export_graph(*_whole_graph(spark, sf), path)
    lines = spark.read.schema("value string, kind string").text(path)
    schema = "id string, type string, source string, target string, value bigint"
    rows = lines.select("kind", F.from_json("value", schema).alias("g"))
    return rows.select(
        "kind", F.coalesce("g.id", "g.source").alias("a"), F.coalesce("g.type", "g.target").alias("b"),
        F.col("g.value").alias("weight"),
    )


@query
def graph_preview(spark, sf):
    """First nodes and heaviest links between them, unfolded into rows."""
    schema = "nodes array<struct<id string, type string, label string>>, links array<struct<source string, target string, value bigint>>"
    doc = graph.graph_json(*_whole_graph(spark, sf), max_nodes=150, max_links=300).select(F.from_json("value", schema).alias("g"))
    nodes = doc.select(F.posexplode("g.nodes").alias("place", "n")).select(
        F.lit("node").alias("kind"), "place", F.col("n.id").alias("a"), F.col("n.type").alias("b"),
        F.lit(None).cast("bigint").alias("weight"),
    )
    links = doc.select(F.posexplode("g.links").alias("place", "n")).select(
        F.lit("link").alias("kind"), "place", F.col("n.source").alias("a"),
        F.col("n.target").alias("b"), F.col("n.value").alias("weight"),
    )
    return nodes.unionByName(links)


# --------------------------------------------------------------- read side


@query
def anomaly_page(spark, sf):
    found = results(spark, sf, tables.ANOMALIES)[0]
    return readside.anomaly_page(found, number=2)


@query
def min_score_page(spark, sf):
    found = results(spark, sf, tables.ANOMALIES)[0]
    return readside.anomaly_page(found, min_score=0.6, service="auth-service")


@query
def alert_page(spark, sf):
    found = results(spark, sf, tables.ALERTS)[0]
    return flat_alerts(readside.alert_page(found, number=2))


@query
def critical_alert_page(spark, sf):
    found = results(spark, sf, tables.ALERTS)[0]
    return flat_alerts(readside.alert_page(found, severity="critical"))


@query
def annotated_lines(spark, sf):
    found = results(spark, sf, tables.ANOMALIES)[0]
    return readside.annotated_lines(log_lines(spark, sf), found)


@query
def log_view(spark, sf):
    found = results(spark, sf, tables.ANOMALIES)[0]
    return readside.log_view(log_lines(spark, sf), found, number=3)


@query
def anomalous_log_view(spark, sf):
    found = results(spark, sf, tables.ANOMALIES)[0]
    return readside.log_view(log_lines(spark, sf), found, anomalies_only=True)


@query
def recent_anomalies(spark, sf):
    return readside.recent_anomalies(records(spark, sf))


@query
def recent_timeline(spark, sf):
    """Minutes of the last hundred anomalies."""
    return A.timeline_minute(readside.recent_anomalies(records(spark, sf)))


@query
def recent_service_dist(spark, sf):
    """Services of the last hundred anomalies."""
    return A.counts_by(readside.recent_anomalies(records(spark, sf)), "service", "anomaly_count")


@query
def live_counters(spark, sf):
    return S.live_counters(rules.with_pattern_score(valid(spark, sf, *rules.SCORE_FIELDS)))


@query
def analysis_list(spark, sf):
    (statistics,) = results(spark, sf, tables.STATISTICS)
    return readside.analysis_list(statistics).drop("analysis_completed", "processing_time")


@query
def analysis_result(spark, sf):
    """Record and counts of the first analysed file."""
    statistics, found, alerts_ = results(
        spark, sf, tables.STATISTICS, tables.ANOMALIES, tables.ALERTS
    )
    first = statistics.agg(F.min("file_id")).first()[0]
    return readside.analysis_result(statistics, found, alerts_, first).select(
        "file_id", "total_logs", "anomalies_found", "anomalies_count", "alerts_count", "status"
    )


def _report(spark, sf):
    statistics, found, alerts_ = results(
        spark, sf, tables.STATISTICS, tables.ANOMALIES, tables.ALERTS
    )
    method = analyze.METHOD_LABELS[analyze.RULES_TYPE]
    # the two values of the record that differ from run to run
    statistics = statistics.withColumns({"analysis_completed": F.lit(REPORT_TIME).cast("timestamp"), "processing_time": F.lit(REPORT_SECONDS)})
    return report.report_lines(REPORT_ID, statistics, found, alerts_, method)


@query
def report_lines(spark, sf):
    return _report(spark, sf)


@query
def report_text(spark, sf):
    """The written report, read back: its lines with their number of occurrences."""
    path = scratch_dir(spark, "report")
    tables.write_lines(report.ordered_report(_report(spark, sf)), path)
    return textlogs.scan_lines(spark, path).groupBy("value").agg(F.count("*").alias("n"))


# --------------------------------------------------------- models, scoring


@query
def scaled_features(spark, sf):
    rows = complete_rows(staged_numbers(spark, sf))
    model = fixed_model(spark, rows)
    return rows.select(
        "file_id",
        "line_number",
        *[c.alias(f"z_{n}") for n, c in zip(fixed.FEATURES_8, model.scaled())],
    )


_ASSIGNED = ["file_id", "line_number", "cluster", "distance_to_center"]


@query
def distance_fixed_centers(spark, sf):
    return fixed_assignment(spark, sf).select(*_ASSIGNED)


@query
def distance_stats_fixed_centers(spark, sf):
    return centers.distance_stats(fixed_assignment(spark, sf))


@query
def zscore_fixed_centers(spark, sf):
    assigned, model = figured_assignment(spark, sf)
    return centers.zscore_scores(assigned.filter(F.col("cluster").isNotNull()), model).select(
        "file_id", "line_number", "anomaly_score", "is_anomaly"
    )


@query
def linear_score(spark, sf):
    return centers.linear_scores(fixed_assignment(spark, sf)).select(
        "file_id", "line_number", "anomaly_score"
    )


@query
def enhanced_score(spark, sf):
    assigned, model = figured_assignment(spark, sf)
    return centers.enhanced_scores(assigned, model.rare_cluster()).select(
        "file_id", "line_number", "anomaly_score"
    )


@query
def enhanced_score_by_id(spark, sf):
    """Enhanced score with the cluster-id rule instead of the share rule."""
    rows = features(spark, sf)
    assigned = stream_model(spark, sf).assign(rows)
    return centers.enhanced_scores(assigned, centers.rare_cluster_by_id()).select(
        "file_id", "line_number", "anomaly_score"
    )


@query
def trained_statistics(spark, sf):
    assigned, model = figured_assignment(spark, sf)
    record = S.trained_statistics(centers.enhanced_scores(assigned, model.rare_cluster()))
    return record.withColumn("top_ips", F.concat_ws(",", "top_ips"))


@query
def trained_statistics_by_file(spark, sf):
    """Summaries the trained analysis writes per file, read back."""
    _, model = figured_assignment(spark, sf)
    root = scratch_dir(spark, "results")
    analyze.analyze_trained(log_lines(spark, sf), model, stage=True).write(root, (tables.SUMMARIES,))
    record = tables.read_table(spark, root, tables.SUMMARIES)
    return record.withColumn("top_ips", F.concat_ws(",", "top_ips"))


@query
def kmeans_clusters(spark, sf):
    rows = staged_numbers(spark, sf)
    _, model = kmeans.fit_kmeans(rows)
    return model.assign(rows).select(*_ASSIGNED)


@query
def pipeline_agreement(spark, sf):
    """Rows whose cluster by column expressions differs from the fitted pipeline's."""
    rows = complete_rows(staged_numbers(spark, sf))
    pipeline, model = kmeans.fit_kmeans(rows)
    theirs = pipeline.transform(rows).withColumnRenamed("cluster", "pipeline_cluster")
    differs = F.col("cluster") != F.col("pipeline_cluster")
    return model.assign(theirs).agg(F.count("*").alias("scored_rows"), F.count_if(differs).alias("differing_rows"))


@query
def isolation_score(spark, sf):
    rows = staged_numbers(spark, sf, fixed.FEATURES_11)
    forest = iforest.fit_isolation_forest(rows, fixed.FEATURES_11, ["file_id", "line_number"])
    scored = staged(forest.score(rows).select("file_id", "line_number", "isolation_score"), "isolation")
    return iforest.contamination_flag(scored)


@query
def ensemble(spark, sf):
    return analyze.analyze_ml(log_lines(spark, sf)).scored.select(
        "file_id", "line_number", "anomaly_score", "isolation_score", "final_anomaly_score",
        "is_anomaly", "is_anomaly_final",
    )


@query
def ml_line_counts(spark, sf):
    """Every valid line is either scored or rejected; all scores lie in [0, 1]."""
    done = analyze.analyze_ml(log_lines(spark, sf))
    inside = [F.col(c).between(0, 1) for c in ("anomaly_score", "isolation_score", "final_anomaly_score")]
    return done.scored.agg(
        F.count("*").alias("scored_lines"),
        F.count_if(inside[0] & inside[1] & inside[2]).alias("scores_in_range"),
    ).withColumn("rejected_lines", done.rejects.agg(F.count("*").alias("n")).scalar())


@query
def ensemble_counts(spark, sf):
    """Rows by combined decision."""
    return A.counts_by(analyze.analyze_ml(log_lines(spark, sf)).scored, "is_anomaly_final")


@query
def isolation_fixed_forest(spark, sf):
    rows = staged_numbers(spark, sf)
    return fixed_forest().score(rows).select("file_id", "line_number", "isolation_score")


_COMBINED = ["file_id", "line_number", "anomaly_score", "isolation_score", "final_anomaly_score", "is_anomaly", "is_anomaly_final"]


@query
def ensemble_fixed(spark, sf):
    """Both scores and the decision of every complete line, with literal centres and trees."""
    return fixed_analysis(spark, sf).scored.select(*_COMBINED)


@query
def ensemble_fixed_counts(spark, sf):
    return A.counts_by(fixed_analysis(spark, sf).scored, "is_anomaly_final")


@query
def analyze_ml_fixed(spark, sf):
    """Anomalies of the ML analysis, with literal centres and trees."""
    return fixed_analysis(spark, sf).anomalies


@query
def kmeans_invariants(spark, sf):
    """Of the fitted clusters: scored rows, rows nearer to another centre than to their own, cluster shares that do not add up."""
    rows = complete_rows(staged_numbers(spark, sf))
    pipeline, model = kmeans.fit_kmeans(rows)
    vectors = pipeline.transform(rows)
    z = vector_to_array("features")
    own = F.col("cluster")
    squares = [F.aggregate(F.zip_with(z, F.lit(list(c)), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, b: a + b) for c in model.centers]
    nearest = F.least(*squares)
    mine = F.element_at(F.array(*squares), own + 1)
    shares = sum(model.cluster_shares)
    return vectors.agg(
        F.count("*").alias("scored_rows"), F.count_if(mine > nearest + 1e-9).alias("nearer_elsewhere"),
        F.lit(int(abs(shares - 1) > 1e-9)).cast("bigint").alias("shares_off"), F.lit(len(model.centers)).cast("bigint").alias("centers"),
    )


@query
def contamination_sketch(spark, sf):
    """Rows of the literal forest by file, sketched per file and merged: lines, and whether the marked share is within the bound."""
    scored = staged(fixed_forest().score(complete_rows(staged_numbers(spark, sf))).select("file_id", "isolation_score"), "isolation")
    cut = iforest.contamination_cut(iforest.merged_sketch(iforest.score_sketch(scored, by=["file_id"])))
    marked = iforest.marked_from(scored, cut)
    above = F.count_if(F.col("isolation_score") > cut) / F.count("*")
    from_cut = F.count_if(F.col("is_outlier") == 1) / F.count("*")
    share = Thresholds.contamination
    return marked.agg(
        F.count("*").alias("lines"), (from_cut >= share - 0.005).alias("at_least_the_share"), (above <= share + 0.005).alias("no_more_above"),
    )


@query
def model_roundtrip(spark, sf):
    """Rows that a saved and loaded model scores differently from the trained one."""
    rows = staged_numbers(spark, sf)
    pipeline, model = kmeans.fit_kmeans(rows)
    path = scratch_dir(spark, "model")
    models.save_model(spark, path, pipeline, model)
    _, loaded = models.load_model(spark, path)
    before = centers.zscore_scores(model.assign(rows), model)
    key = ["file_id", "line_number"]
    both = before.select(*key, "cluster", "anomaly_score", *fixed.FEATURES_8)
    again = centers.zscore_scores(
        loaded.assign(both.withColumnsRenamed({"cluster": "c0", "anomaly_score": "s0"})), loaded
    )
    same = F.col("cluster").eqNullSafe(F.col("c0")) & F.col("anomaly_score").eqNullSafe(F.col("s0"))
    return again.agg(F.count_if(~same).alias("differing_rows"))


# ----------------------------------------------------------- whole analyses


@query
def analyze_rules(spark, sf):
    return analyze.analyze(log_lines(spark, sf), AnalysisOptions(use_ml=False)).anomalies


@query
def analyze_ml(spark, sf):
    return analyze.analyze(log_lines(spark, sf)).anomalies


@query
def analyze_trained(spark, sf):
    rows = staged_numbers(spark, sf)
    _, model = kmeans.fit_kmeans(rows)
    return analyze.analyze_trained(log_lines(spark, sf), model).anomalies


@query
def analyze_trained_fixed_centers(spark, sf):
    """Trained-model analysis with the literal centres, so that SQL can check it."""
    _, model = figured_assignment(spark, sf)
    return analyze.analyze_trained(log_lines(spark, sf), model).anomalies


@query
def result_tables(spark, sf):
    """Anomalies written per file and read back."""
    return results(spark, sf, tables.ANOMALIES)[0]


# -------------------------------------------------------------- text sources


@query
def text_scan(spark, sf):
    return textlogs.scan_lines(spark, log_directory(spark, sf)).select("value")


@query
def multi_file(spark, sf):
    """Valid lines and errors per file of a directory, from one scan."""
    lines = textlogs.scan_log_files(spark, log_directory(spark, sf), nested=True)
    rows = valid_lines(parse_lines(lines, ("level", "service")))
    return rows.groupBy(rotated_name()).agg(
        F.count("*").alias("valid_lines"), F.count_if(F.col("level") == "ERROR").alias("error_lines")
    )


@query
def line_counts(spark, sf):
    lines = textlogs.scan_log_files(spark, log_directory(spark, sf), nested=True).withColumn("file_id", rotated_name())
    return textlogs.line_counts(lines)


@query
def line_numbers(spark, sf):
    lines = textlogs.numbered_lines(spark, log_directory(spark, sf), nested=True)
    return lines.select(rotated_name(), "line_number", "value")


@query
def file_ids(spark, sf):
    return textlogs.scan_log_files(spark, log_directory(spark, sf), nested=True).select("file_id").distinct()


@query
def file_inventory(spark, sf):
    return inventory.file_inventory(spark, log_directory(spark, sf))


@query
def batch_directory(spark, sf):
    """Every file of a directory analysed in one job: totals over the per-file results."""
    _, model = figured_assignment(spark, sf)
    _, per_file = batch.analyze_directory(spark, log_directory(spark, sf, corrupt_apart=True), model, nested=True)
    return batch.batch_summary(per_file)


@query
def file_identity(spark, sf):
    """Per file: whether its identity has the form name, time, path hash, and its lines."""
    lines = textlogs.scan_log_files(spark, log_directory(spark, sf), nested=True)
    form = F.col("file_id").rlike("^part-[^/]+[.]txt_[0-9]{9,}_[0-9A-F]+$")
    return lines.groupBy(rotated_name()).agg(F.count_distinct("file_id").alias("identities"), F.bool_and(form).alias("well_formed"), F.count("*").alias("line_count"))


@query
def file_sizes(spark, sf):
    """Files of the inventory by folder, with their length; newest first by time, so that no file follows a newer one."""
    rows = inventory.file_inventory(spark, log_directory(spark, sf))
    return rows.select(F.regexp_extract("path", "file=([^/]+)/", 1).alias("file"), "length")


# ------------------------------------------------------------------ streams


def _time_ordered_files(spark, sf) -> str:
    """The lines as text files of a bounded size that follow each other in time."""
    path = scratch_dir(spark, "stream-input")
    lines = log_lines(spark, sf)
    files = max(5, math.ceil(lines.count() / LINES_PER_STREAM_FILE))
    dated = parse_lines(lines, ("timestamp",), keep_value=True)
    dated.repartitionByRange(files, "timestamp", "line_number").select("value").write.text(path)
    return path


@query
def stream_detect(spark, sf):
    """Anomalies found by the streaming job over all lines, read from its sink."""
    model = stream_model(spark, sf)
    sink, checkpoint = scratch_dir(spark, "sink"), scratch_dir(spark, "checkpoint")
    lines = textlogs.stream_lines(spark, _time_ordered_files(spark, sf))
    detect.start_detection(lines, model, sink, checkpoint, interval=None, graph_every=0).awaitTermination()
    return detect.read_sink(spark, sink, detect.ANOMALIES).drop("batch_id")


@query
def stream_statistics(spark, sf):
    """Running totals of the streaming job."""
    model = stream_model(spark, sf)
    sink, checkpoint = scratch_dir(spark, "sink"), scratch_dir(spark, "checkpoint")
    lines = textlogs.stream_lines(spark, _time_ordered_files(spark, sf), max_files=2)
    detect.start_detection(lines, model, sink, checkpoint, interval=None, graph_every=0).awaitTermination()
    return detect.live_statistics(spark, sink)


@query
def stream_graph(spark, sf):
    """Weights of the graph that the streaming job refreshed last."""
    model = stream_model(spark, sf)
    sink, checkpoint = scratch_dir(spark, "sink"), scratch_dir(spark, "checkpoint")
    lines = textlogs.stream_lines(spark, _time_ordered_files(spark, sf), max_files=1)
    detect.start_detection(lines, model, sink, checkpoint, interval=None, graph_every=1).awaitTermination()
    links = detect.latest_graph(spark, sink).filter("kind = 'link'")
    return links.select(F.from_json("value", "source string, target string, value bigint").alias("l")).select("l.*")


def _streamed_windows(spark, sf, *frame: str) -> DataFrame:
    out, checkpoint = scratch_dir(spark, "windows"), scratch_dir(spark, "checkpoint")
    lines = textlogs.stream_lines(spark, _time_ordered_files(spark, sf))
    (
        detect.stream_windows(lines, *frame)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return _windows(detect.all_windows(spark, out, checkpoint))


@query
def stream_windows(spark, sf):
    """All windows of a streaming run over all lines: those closed by the watermark and those open at its end."""
    return _streamed_windows(spark, sf, "1 minute")


@query
def stream_sliding(spark, sf):
    """Sliding windows of a streaming run, closed and open."""
    return _streamed_windows(spark, sf, detect.WINDOW, detect.SLIDE)


@query
def running_counters(spark, sf):
    """Stateful running totals after a streaming run; the result table is one row."""
    model = stream_model(spark, sf)
    scored = detect.live_scores(textlogs.stream_lines(spark, _time_ordered_files(spark, sf), max_files=2), model)
    name = f"running_{uuid.uuid4().hex}"
    (
        detect.running_counters(scored)
        .writeStream.outputMode("complete")
        .format("memory")
        .queryName(name)
        .option("checkpointLocation", scratch_dir(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.table(name)


# Operators that share their name with a query helper are registered under it.
for _name in ("parse_lines", "valid_lines", "features", "render_lines"):
    QUERIES[_name] = QUERIES.pop(f"{_name}_query")
