"""Live detection with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from emberlog.functions.params import Thresholds
from emberlog.operators import centers, graph
from emberlog.operators.aggregates import WINDOW_FEATURES, WINDOW_FIELDS, windowed_metrics
from emberlog.operators.parse import extract_features, parse_lines, valid_lines
from emberlog.operators.readside import recent_anomalies
from emberlog.operators.statistics import live_counters
from emberlog.plans.graphs import export_graph
from emberlog.streaming import manifest

ANOMALIES, COUNTERS, GRAPHS = "anomalies", "counters", "graphs"
EDGES, SNAPSHOTS = "edges", "edge_snapshots"
TABLES = (ANOMALIES, COUNTERS, GRAPHS, EDGES, SNAPSHOTS)
BATCH_INTERVAL = "5 seconds"
WATERMARK = "10 minutes"
WINDOW, SLIDE = "30 seconds", "10 seconds"
GRAPH_EVERY = 6

RECORD = [
    "timestamp", "level", "service", "message", "ip_address", "user", "response_time", "anomaly_score",
]


def live_scores(lines: DataFrame, model: centers.CenterModel | None) -> DataFrame:
    """Valid lines with their linear distance score; the fitted model is never refitted.

    Without a model every line gets the neutral score.
    """
    features = extract_features(valid_lines(parse_lines(lines)))
    if model is None:
        unknown = {"cluster": F.lit(None).cast("int"), "distance_to_center": F.lit(None).cast("double")}
        return centers.linear_scores(features.withColumns(unknown))
    return centers.linear_scores(model.assign(features))


def start_detection(
    lines: DataFrame,
    model: centers.CenterModel | None,
    sink: str,
    checkpoint: str,
    thresholds: Thresholds = Thresholds(),
    interval: str | None = BATCH_INTERVAL,
    graph_every: int = GRAPH_EVERY,
    compact: int = manifest.COMPACT,
    keep: int = manifest.KEEP,
) -> StreamingQuery:
    """Score new lines and append anomalies, counters and graph edges to the sink.

    Each micro-batch writes folders of its own and then a manifest that names what counts
    (:mod:`emberlog.streaming.manifest`). A batch that is replayed starts from the manifest of the batch
    before, so a restart neither loses nor doubles rows, and readers never meet a folder half written.
    ``interval=None`` processes what is there and stops.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        parts = list(manifest.newest(spark, sink, before_batch=batch_id).parts)
        batch = batch.persist()
        try:
            hits = batch.filter(F.col("anomaly_score") > thresholds.live_anomaly).select(*RECORD)
            parts.append(manifest.write_part(hits, sink, ANOMALIES, batch_id))
            counters = live_counters(batch, thresholds).drop("anomaly_rate")
            parts.append(manifest.write_part(counters, sink, COUNTERS, batch_id))
            if graph_every:
                parts.append(manifest.write_part(graph.edge_measures(batch), sink, EDGES, batch_id))
        finally:
            batch.unpersist()
        if graph_every and (batch_id + 1) % graph_every == 0:
            parts = refreshed_graph(spark, sink, batch_id, parts)
        parts = manifest.compacted(spark, sink, parts, (ANOMALIES, COUNTERS, EDGES), compact)
        manifest.commit(spark, sink, batch_id, parts)
        manifest.sweep(spark, sink, TABLES, keep)

    writer = (
        live_scores(lines, model)
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .queryName("log-anomaly-detection")
    )
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def read_sink(spark: SparkSession, sink: str, table: str) -> DataFrame:
    """Rows of a sink table with their ``batch_id``, as the newest manifest lists them."""
    found = manifest.read(spark, sink, table)
    if found is None:
        raise FileNotFoundError(f"no batch has been written to {sink}/{table}")
    return found


def refreshed_graph(spark: SparkSession, sink: str, batch_id: int, parts: list[manifest.Part]) -> list[manifest.Part]:
    """Rebuild the graph document from the edge measures of all batches so far.

    The batches hold sums per edge, so the log lines are not read again, and a
    refresh starts from the sums of the one before. The new sums take the place of the old ones
    and of the measures they hold.
    """
    own = [p for p in parts if p.table in (EDGES, SNAPSHOTS)]
    measures = spark.read.parquet(*[p.path for p in own]).drop("batch_id")
    snapshot = manifest.write_part(graph.merge_measures(measures), sink, SNAPSHOTS, batch_id)
    edges = graph.typed_edges(spark.read.parquet(snapshot.path).drop("batch_id"))
    path = manifest.new_folder(sink, GRAPHS, batch_id)
    export_graph(graph.vertices_of(edges), edges, path)
    rest = [p for p in parts if p.table not in (EDGES, SNAPSHOTS, GRAPHS)]
    return [*rest, snapshot, manifest.Part(GRAPHS, path, batch_id, batch_id)]


def latest_graph(spark: SparkSession, sink: str) -> DataFrame:
    """``kind`` and ``value`` rows of the newest graph; no rows when there is none yet."""
    found = manifest.newest(spark, sink).of(GRAPHS)
    if not found:
        return spark.createDataFrame([], "kind string, value string")
    return spark.read.schema("value string, kind string").text(found[-1].path).select("kind", "value")


def live_statistics(spark: SparkSession, sink: str) -> DataFrame:
    """Running totals over all batches: each line was counted once."""
    counters = read_sink(spark, sink, COUNTERS)
    anomalies = read_sink(spark, sink, ANOMALIES)
    return (
        counters.agg(
            *[
                F.coalesce(F.sum(c), F.lit(0)).alias(c)
                for c in ("total_logs", "total_anomalies", "critical_alerts")
            ]
        )
        .withColumns(
            {
                "anomaly_rate": F.coalesce(F.try_divide("total_anomalies", "total_logs"), F.lit(0.0)),
                "services_affected": anomalies.agg(F.count_distinct("service")).scalar(),
                "suspicious_ips": anomalies.agg(F.count_distinct("ip_address")).scalar(),
            }
        )
    )


def last_anomalies(spark: SparkSession, sink: str, n: int = 100) -> DataFrame:
    """The last anomalies, a batch query over the sink table."""
    anomalies = read_sink(spark, sink, ANOMALIES)
    return recent_anomalies(
        anomalies.withColumns({"file_id": F.col("batch_id").cast("string"), "line_number": F.lit(0)}), n
    ).drop("file_id", "line_number")


def stream_windows(
    lines: DataFrame, duration: str = "1 minute", slide: str | None = None, watermark: str = WATERMARK
) -> DataFrame:
    """Windowed metrics on a stream; rows later than the watermark are dropped."""
    features = extract_features(valid_lines(parse_lines(lines, WINDOW_FIELDS)), WINDOW_FEATURES)
    return windowed_metrics(features.withWatermark("timestamp", watermark), duration, slide)


#: State of the window aggregate, in the order of ``windowed_metrics``: the buffers of its aggregate functions.
_WINDOW_STATE = (
    "struct<log_count:bigint,time_sum:double,time_count:bigint,spread_n:double,spread_mean:double,spread_m2:double,"
    "error_count:bigint,warn_count:bigint,suspicious_ip_count:bigint>"
)


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Windows that the watermark has not closed yet, finished from the state in the checkpoint.

    A bounded run ends before the watermark passes its newest windows, so append mode never
    writes them. Read it between batches or after a run: the state is that of the last batch.
    """
    state = spark.read.format("statestore").load(checkpoint)
    rows = state.select("key.window", "key.service", F.col("value").cast(_WINDOW_STATE).alias("v"))
    return rows.select(
        "window", "service", "v.log_count",
        F.try_divide("v.time_sum", "v.time_count").alias("avg_response_time"),
        F.when(F.col("v.spread_n") > 1, F.sqrt(F.col("v.spread_m2") / (F.col("v.spread_n") - 1))).alias("stddev_response_time"),
        "v.error_count", "v.warn_count", "v.suspicious_ip_count",
    )


def all_windows(spark: SparkSession, emitted: str, checkpoint: str) -> DataFrame:
    """Windows a stream has written to ``emitted`` (parquet) and those still open in its checkpoint."""
    return spark.read.parquet(emitted).unionByName(open_windows(spark, checkpoint))


def running_counters(scored: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """Stateful running totals of a scored stream (update or complete mode)."""
    return live_counters(scored, thresholds)
