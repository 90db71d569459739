"""Whole analyses: from numbered lines to anomalies, alerts and statistics.

Input of every method is ``file_id, line_number, value``.  One call covers any
number of files; records and statistics carry the ``file_id``.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.functions import fixed
from emberlog.functions.params import AnalysisOptions, Thresholds
from emberlog.operators import centers, iforest, kmeans, rules
from emberlog.operators.aggregates import TREND_FEATURES, TREND_FIELDS, entity_summary, pattern_summary, service_trend
from emberlog.operators.parse import (
    complete_rows,
    extract_features,
    parse_lines,
    rejected_rows,
    valid_lines,
)
from emberlog.operators.statistics import analysis_statistics, trained_statistics
from emberlog.sources import tables
from emberlog.sources.scratch import staged

RULES_TYPE, ML_TYPE = "pattern_spark", "spark_mllib"
METHOD_LABELS = {RULES_TYPE: "keyword and threshold rules", ML_TYPE: "clusters and isolation forest"}


@dataclass(frozen=True)
class Analysis:
    """Lazy results of one analysis."""

    scored: DataFrame       # every line that was scored
    anomalies: DataFrame    # anomaly records
    alerts: DataFrame       # alerts, empty if not asked for
    statistics: DataFrame   # one record per file
    rejects: DataFrame      # lines a model cannot score
    analysis_type: str
    started: float = field(default_factory=time.time)
    trained: bool = False   # by a model trained before, with summaries per file
    thresholds: Thresholds = Thresholds()

    def write(self, root: str, only: tuple[str, ...] = tables.ALL, keep_former: bool = False) -> None:
        """Write the result tables of these files as a new run, and its commit last.

        Until the commit readers see the run before, which is removed afterwards unless
        it is to be kept: a run without anomalies hides those of the run before, and tables that this
        run does not write stay as they are.
        """
        run = f"r{uuid.uuid4().hex}"
        rows = {
            tables.ANOMALIES: lambda: self.anomalies,
            tables.ALERTS: lambda: self.alerts,
            tables.REJECTS: lambda: self.rejects,
            tables.STATISTICS: self._labelled,
            tables.ENTITIES: self.entities,
            tables.PATTERNS: self.error_patterns,
        }
        if self.trained:
            rows[tables.SUMMARIES] = self.summaries
        written = {}
        for name in only:
            if name in rows:
                table = rows[name]()
                tables.write_table(table, root, name, run)
                written[name] = table.schema
        files = self.statistics.select("file_id")
        tables.write_commits(files, root, written, run)
        if not keep_former:
            for name in written:
                tables.remove_former_runs(self.anomalies.sparkSession, root, name, files)

    def entities(self) -> DataFrame:
        """Services and addresses of the anomalies by file and day."""
        return entity_summary(self.anomalies)

    def error_patterns(self) -> DataFrame:
        """Error messages of the anomalies by file and day."""
        return pattern_summary(self.anomalies)

    def summaries(self) -> DataFrame:
        """Volumes, bands, response time, time range and busiest addresses per file, of a trained analysis."""
        return trained_statistics(self.scored, thresholds=self.thresholds, by=("file_id",))

    def _labelled(self) -> DataFrame:
        return self.statistics.withColumns(
            {
                "analysis_method": F.lit(METHOD_LABELS[self.analysis_type]),
                "status": F.lit("completed"),
                "analysis_completed": F.current_timestamp(),
                "processing_time": F.lit(round(time.time() - self.started, 2)),
            }
        )


def _analysis(
    scored: DataFrame,
    hit: Column,
    analysis_type: str,
    options: AnalysisOptions,
    rejects: DataFrame,
    score: str = "anomaly_score",
    cluster: Column | None = None,
) -> Analysis:
    anomalies = rules.anomaly_records(scored.filter(hit), analysis_type, score, cluster)
    alerts = rules.alerts(anomalies, options.thresholds)
    if not options.generate_alerts:
        alerts = alerts.limit(0)
    statistics = analysis_statistics(
        scored, hit, ["file_id"], score, options.generate_alerts, options.thresholds
    )
    return Analysis(scored, anomalies, alerts, statistics, rejects, analysis_type)


def analyze_rules(lines: DataFrame, options: AnalysisOptions = AnalysisOptions(), stage: bool = False) -> Analysis:
    """Keyword and threshold rules.  ``stage`` parses once for all results."""
    scored = rules.with_pattern_score(parse_lines(lines))
    if stage:
        scored = staged(scored, "rule-scores")
    none = scored.limit(0).select("file_id", "line_number")
    return _analysis(scored, F.col("anomaly_score") >= options.threshold, RULES_TYPE, options, none)


def analyze_ml(lines: DataFrame, options: AnalysisOptions = AnalysisOptions()) -> Analysis:
    """KMeans and isolation forest fitted on these lines, combined by weights.

    Features are written once; the scaler, KMeans, the forest sample and the
    scores all read that table, never the text again.  Lines without all features
    are rejects; if no line has them, nothing can be fitted and the rules decide.
    """
    features = staged(extract_features(valid_lines(parse_lines(lines))), "features")
    names = fixed.FEATURES_11
    rows = complete_rows(features, names)
    rejects = rejected_rows(features, names).select("file_id", "line_number")
    if rows.isEmpty():
        return replace(analyze_rules(lines, options, stage=True), rejects=rejects)
    _, model = kmeans.fit_kmeans(rows, names)
    model = model.sized(rows, options.thresholds.rare_cluster_share)
    forest = iforest.fit_isolation_forest(rows, names, ["file_id", "line_number"])
    return _combined(rows, model, forest, rejects, options)


def _combined(rows: DataFrame, model: centers.CenterModel, forest: iforest.IsolationForest, rejects: DataFrame, options: AnalysisOptions) -> Analysis:
    """Analysis of complete rows by the scores of a cluster model and a forest."""
    scored = centers.zscore_scores(model.assign(rows), model, options.thresholds)
    scored = staged(iforest.ensemble(forest.score(scored), options.thresholds), "ensemble-scores")
    return _analysis(
        scored,
        F.col("final_anomaly_score") >= options.ml_threshold,
        ML_TYPE,
        options,
        rejects,
        "final_anomaly_score",
        F.col("cluster"),
    )


def analyze_with(
    lines: DataFrame, model: centers.CenterModel, forest: iforest.IsolationForest, options: AnalysisOptions = AnalysisOptions()
) -> Analysis:
    """The ML analysis by a cluster model and a forest fitted before; nothing is fitted here.

    The features of the model and of the forest together decide which lines are complete.
    """
    names = list(dict.fromkeys([*model.features, *forest.features]))
    features = staged(extract_features(valid_lines(parse_lines(lines))), "features")
    rejects = rejected_rows(features, names).select("file_id", "line_number")
    return _combined(complete_rows(features, names), model, forest, rejects, options)


def trained_scores(
    lines: DataFrame,
    model: centers.CenterModel,
    options: AnalysisOptions = AnalysisOptions(),
    rare_by_id: bool = False,
) -> DataFrame:
    """Enhanced score of every valid line under a trained model."""
    features = extract_features(valid_lines(parse_lines(lines)))
    rare = (
        centers.rare_cluster_by_id()
        if rare_by_id
        else model.rare_cluster(options.thresholds.rare_cluster_share)
    )
    return centers.enhanced_scores(model.assign(features), rare)


def analyze_trained(
    lines: DataFrame,
    model: centers.CenterModel | None,
    options: AnalysisOptions = AnalysisOptions(),
    rare_by_id: bool = False,
    stage: bool = False,
) -> Analysis:
    """Trained model with enhanced scores; without a model, the rules."""
    if model is None:
        return analyze_rules(lines, options, stage)
    scored = trained_scores(lines, model, options, rare_by_id)
    if stage:
        scored = staged(scored, "trained-scores")
    cut = options.thresholds.trained_anomaly
    if options.anomaly_threshold is not None:
        cut = options.anomaly_threshold
    rejects = scored.filter(F.col("cluster").isNull()).select("file_id", "line_number")
    done = _analysis(
        scored, F.col("anomaly_score") > cut, ML_TYPE, options, rejects, cluster=F.col("cluster")
    )
    return replace(done, trained=True, thresholds=replace(options.thresholds, trained_anomaly=cut))


def historical_report(lines: DataFrame) -> DataFrame:
    """Errors, warnings and mean response time per service of past lines."""
    parsed = valid_lines(parse_lines(lines, TREND_FIELDS))
    return service_trend(extract_features(parsed, TREND_FEATURES))


def analyze(lines: DataFrame, options: AnalysisOptions = AnalysisOptions()) -> Analysis:
    """Analyse lines with the method the options name."""
    context = lines.sparkSession.sparkContext
    label = METHOD_LABELS[ML_TYPE if options.use_ml else RULES_TYPE]
    context.setJobDescription(f"log analysis: {label}")
    started = time.time()
    try:
        done = analyze_ml(lines, options) if options.use_ml else analyze_rules(lines, options, stage=True)
        return replace(done, started=started)
    finally:
        context.setJobDescription(None)
