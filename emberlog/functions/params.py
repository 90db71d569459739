"""Tunable parameters, one object per concern, with the default cut-offs."""

from __future__ import annotations

from dataclasses import dataclass

from emberlog.functions import fixed


@dataclass(frozen=True)
class Thresholds:
    """Cut-offs; every operator takes the whole object and reads its own field."""

    kmeans_anomaly: float = 0.7        # z-score based KMeans decision, score > x
    ensemble_anomaly: float = 0.65     # combined decision, score >= x
    live_anomaly: float = 0.6          # streaming detection, score > x
    live_critical: float = 0.8         # running counter of critical anomalies, score > x
    trained_anomaly: float = 0.4       # trained-model analysis, score > x
    analysis_anomaly: float = 0.4      # per-file analysis, score >= x
    alert: float = fixed.SEVERITY_MEDIUM  # alerts are made from here, score >= x
    suspicious_node: float = 0.6       # graph score of a suspicious address, score > x
    rare_cluster_share: float = 0.05   # clusters holding less than this share are rare
    contamination: float = fixed.CONTAMINATION


@dataclass(frozen=True)
class AnalysisOptions:
    """Options of one analysis run."""

    use_ml: bool = True
    generate_alerts: bool = True
    anomaly_threshold: float | None = None  # None: the default of the method
    thresholds: Thresholds = Thresholds()

    @property
    def threshold(self) -> float:
        if self.anomaly_threshold is not None:
            return self.anomaly_threshold
        return self.thresholds.analysis_anomaly

    @property
    def ml_threshold(self) -> float:
        """Cut of the combined score: an average line scores about 0.5, so the rules' cut would mark it."""
        if self.anomaly_threshold is not None:
            return self.anomaly_threshold
        return self.thresholds.ensemble_anomaly
