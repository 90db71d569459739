"""Scoring rows against cluster centres with column expressions.

Fitting is MLlib's work; what scoring needs from it is small (means, deviations
and k centres), so it is carried as plain numbers and applied as generated
code: no join, no vector type and no Python worker, on batches and streams.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.functions import columns as C
from emberlog.functions import fixed
from emberlog.functions.params import Thresholds


@dataclass(frozen=True)
class CenterModel:
    """Standardisation and cluster centres, plus figures frozen at training time."""

    features: Sequence[str]
    means: Sequence[float]
    stds: Sequence[float]
    centers: Sequence[Sequence[float]]
    cluster_shares: Sequence[float] = field(default=())
    distance_mean: float | None = None
    distance_std: float | None = None
    distance_max: float | None = None
    large: Sequence[int] | None = None  # rows of other clusters are measured to the nearest of these; None: all to their own

    def scaled(self) -> list[Column]:
        """(x - mean) / deviation per feature; a constant feature becomes zero."""
        return [
            (F.col(name) - F.lit(mean)) / F.lit(std) if std else F.lit(0.0)
            for name, mean, std in zip(self.features, self.means, self.stds)
        ]

    def assign(self, features: DataFrame) -> DataFrame:
        """Add ``cluster`` (nearest centre) and ``distance_to_center``.

        Rows with a missing feature get NULL in both.  If the model names its large
        clusters, a row of any other is measured to the nearest large centre.
        """
        original = features.columns
        z = [f"_z{i}" for i in range(len(self.features))]
        d = [f"_d{j}" for j in range(len(self.centers))]
        with_z = features.withColumns(dict(zip(z, self.scaled())))
        complete = reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in self.features])
        squares = {
            name: reduce(
                add, [(F.col(zi) - F.lit(float(ci))) * (F.col(zi) - F.lit(float(ci))) for zi, ci in zip(z, center)]
            )
            for name, center in zip(d, self.centers)
        }
        with_d = with_z.withColumns(squares)
        nearest = _least([F.col(name) for name in d])
        index = reduce(
            lambda rest, j: F.when(F.col(d[j]) == nearest, j).otherwise(rest),
            reversed(range(len(d))),
            F.lit(None).cast("int"),
        )
        measured = nearest
        if self.large is not None:
            ordinary = _least([F.col(d[j]) for j in self.large])
            measured = F.when(index.isin(list(self.large)), nearest).otherwise(ordinary)
        return C.computed_once(
            with_d,
            {
                "cluster": F.when(complete, index),
                "distance_to_center": F.when(complete, F.sqrt(measured)),
            },
            original,
        )

    def rare_cluster(self, share: float = Thresholds.rare_cluster_share) -> Column:
        """True for clusters that held less than ``share`` of the training rows."""
        rare = [i for i, s in enumerate(self.cluster_shares) if s < share]
        return F.coalesce(F.col("cluster").isin(rare), F.lit(False)) if rare else F.lit(False)

    def sized(self, features: DataFrame, share: float = Thresholds.rare_cluster_share) -> "CenterModel":
        """The model with distances by cluster size, and the figures of these distances.

        KMeans spends a centre on a row that is far from all others, so that the row has
        distance 0.  What makes it odd is its distance to the clusters that hold at least
        ``share`` of the rows; if none does, to the largest.
        """
        measured = self if len(self.cluster_shares) else self.with_figures(features)
        shares = list(measured.cluster_shares)
        large = [j for j, s in enumerate(shares) if s >= share] or [shares.index(max(shares))]
        return replace(measured, large=large).with_figures(features)

    def with_figures(self, features: DataFrame) -> "CenterModel":
        """Measure distances and cluster shares on ``features`` in one pass."""
        row = (
            self.assign(features)
            .agg(*distance_stats_columns(), *[F.count_if(F.col("cluster") == j).alias(f"c{j}") for j in range(len(self.centers))])
            .first()
        )
        sizes = [row[f"c{j}"] for j in range(len(self.centers))]
        total = max(sum(sizes), 1)
        return replace(
            self,
            cluster_shares=[n / total for n in sizes],
            distance_mean=row["avg_distance"],
            distance_std=row["stddev_distance"],
            distance_max=row["max_distance"],
        )


def _least(columns: list[Column]) -> Column:
    return F.least(*columns) if len(columns) > 1 else columns[0]


def distance_stats_columns(distance: str = "distance_to_center") -> list[Column]:
    return [
        F.max(distance).alias("max_distance"),
        F.avg(distance).alias("avg_distance"),
        C.usable_spread(F.stddev_samp(distance)).alias("stddev_distance"),
    ]


def distance_stats(assigned: DataFrame) -> DataFrame:
    """Maximum, mean and usable sample deviation of the distances."""
    return assigned.agg(*distance_stats_columns())


def standardisation(features: DataFrame, names: Sequence[str]) -> tuple[list[float], list[float]]:
    """Mean and sample deviation per feature, one pass, two numbers per feature."""
    row = features.agg(
        *[F.avg(n).alias(f"m_{n}") for n in names],
        *[F.coalesce(F.stddev_samp(n), F.lit(0.0)).alias(f"s_{n}") for n in names],
    ).first()
    return [row[f"m_{n}"] or 0.0 for n in names], [row[f"s_{n}"] for n in names]


def rare_cluster_by_id() -> Column:
    """The older rule that takes high cluster ids for rare ones."""
    return F.coalesce(F.col("cluster") >= fixed.ENHANCED_RARE_CLUSTER_ID, F.lit(False))


def zscore_scores(assigned: DataFrame, model: CenterModel, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """``anomaly_score`` from the distance z-score and the KMeans decision ``is_anomaly``."""
    score = C.zscore_score(
        F.col("distance_to_center"), F.lit(model.distance_mean), F.lit(model.distance_std)
    )
    return assigned.withColumn("anomaly_score", score).withColumn(
        "is_anomaly", F.when(F.col("anomaly_score") > thresholds.kmeans_anomaly, 1).otherwise(0)
    )


def linear_scores(assigned: DataFrame) -> DataFrame:
    return assigned.withColumn("anomaly_score", C.linear_distance_score())


def enhanced_scores(assigned: DataFrame, rare_cluster: Column) -> DataFrame:
    """Linear distance score raised by the enhancement rules."""
    return C.computed_once(
        assigned, {"anomaly_score": C.enhanced_score(C.linear_distance_score(), rare_cluster)}
    )
