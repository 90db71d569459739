"""Training: MLlib pipeline of assembler, scaler and KMeans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.functions import fixed
from emberlog.operators.centers import CenterModel
from emberlog.operators.parse import complete_rows
from emberlog.sources.scratch import spread, staged


def assembler(names: Sequence[str], handle_invalid: str = "skip") -> VectorAssembler:
    """Vector of the features; rows with a NULL are skipped (or rejected with ``error``)."""
    return VectorAssembler(inputCols=list(names), outputCol="features_raw", handleInvalid=handle_invalid)


def scaler() -> StandardScaler:
    return StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True)


def scaled_vectors(features: DataFrame, names: Sequence[str]) -> tuple[DataFrame, PipelineModel]:
    """Rows with ``features_raw`` and ``features`` vectors, and the fitted stages."""
    assemble = assembler(names)
    vectors = assemble.transform(features)
    fitted = PipelineModel([assemble, scaler().fit(vectors)])
    return fitted.transform(features), fitted


def fit_kmeans(
    features: DataFrame,
    names: Sequence[str] = fixed.FEATURES_8,
    k: int = fixed.KMEANS_K,
    seed: int = fixed.KMEANS_SEED,
) -> tuple[PipelineModel, CenterModel]:
    """Fit assembler, scaler and KMeans; return the pipeline and the scoring model.

    KMeans runs over the distinct feature rows weighted by their counts: the same
    objective as over all rows.  That saves work where rows repeat; with features such
    as hour, minute and response time they hardly do, and the iterations grow with the log.
    """
    rows = complete_rows(features, names)
    assemble = assembler(names)
    scale = scaler().fit(assemble.transform(rows.select(*names)))
    weighted = rows.groupBy(*names).agg(F.count("*").cast("double").alias("weight"))
    distinct = spread(staged(weighted, "distinct-features"))
    vectors = scale.transform(assemble.transform(distinct)).select("features", "weight")
    clusters = KMeans(
        k=k, seed=seed, featuresCol="features", predictionCol="cluster", weightCol="weight"
    ).fit(vectors)
    pipeline = PipelineModel([assemble, scale, clusters])
    return pipeline, center_model(pipeline).with_figures(rows)


def center_model(pipeline: PipelineModel) -> CenterModel:
    """The numbers of a fitted pipeline that scoring needs."""
    assemble, scale, clusters = pipeline.stages
    assert isinstance(scale, StandardScalerModel) and isinstance(clusters, KMeansModel)
    return CenterModel(
        features=list(assemble.getInputCols()),
        means=[float(x) for x in scale.mean.toArray()],
        stds=[float(x) for x in scale.std.toArray()],
        centers=[[float(x) for x in c] for c in clusters.clusterCenters()],
    )
