"""Saving and loading trained models."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from emberlog.operators.centers import CenterModel
from emberlog.operators.kmeans import center_model

_FIGURES = "cluster_shares array<double>, distance_mean double, distance_std double, distance_max double, large array<int>"


def save_model(spark: SparkSession, path: str, pipeline: PipelineModel | None, model: CenterModel | None) -> None:
    """Write the whole pipeline (scaler included) and the training figures; replaces a former model."""
    if pipeline is None or model is None:
        raise ValueError("no trained model to save")
    pipeline.write().overwrite().save(f"{path}/pipeline")
    large = None if model.large is None else list(model.large)
    figures = [(list(model.cluster_shares), model.distance_mean, model.distance_std, model.distance_max, large)]
    spark.createDataFrame(figures, _FIGURES).write.mode("overwrite").json(f"{path}/figures")


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, CenterModel]:
    pipeline = PipelineModel.load(f"{path}/pipeline")
    figures = spark.read.schema(_FIGURES).json(f"{path}/figures").first()
    return pipeline, replace(center_model(pipeline), **figures.asDict())
