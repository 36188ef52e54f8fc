"""Saving fitted pipelines and finding the one to predict with."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from py4j.protocol import Py4JJavaError

from quillspark import fixed_values as fv
from quillspark.operators.comparison import best_model


def model_path(folder: str, name: str) -> str:
    return f"{folder}/{name.lower()}_model"


def save_model(model: PipelineModel, folder: str, name: str) -> None:
    model.write().overwrite().save(model_path(folder, name))


def load_model(folder: str, name: str) -> PipelineModel:
    return PipelineModel.load(model_path(folder, name))


def load_best_model(
    spark: SparkSession, folder: str, metrics: DataFrame | None = None
) -> tuple[str, PipelineModel]:
    """The best model by test F1, or the first that loads in the fallback order."""
    first = fv.MODEL_FALLBACK_ORDER[0]
    if metrics is not None:
        first = best_model(metrics, "test_f1_score").first()["model"]
    for name in dict.fromkeys([first, *fv.MODEL_FALLBACK_ORDER]):
        try:
            return name, load_model(folder, name)
        except (AnalysisException, Py4JJavaError, ValueError, OSError):
            continue
    raise FileNotFoundError(f"no trained model under {folder}")
