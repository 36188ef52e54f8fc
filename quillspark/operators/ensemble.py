"""Combining models from the long table ``(model, row, label, score)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.session import broadcast_if_small


def ensemble_vote(scored: DataFrame, row_id: str, threshold: float = 0.5) -> DataFrame:
    """Majority of the members; a tie goes to ai, as a mean of exactly one half does."""
    votes = scored.withColumn("vote", (F.col("score") >= threshold).cast("double"))
    return _combined(votes.groupBy(row_id, "label").agg(F.avg("vote").alias("score")))


def ensemble_average(scored: DataFrame, row_id: str) -> DataFrame:
    return _combined(scored.groupBy(row_id, "label").agg(F.avg("score").alias("score")))


def ensemble_weighted(scored: DataFrame, weights: DataFrame, row_id: str) -> DataFrame:
    """Members weighted by validation accuracy, one row per model."""
    joined = scored.join(broadcast_if_small(weights.select("model", "accuracy")), "model")
    mean = F.sum(F.col("score") * F.col("accuracy")) / F.sum("accuracy")
    return _combined(joined.groupBy(row_id, "label").agg(mean.alias("score")))


def _combined(df: DataFrame) -> DataFrame:
    rounded = df.withColumn("score", F.round("score", 6))
    return rounded.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
