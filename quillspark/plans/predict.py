"""Scoring new texts with a fitted model."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark import fixed_values as fv
from quillspark.functions.text import clean_for_scoring


def clean_scorable(texts: DataFrame, least: int = fv.MIN_SCORABLE_CHARS) -> DataFrame:
    """``(text_id, clean_text)`` of the scorable texts; each is cleaned once, by a generator that yields one text or none."""
    kept = F.filter(F.array(clean_for_scoring(F.col("text"))), lambda t: F.length(t) >= least)
    return texts.select("text_id", F.explode(kept).alias("clean_text"))


def predict_batch(model: PipelineModel, name: str, texts: DataFrame) -> DataFrame:
    """Label, both probabilities and confidence for every scorable ``(text_id, text)``.

    Works on a static table and on a stream alike: one projection, no state.
    """
    scored = model.transform(clean_scorable(texts))
    probability = vector_to_array("probability")
    return scored.select(
        "text_id",
        F.when(F.col("prediction") == 0, "Human").otherwise("AI").alias("predicted_label"),
        F.greatest(probability[0], probability[1]).alias("confidence"),
        probability[0].alias("human_probability"),
        probability[1].alias("ai_probability"),
        F.lit(name).alias("model_used"),
        F.length("clean_text").alias("text_length"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("prediction_time"),
    )
