"""Corpus profiles: counts, averages and histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.operators.joins import same_keys
from quillspark.session import broadcast_if_small

HISTOGRAM_BINS = 50


def _cents(value: Column) -> Column:
    """Two decimals, halves to even."""
    return F.rint(value * 100) / 100


def stats_by_label(df: DataFrame) -> DataFrame:
    """Mean and sample deviation of length and words per label, two decimals."""
    return df.groupBy("label").agg(
        F.count(F.lit(1)).alias("texts"),
        _cents(F.avg("text_length")).alias("text_length_mean"),
        _cents(F.stddev_samp("text_length")).alias("text_length_std"),
        _cents(F.avg("word_count")).alias("word_count_mean"),
        _cents(F.stddev_samp("word_count")).alias("word_count_std"),
    )


def corpus_stats(df: DataFrame) -> DataFrame:
    """One row describing a split corpus."""

    def tally(column: str, value: str):
        return F.count(F.when(F.col(column) == value, F.lit(1)))

    return df.agg(
        F.count(F.lit(1)).alias("total_texts"),
        tally("split", "train").alias("train_size"),
        tally("split", "val").alias("val_size"),
        tally("split", "test").alias("test_size"),
        tally("label", "human").alias("human_texts"),
        tally("label", "ai").alias("ai_texts"),
        F.avg("text_length").alias("avg_text_length"),
        F.avg("word_count").alias("avg_word_count"),
    )


def class_shares(df: DataFrame, label: str = "label") -> DataFrame:
    """Count and percentage per class; the window sees one row per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("texts"))
    share = F.col("texts") * 100.0 / F.sum("texts").over(W.partitionBy())
    return counts.withColumn("percent", F.round(share, 4))


def split_label_counts(df: DataFrame) -> DataFrame:
    counts = df.groupBy("split").pivot("label", ["human", "ai"]).count()
    return counts.select(
        "split",
        F.coalesce("human", F.lit(0)).alias("human"),
        F.coalesce("ai", F.lit(0)).alias("ai"),
    )


def balance_report(df: DataFrame) -> DataFrame:
    human = F.count(F.when(F.col("label") == "human", F.lit(1)))
    ai = F.count(F.when(F.col("label") == "ai", F.lit(1)))
    return df.agg(
        F.count(F.lit(1)).alias("total_samples"),
        human.alias("human_samples"),
        ai.alias("ai_samples"),
        F.round(F.try_divide(human.cast("double"), ai), 6).alias("balance_ratio"),
        F.round(F.avg(F.length("text")), 6).alias("avg_text_length"),
    )


def length_histogram(df: DataFrame, value: str = "text_length", bins: int = HISTOGRAM_BINS):
    """Equal-width bins over each label's own range; the last bin is closed."""
    ranges = df.groupBy("label").agg(F.min(value).alias("low"), F.max(value).alias("high"))
    ranges = broadcast_if_small(ranges)
    joined = df.join(ranges, same_keys(df, ranges, ["label"])).drop(ranges["label"])
    width = (F.col("high") - F.col("low")) / F.lit(float(bins))
    at = F.floor((F.col(value) - F.col("low")) * bins / (F.col("high") - F.col("low")))
    flat = F.col("high") == F.col("low")
    binned = joined.withColumn(
        "bin", F.when(flat, F.lit(bins // 2)).otherwise(F.least(at, F.lit(bins - 1)))
    )
    edge = F.when(flat, F.col("low").cast("double")).otherwise(F.col("low") + F.col("bin") * width)
    return (
        binned.groupBy("label", "bin", F.round(edge, 6).alias("bin_start"))
        .agg(F.count(F.lit(1)).alias("texts"))
    )


def batch_summary(predictions: DataFrame, by: list[str] | None = None) -> DataFrame:
    human = F.col("predicted_label") == "Human"
    return predictions.groupBy(*(by or [])).agg(
        F.count(F.when(human, F.lit(1))).alias("human_texts"),
        F.count(F.when(~human, F.lit(1))).alias("ai_texts"),
        F.avg("confidence").alias("mean_confidence"),
    )
