"""Sinks: splits, appended records, run statistics and metric tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PROCESSED = ("label", "source", "text_length", "word_count")


def write_splits(df: DataFrame, path: str) -> None:
    """JSON Lines, CSV and parquet, one directory per split (their union is the full set)."""
    by_split = df.select("split", F.col("clean_text").alias("text"), *PROCESSED)
    by_split.write.partitionBy("split").json(f"{path}/json")
    df.select("split", "clean_text", *PROCESSED).write.partitionBy("split").option(
        "header", True
    ).option("escape", '"').csv(f"{path}/csv")
    by_split.write.partitionBy("split").parquet(f"{path}/parquet")


def append_records(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_run_stats(stats: DataFrame, path: str) -> None:
    """A one-row table as one JSON object with the time of writing; ``coalesce`` adds no shuffle."""
    dated = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("preprocessing_date")
    stats.select(dated, "*").coalesce(1).write.json(path)


def write_metrics(metrics: DataFrame, path: str, digits: int = 4) -> None:
    """JSON and CSV of a metrics table, numbers rounded."""
    rounded = metrics.select(
        *[
            F.round(c, digits).alias(c) if t == "double" else F.col(c)
            for c, t in metrics.dtypes
        ]
    ).coalesce(1)
    rounded.write.json(f"{path}/json")
    rounded.write.option("header", True).csv(f"{path}/csv")
