"""Who served which requests, and how fast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark import fixed_values as fv
from quillspark.functions.labels import share_status


def _lookup(values: dict, key: Column) -> Column:
    pairs = [F.lit(x) for pair in values.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), key)


def provider_usage(
    requests: DataFrame, provider: str, targets: dict[str, float] = fv.PROVIDER_TARGETS
) -> DataFrame:
    """Requests, share, distance from target and status; idle providers count as zero."""
    idle = requests.sparkSession.range(1).select(
        F.explode(F.array(*map(F.lit, targets))).alias(provider), F.lit(0).cast("bigint").alias("n")
    )
    counts = requests.groupBy(provider).agg(F.count(F.lit(1)).alias("n")).unionByName(idle)
    per_provider = counts.groupBy(provider).agg(F.sum("n").alias("requests"))
    # the window sees one row per provider
    share = F.try_divide(F.col("requests").cast("double"), F.sum("requests").over(W.partitionBy()))
    target = F.coalesce(_lookup(targets, F.col(provider)), F.lit(0.25))
    return per_provider.select(
        F.col(provider).alias("provider"),
        "requests",
        F.round(share, 6).alias("share"),
        target.alias("target"),
        F.round(F.abs(share - target), 6).alias("deviation"),
        share_status(F.abs(share - target)).alias("status"),
    )


def generation_run_stats(attempts: DataFrame, started: str, provider: str) -> DataFrame:
    """Per provider, and overall under ``all``: attempts, outcomes, success rate and pace.

    ``attempts`` has booleans ``success`` and ``quality_ok``; each row counts once.
    """
    passed = F.col("success") & F.col("quality_ok")
    seconds = F.unix_micros(F.col(started).cast("timestamp")) / F.lit(1e6)
    minutes = (F.max("_seconds") - F.min("_seconds")) / 60
    totals = (
        attempts.withColumn("_seconds", seconds)
        .rollup(F.col(provider).alias("provider"))
        .agg(
            F.grouping_id().alias("_level"),
            F.count(F.lit(1)).alias("processed"),
            F.count(F.when(passed, 1)).alias("successful"),
            F.count(F.when(~F.col("success"), 1)).alias("failed"),
            F.count(F.when(passed, 1)).alias("quality_passed"),
            F.count(F.when(F.col("success") & ~F.col("quality_ok"), 1)).alias("quality_failed"),
            minutes.alias("_minutes"),
        )
    )
    return totals.select(
        F.when(F.col("_level") == 1, F.lit("all")).otherwise(F.col("provider")).alias("provider"),
        "processed",
        "successful",
        "failed",
        "quality_passed",
        "quality_failed",
        F.round(F.col("successful") / F.col("processed"), 6).alias("success_rate"),
        F.round(F.try_divide(F.col("successful").cast("double"), F.col("_minutes")), 6).alias(
            "texts_per_minute"
        ),
    )


def rate_window_usage(
    requests: DataFrame,
    ts: str,
    provider: str,
    limits: dict[str, int],
    length: str = "1 minute",
) -> DataFrame:
    """Requests per provider and clock-aligned window against the provider's limit."""
    counts = requests.groupBy(F.window(ts, length).alias("w"), F.col(provider).alias("provider")).agg(
        F.count(F.lit(1)).alias("requests")
    )
    return with_limit(counts.withColumn("window_start", F.col("w.start")).drop("w"), limits)


def with_limit(counts: DataFrame, limits: dict[str, int]) -> DataFrame:
    allowed = _lookup(limits, F.col("provider"))
    return counts.select(
        "window_start",
        "provider",
        "requests",
        allowed.alias("allowed"),
        F.coalesce(F.col("requests") > allowed, F.lit(False)).alias("over_limit"),
    )


def provider_by_priority(
    requests: DataFrame, ts: str, provider: str, limits: dict[str, tuple[int, int]]
) -> DataFrame:
    """Per minute the best-ranked provider that still has room; null when all are full."""
    ranked = sorted(limits, key=lambda name: limits[name][0])
    per_minute = requests.groupBy(F.window(ts, "1 minute").alias("w")).agg(
        *[F.count(F.when(F.col(provider) == name, 1)).alias(f"n_{i}") for i, name in enumerate(ranked)]
    )
    pick = F.lit(None).cast("string")
    for i, name in reversed(list(enumerate(ranked))):
        pick = F.when(F.col(f"n_{i}") < limits[name][1], F.lit(name)).otherwise(pick)
    return per_minute.select(F.col("w.start").alias("window_start"), pick.alias("provider"))
