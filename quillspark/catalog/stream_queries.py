"""Streaming jobs over files; each must equal its batch counterpart."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.catalog import base as b
from quillspark.catalog.base import query, table
from quillspark.catalog.metric_queries import DRIFT_SQL
from quillspark.catalog.model_queries import ID, PREDICTED_SQL, parts, rounded_predictions
from quillspark.catalog.quality_queries import LIMITS, MINUTE, RATE_SQL, minute
from quillspark.plans import models
from quillspark.session import scratch_path
from quillspark.streaming import jobs, stateful


def arriving(spark, sf, name):
    """A table as a stream of files."""
    schema = spark.read.parquet(f"{sf}/{name}.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{sf}/{name}*.parquet")


def in_parts(spark, sf, job, parts=4, delayed=None):
    """The event log arriving in four appends, in order; ``job`` drains the stream after each.

    Events of the type ``delayed`` arrive with the next append.
    """
    files = scratch_path(spark, "arriving")
    events = table(spark, sf, "events")
    last = events.select(F.max("event_id")).scalar()
    place = F.floor(F.col("event_id") * parts / (last + 1))
    if delayed:
        place = F.least(place + (F.col("event_type") == delayed).cast("int"), F.lit(parts - 1))
    for part in range(parts):
        events.filter(place == part).write.mode("append").parquet(files)
        out = job(spark.readStream.schema(events.schema).parquet(files))
    return out


@query("stream_ingest_dedupe", "SELECT user_id, min(event_id) AS event_id FROM events GROUP BY user_id")
def _ingest(spark, sf):
    """A user is new only once, over four micro-batches."""
    target, checkpoint = scratch_path(spark, "ingested"), scratch_path(spark, "ingest-state")
    return in_parts(spark, sf, lambda stream: jobs.stream_ingest_dedupe(
        stream.select("user_id", "event_id"), target, checkpoint, "user_id", ["event_id"]))


@query("stream_rate_window", RATE_SQL)
def _rates(spark, sf):
    """Four micro-batches with their own counts of the same minutes."""
    target, checkpoint = scratch_path(spark, "rates"), scratch_path(spark, "rates-state")
    limits = {k: n for k, (_, n) in LIMITS.items()}
    out = in_parts(spark, sf, lambda stream: jobs.stream_rate_window(
        stream.select("ts", "event_type"), target, checkpoint, "ts", "event_type", limits))
    return out.withColumn("window_start", minute())


DELAY_MS = 600_000
PARTS_SQL = "SELECT *, floor(event_id * 4.0 / ((SELECT max(event_id) FROM events) + 1))::BIGINT AS part FROM events"


def stateful_rates(spark, sf):
    target, checkpoint = scratch_path(spark, "open-windows"), scratch_path(spark, "open-windows-state")
    limits = {k: n for k, (_, n) in LIMITS.items()}
    return in_parts(spark, sf, lambda stream: stateful.stream_rate_window(
        stream.select("ts", "event_type"), target, checkpoint, "ts", "event_type", limits, f"{DELAY_MS} milliseconds"), delayed="purchase")


@query("stream_rate_window_stateful", RATE_SQL)
def _stateful_rates(spark, sf):
    """Open windows in a state store over four restarts, and late rows from the side."""
    return stateful_rates(spark, sf)[0].withColumn("window_start", minute())


@query(
    "stream_late_requests",
    f"""WITH p AS (SELECT ts, event_type, least(part + (event_type = 'purchase')::INT, 3) AS part FROM ({PARTS_SQL})),
    w AS (SELECT part, max(max(epoch_ms(ts))) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {DELAY_MS} AS mark
          FROM p GROUP BY part)
    SELECT {MINUTE} AS window_start, event_type AS provider, count(*)::BIGINT AS requests FROM p JOIN w USING (part)
    WHERE (floor(epoch_ms(ts) / 60000.0) + 1) * 60000 <= mark GROUP BY ALL""",
)
def _late(spark, sf):
    """Rows that came when the watermark of the batches before had passed their window."""
    return stateful_rates(spark, sf)[1].withColumn("window_start", minute())


@query("stream_ingest_unique", f"SELECT user_id, min(part) AS part FROM ({PARTS_SQL}) GROUP BY user_id")
def _unique(spark, sf):
    """Ids known to a state store over four restarts, each with the append that brought it first."""
    target, checkpoint = scratch_path(spark, "unique"), scratch_path(spark, "unique-state")
    last = table(spark, sf, "events").select(F.max("event_id")).first()[0]
    part = F.floor(F.col("event_id") * 4 / (last + 1)).alias("part")
    return in_parts(spark, sf, lambda stream: stateful.stream_ingest_unique(stream.select("user_id", part), target, checkpoint, "user_id"))


@query("stream_drift_monitor", DRIFT_SQL)
def _drift(spark, sf):
    target, checkpoint = scratch_path(spark, "drift"), scratch_path(spark, "drift-state")
    judged = (
        "event_id",
        "ts",
        F.col("event_type").isin("error", "purchase").cast("int").alias("label"),
        (F.col("value") > 10).cast("int").alias("predicted"),
    )
    out = in_parts(spark, sf, lambda stream: jobs.stream_drift_monitor(stream.select(*judged), target, checkpoint, "ts"))
    return out.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd"))


@query("stream_score", PREDICTED_SQL)
def _score(spark, sf):
    model = models.fit_model(models.NAIVE_BAYES, parts(spark, sf)[0], ID)
    texts = arriving(spark, sf, "documents").select(F.col("doc_id").alias("text_id"), "text")
    target, checkpoint = scratch_path(spark, "predictions"), scratch_path(spark, "score-state")
    return rounded_predictions(jobs.stream_score(texts, model, "Naive_Bayes", target, checkpoint))
