"""Streaming jobs that keep their state in a state store, bounded by a watermark or kept for good.

A micro-batch costs what its own rows cost: counts of open windows and known ids are looked up in the store of the
key's partition, and nothing that was written earlier is read.  A restart goes on from the store's checkpoint.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.operators.usage import with_limit
from quillspark.sources.snapshots import SnapshotTable
from quillspark.streaming.jobs import appending, drain, run_id
from quillspark.streaming.processors import BLOCK, MINUTE, WindowCounts

STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
COUNTS = "minute long, provider string, kind string, requests long"


@contextlib.contextmanager
def store_on_disk(spark: SparkSession) -> Iterator[None]:
    """State in RocksDB, which may exceed an executor's memory; a checkpoint holds the changes of each batch."""
    before = {key: spark.conf.get(key, None) for key in STORE}
    for key, value in STORE.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def stream_rate_window(
    requests: DataFrame, target: str, checkpoint: str, ts: str, provider: str, limits: dict[str, int], delay: str = "10 minutes"
) -> tuple[DataFrame, DataFrame]:
    """Requests per provider and minute against the limit, late rows included; and the late rows alone.

    Open windows are counted in the state store, those of a provider's day in one list: a call to Python per day and provider, not per
    window.  When the watermark (the latest time of earlier batches less ``delay``) has passed a window's end, its count goes with the
    next rows of its day, or with the day; requests that still come for it go to the side output, and into the report from there.
    """
    spark = requests.sparkSession
    timed = requests.select(F.col(ts).cast("timestamp").alias("event_time"), F.col(provider).alias("provider"))
    marked = timed.filter(F.col("event_time").isNotNull()).withWatermark("event_time", delay)
    # a computed minute carries no watermark of its own, so rows behind it reach the function instead of being dropped
    minute = (F.floor(F.unix_seconds("event_time") / MINUTE) * MINUTE).cast("long")
    block = (F.floor(F.unix_seconds("event_time") / BLOCK) * BLOCK).cast("long")
    counted = (
        marked.select(block.alias("block"), minute.alias("minute"), "provider")
        .groupBy("block", "provider")
        .transformWithStateInPandas(WindowCounts(), COUNTS, "Update", "EventTime")
    )
    table = SnapshotTable(spark, target, T.StructType.fromDDL(COUNTS))
    with store_on_disk(spark):
        drain(counted, appending(table, run_id(spark, checkpoint)), checkpoint, "update")
    told = table.read()
    kind = lambda name: F.when(F.col("kind") == name, F.col("requests"))
    start = F.timestamp_seconds("minute").alias("window_start")
    # a window's count only grows, so its largest one is the last
    total = told.groupBy("minute", "provider").agg(
        (F.coalesce(F.max(kind("count")), F.lit(0)) + F.coalesce(F.sum(kind("late")), F.lit(0))).alias("requests")
    )
    late = told.filter("kind = 'late'").groupBy("minute", "provider").agg(F.sum("requests").alias("requests"))
    return with_limit(total.select(start, "provider", "requests"), limits), late.select(start, "provider", "requests")


def stream_ingest_unique(incoming: DataFrame, target: str, checkpoint: str, key: str) -> DataFrame:
    """Append records with a new id only; which one of several within a batch is not defined.

    All ids of the run are kept in the state store, by the id's hash; earlier output is never read.
    """
    spark = incoming.sparkSession
    table = SnapshotTable(spark, target, incoming.schema)
    with store_on_disk(spark):
        drain(incoming.dropDuplicates([key]), appending(table, run_id(spark, checkpoint)), checkpoint)
    return table.read()


def stream_ingest_recent(incoming: DataFrame, target: str, checkpoint: str, key: str, ts: str, within: str) -> DataFrame:
    """Append records whose id did not come within the given time; ids older than the watermark leave the state.

    For feeds that repeat an id soon or never.  Spark drops rows behind the watermark here.
    """
    spark = incoming.sparkSession
    table = SnapshotTable(spark, target, incoming.schema)
    with store_on_disk(spark):
        fresh = incoming.withWatermark(ts, within).dropDuplicatesWithinWatermark([key])
        drain(fresh, appending(table, run_id(spark, checkpoint)), checkpoint)
    return table.read()
