"""Streaming jobs.  Each drains what is available and equals its batch counterpart.

Sinks are snapshot tables.  A run is the life of one checkpoint folder and its id is kept there; a table knows the last batch of each
run, so a replayed batch changes nothing, and a new checkpoint on an old target adds to it.  Small batches are merged, so
reading costs what the rows cost, however many batches there were.
Windowed counts are written as partial counts per micro-batch and added up when read: a row that arrives late is
one more partial, whatever its time, and no state has to be bounded by dropping it.  ``stateful`` has the forms that keep
their state in a state store.
"""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quillspark.operators import metrics as m
from quillspark.operators.corpus import antijoin_new_ids
from quillspark.operators.usage import with_limit
from quillspark.plans.predict import predict_batch
from quillspark.sources.snapshots import SnapshotTable

ID_BUCKETS = 64


def drain(stream: DataFrame, sink, checkpoint: str, mode: str = "append") -> StreamingQuery:
    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def _listed(spark: SparkSession, pattern: str) -> bool:
    """Whether any path matches; access errors are raised, not taken for an empty target."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the run that a checkpoint folder belongs to, made up the first time."""
    folder = f"{checkpoint}/run"
    if not _listed(spark, f"{folder}/_SUCCESS"):
        spark.createDataFrame([(uuid.uuid4().hex,)], "run string").write.mode("overwrite").json(folder)
    return spark.read.schema("run string").json(folder).first()["run"]


def appending(table: SnapshotTable, run: str):
    """A sink that commits each micro-batch once.

    A replayed batch is run through all the same: a state store wants all its partitions committed.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if table.manifest().has(run, batch_id):
            batch.write.format("noop").mode("overwrite").save()
        else:
            table.append(batch, run, batch_id)

    return write


def stream_ingest_dedupe(
    incoming: DataFrame, target: str, checkpoint: str, key: str, order: list[str], buckets: int = ID_BUCKETS
) -> DataFrame:
    """Append only records whose id is new: within a batch, across batches, and across runs.

    Records lie in buckets of the id's digest; a batch reads the ids of its own buckets only.
    """
    spark, run = incoming.sparkSession, run_id(incoming.sparkSession, checkpoint)
    schema = T.StructType([*incoming.schema.fields, T.StructField("id_bucket", T.IntegerType())])
    table = SnapshotTable(spark, target, schema, "id_bucket")

    def append_new(batch: DataFrame, batch_id: int) -> None:
        if table.manifest().has(run, batch_id):
            return  # a replay must not take its own earlier output for stored records
        batch = batch.withColumn("id_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")).persist()
        present = [r["id_bucket"] for r in batch.select("id_bucket").distinct().collect()]  # at most ``buckets``
        earlier = table.read().filter(F.col("id_bucket").isin(present))
        table.append(antijoin_new_ids(batch, earlier.select(key), key, order), run, batch_id)
        batch.unpersist()

    drain(incoming, append_new, checkpoint)
    return table.read().select(*incoming.columns)


def stream_rate_window(
    requests: DataFrame, target: str, checkpoint: str, ts: str, provider: str, limits: dict[str, int]
) -> DataFrame:
    """Requests per provider and minute, as partial counts per micro-batch."""
    window = F.window(F.col(ts).cast("timestamp"), "1 minute")["start"].alias("window_start")
    keys = [window, F.col(provider).alias("provider")]
    schema = T.StructType.fromDDL("window_start timestamp, provider string, requests long")
    table = SnapshotTable(requests.sparkSession, target, schema)
    write = appending(table, run_id(requests.sparkSession, checkpoint))

    def count(batch: DataFrame, batch_id: int) -> None:
        write(batch.filter(F.col(ts).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("requests")), batch_id)

    drain(requests, count, checkpoint)
    total = table.read().groupBy("window_start", "provider").agg(F.sum("requests").alias("requests"))
    return with_limit(total, limits)


def stream_score(
    texts: DataFrame, model: PipelineModel, name: str, target: str, checkpoint: str
) -> DataFrame:
    """Predictions for every text that arrives."""
    predictions = predict_batch(model, name, texts)
    table = SnapshotTable(texts.sparkSession, target, predictions.schema)
    drain(predictions, appending(table, run_id(texts.sparkSession, checkpoint)), checkpoint)
    return table.read()


def stream_drift_monitor(
    scored: DataFrame, target: str, checkpoint: str, ts: str, length: str = "1 day"
) -> DataFrame:
    """Accuracy over time from a stream of judged predictions, as partial counts per micro-batch."""
    window = F.window(F.col(ts).cast("timestamp"), length).alias("w")
    cells = m.outcome_counts(1)
    schema = T.StructType.fromDDL("w struct<start:timestamp,end:timestamp>, " + ", ".join(f"{k} long" for k in cells))
    table = SnapshotTable(scored.sparkSession, target, schema)
    write = appending(table, run_id(scored.sparkSession, checkpoint))

    def count(batch: DataFrame, batch_id: int) -> None:
        counted = batch.filter(F.col(ts).isNotNull()).groupBy(window).agg(*[c.alias(k) for k, c in cells.items()])
        write(counted, batch_id)

    drain(scored, count, checkpoint)
    return m.drift_report(table.read().groupBy("w").agg(*[F.sum(c).alias(c) for c in cells]))
