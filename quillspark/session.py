"""Session set-up and the two places where a job has to look at its own size."""

from __future__ import annotations

import atexit
import contextlib
import gc
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SMALL_TABLE_ROWS = 100_000
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(cores: str = "*", app: str = "quillspark", partitions: int = 8) -> SparkSession:
    """A local session for tests and bench runs; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="quillspark-")
    spark.conf.set("spark.checkpoint.dir", folder)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


_ROOTS: set[str] = set()
_INSIDE: list[str] = []
_INSIDE_LOCK = threading.Lock()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; an application's paths are deleted when its driver ends."""
    root = f"{shared_folder(spark)}/quillspark/{spark.sparkContext.applicationId}"
    if root not in _ROOTS:
        _ROOTS.add(root)
        atexit.register(_drop_at_exit, spark, root)
    return f"{root}/{name}-{uuid.uuid4().hex}"


def _drop_at_exit(spark: SparkSession, root: str) -> None:
    with contextlib.suppress(Exception):  # the gateway may be gone already
        drop_scratch(spark, root)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a result once to the shared folder and read it back, cutting its lineage."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found.stored_path = path
    return found


def drop_stored(df: DataFrame) -> None:
    """Delete what ``stored`` wrote, when no later step reads it."""
    drop_scratch(df.sparkSession, df.stored_path)


def release(spark: SparkSession) -> None:
    """Delete the shuffle files of tables that nothing refers to any more; otherwise they wait for the driver to collect its garbage."""
    gc.collect()
    spark._jvm.System.gc()


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession):
    """Jobs in here delete their shuffle files when they end, as nothing reads them again; may be entered side by side."""
    with _INSIDE_LOCK:
        _INSIDE.append(spark.conf.get(DROP_SHUFFLES, "false"))
        spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        with _INSIDE_LOCK:
            before = _INSIDE.pop()  # the last to leave finds what the first one found
            if not _INSIDE:
                spark.conf.set(DROP_SHUFFLES, before)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a scratch path that no later step reads."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def broadcast_if_small(df: DataFrame, max_rows: int = SMALL_TABLE_ROWS) -> DataFrame:
    """Hand a table back as a broadcast local relation, but only after counting it.

    At most ``max_rows + 1`` rows reach the driver.  A larger table comes back
    untouched and the join that uses it is planned as a shuffled one.
    """
    head = df.limit(max_rows + 1).toArrow()
    if head.num_rows > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(head, schema=df.schema))


def spread(df: DataFrame) -> DataFrame:
    """Use every core for row-wise text work when an input has too few splits.

    A table of many files or row groups already has a split per task and comes
    back untouched; a single small file would otherwise run as one task.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
