"""What the operators share: inputs, scratch tables with an end, even dealing, doc batches."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.session import drop_scratch, shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SMALL_BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


class Scratch:
    """Tables in the shared folder that live as long as the ``with`` block.

    ``keep`` checkpoints a (narrow) result so that it outlives the block.  Jobs inside of the block hand texts and blobs
    to Python in small batches, so that a worker's memory does not follow the rows' sizes.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/quillspark/{name}-{uuid.uuid4().hex}"
        self.before = {k: spark.conf.get(k) for k in SMALL_BATCHES}

    def __enter__(self) -> Scratch:
        for key, value in SMALL_BATCHES.items():
            self.spark.conf.set(key, value)
        return self

    def __exit__(self, *_) -> None:
        for key, value in self.before.items():
            self.spark.conf.set(key, value)
        drop_scratch(self.spark, self.folder)

    def store(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        drop_scratch(self.spark, f"{self.folder}/{name}")

    def keep(self, df: DataFrame) -> DataFrame:
        shared_folder(self.spark)
        return df.checkpoint()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(batch: pa.RecordBatch, column: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """All texts of a batch as one byte array, and where each one starts (with a last end).

    A null text counts as empty.
    """
    column = batch.column(batch.schema.get_field_index(column))
    if pa.types.is_large_string(column.type) or column.null_count:
        column = pa.array([v or "" for v in column.to_pylist()], pa.string())
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], (offsets - offsets[0]).astype(np.int64)


def slices(batch: pa.RecordBatch, max_bytes: int, column: str = "text", max_rows: int = 1 << 16):
    """Cut a batch into runs of rows with about ``max_bytes`` of text, and ``max_rows`` at most, each."""
    _, offsets = text_bytes(batch, column)
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(offsets, offsets[start] + max_bytes, "left"))
        stop = max(start + 1, min(stop, batch.num_rows, start + max_rows))
        yield batch.slice(start, stop - start)
        start = stop


#: One 64-bit constant per byte value, drawn once from a fixed seed.
BYTE_CODES = np.random.default_rng(20240607).integers(0, 2**64, 256, np.uint64)
_BASE = 0x9E3779B97F4A7C15  # odd, so that its powers have inverses modulo 2^64
_INVERSE = pow(_BASE, -1, 2**64)
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^n modulo 2^64, kept between calls."""
    have = _POWERS.get(base)
    if have is None or len(have) <= n:
        size = max(n + 1, 1 << 16)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        _POWERS[base] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser over 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_hashes(codes: np.ndarray) -> np.ndarray:
    """P[i] = sum over j < i of code[j] * base^j modulo 2^64; one longer than its input."""
    out = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * powers(_BASE, len(codes))[: len(codes)], out=out[1:])
    return out


def substring_hashes(prefix: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hashes of [start, stop), equal wherever the content is."""
    back = powers(_INVERSE, len(prefix))
    return (prefix[stop] - prefix[start]) * back[start]


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z, all other byte values as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_spans(data: np.ndarray, offsets: np.ndarray, other: np.ndarray = _SPACE):
    """Starts and stops of maximal runs of bytes that are not in ``other``; none crosses a text's end."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~other[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    first[edges] = inside[edges]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends = offsets[1:][offsets[1:] > 0] - 1
    last[ends] = inside[ends]
    return np.flatnonzero(first), np.flatnonzero(last) + 1
