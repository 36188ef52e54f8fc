"""Documents as compressed blocks with numbered places, for work that returns to texts several times.

A block holds up to 2 MB of texts (or one longer text) and the columns asked for, as one compressed Arrow batch.  Blocks
are written once; later steps name a document by its handle (block number and place) and get back to
its text by a join on the block number.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

from quillspark.llm.common import slices

PLACE_BITS = 16


def as_blocks(docs: DataFrame, columns: list[str], max_bytes: int = 2 << 20) -> DataFrame:
    """``block, payload`` rows; number them for good by writing them down."""

    def build(batches):
        compress = zstandard.ZstdCompressor(level=3).compress
        number = TaskContext.get().partitionId() << 20
        for whole in batches:
            for part in slices(whole, max_bytes, max_rows=1 << PLACE_BITS):
                payload = compress(serialised(part))
                yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([payload], pa.binary())], names=["block", "payload"])
                number += 1

    return docs.select(*columns).mapInArrow(build, "block long, payload binary")


def serialised(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def block_rows(payload: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(payload)) as reader:
        return next(iter(reader))


def pack_columns(**columns: np.ndarray) -> bytes:
    """Columns as bytes, the lowest byte of all values first; zero bytes vanish in the compression."""
    n = len(next(iter(columns.values())))
    planes = [np.ascontiguousarray(c.astype("<i8" if c.dtype != np.uint64 else "<u8")).view(np.uint8).reshape(n, 8).T.tobytes() for c in columns.values()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack_columns(blobs: list[bytes], kinds: str) -> list[np.ndarray]:
    """The columns of all blobs; a ``u`` is unsigned, an ``i`` signed."""
    columns = [[] for _ in kinds]
    for blob in blobs:
        raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
        n = len(raw) // (8 * len(kinds))
        for k, kind in enumerate(kinds):
            plane = raw[8 * n * k : 8 * n * (k + 1)].reshape(8, n).T
            columns[k].append(np.ascontiguousarray(plane).view(f"<{kind}8").ravel())
    return [np.concatenate(c) if c else np.zeros(0, f"<{kind}8") for c, kind in zip(columns, kinds)]


def dealt(part: np.ndarray, kind: str, **columns: np.ndarray):
    """Rows (kind, key, blob), one for each value of ``part``."""
    order = np.argsort(part, kind="stable")
    keys, first = np.unique(part[order], return_index=True)
    edges = np.append(first, len(part))
    for low in range(0, len(keys), 256):
        some = range(low, min(low + 256, len(keys)))
        blobs = [pack_columns(**{n: c[order[edges[i] : edges[i + 1]]] for n, c in columns.items()}) for i in some]
        yield pa.RecordBatch.from_arrays(
            [pa.array([kind] * len(blobs)), pa.array(keys[list(some)].astype(np.int64)), pa.array(blobs, pa.binary())],
            names=["kind", "key", "blob"],
        )
