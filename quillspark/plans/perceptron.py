"""A multilayer perceptron with rectified units, fitted by data-parallel mini-batch Adam with early stopping.

Rows are dealt into shards by their id's digest and packed once; an epoch is a few steps, each over its own shards.  In a step every
task adds up the gradient of its shards, pieces of the gradients are added up by the shuffle, and the driver, which holds nothing but the
weights, takes one Adam step.  A tenth of the rows, both classes in proportion, is never fitted on: its accuracy is measured
beside the next epoch's first step, and the weights that did best there are the model.

Every shard's gradient is rounded to multiples of 2^-40 before it is added up.  Such sums are exact, so the result does not depend on the
order in which tasks end, and a lost task that runs again changes nothing.
"""

from __future__ import annotations

import base64
import math
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.session import shuffles_dropped

SHARD_ROWS = 256  # rows multiplied at once; a fit of many rows has larger shards, so that there are some ``MOST_SHARDS``
LARGEST_SHARD = 2048
MOST_SHARDS = 1024
SHARDS_PER_TASK = 16
BATCH_ROWS = 200
MOST_STEPS = 4  # of an epoch: batches grow with the data, the number of jobs does not
PIECE = 1 << 14
GRID = 2.0**40
BETA_1, BETA_2, EPSILON = 0.9, 0.999, 1e-8
_SHARD = "shard int, held_out boolean, n int, labels binary, lengths binary, indices binary, vals binary"


# --- weights and gradients -------------------------------------------------------


def weight_count(layers: list[int]) -> int:
    return sum((a + 1) * b for a, b in zip(layers, layers[1:]))


def unpacked(weights: np.ndarray, layers: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per layer the matrix (a row per input) and the offsets, as views of the flat array."""
    out, at = [], 0
    for a, b in zip(layers, layers[1:]):
        out.append((weights[at : at + a * b].reshape(a, b), weights[at + a * b : at + (a + 1) * b]))
        at += (a + 1) * b
    return out


def initial_weights(layers: list[int], seed: int) -> np.ndarray:
    """Uniform within ``sqrt(6 / (inputs + outputs))`` of zero."""
    rng = np.random.default_rng(seed)
    weights = np.zeros(weight_count(layers))
    for (matrix, offsets), a, b in zip(unpacked(weights, layers), layers, layers[1:]):
        bound = math.sqrt(6 / (a + b))
        matrix[:] = rng.uniform(-bound, bound, matrix.shape)
        offsets[:] = rng.uniform(-bound, bound, b)
    return weights


def dense_part(lengths: np.ndarray, indices: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The features that occur in some row, and the rows over these features alone."""
    present = np.flatnonzero(np.bincount(indices))
    place = np.zeros(int(present[-1]) + 1 if len(present) else 0, np.int64)
    place[present] = np.arange(len(present))
    rows = np.zeros((len(lengths), len(present)))
    rows[np.repeat(np.arange(len(lengths)), lengths), place[indices]] = values
    return present, rows


def forward(weights, layers, lengths, indices, values):
    """The probability of class 1 per row, and the units of all layers on the way."""
    parts = unpacked(weights, layers)
    present, rows = dense_part(lengths, indices, values)
    units = [rows]
    for k, (matrix, offsets) in enumerate(parts):
        total = units[-1] @ (matrix[present] if k == 0 else matrix) + offsets
        units.append(np.maximum(total, 0) if k < len(parts) - 1 else total)
    return 1 / (1 + np.exp(-np.clip(units[-1][:, 0], -500, 500))), units, present


def loss_gradient(weights, layers, labels, lengths, indices, values) -> tuple[float, np.ndarray]:
    """Log loss and its gradient, summed over the rows; the penalty is not in it."""
    p, units, present = forward(weights, layers, lengths, indices, values)
    out = np.zeros(len(weights))
    parts, parts_out = unpacked(weights, layers), unpacked(out, layers)
    back = (p - labels)[:, None]
    for k in range(len(parts) - 1, -1, -1):
        matrix, offsets = parts_out[k]
        if k == 0:
            matrix[present] = units[0].T @ back
        else:
            matrix[:] = units[k].T @ back
        offsets[:] = back.sum(axis=0)
        if k:
            back = (back @ parts[k][0].T) * (units[k] > 0)
    safe = np.clip(np.where(labels > 0, p, 1 - p), 1e-300, 1)
    return float(-np.log(safe).sum()), out


class Adam:
    def __init__(self, size: int, rate: float):
        self.rate, self.steps = rate, 0
        self.mean, self.square = np.zeros(size), np.zeros(size)

    def step(self, weights: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        self.steps += 1
        self.mean += (1 - BETA_1) * (gradient - self.mean)
        self.square += (1 - BETA_2) * (gradient**2 - self.square)
        mean, square = self.mean / (1 - BETA_1**self.steps), self.square / (1 - BETA_2**self.steps)
        return weights - self.rate * mean / (np.sqrt(square) + EPSILON)


# --- shards ----------------------------------------------------------------------


def packed_shards(rows: DataFrame, row_id: str, held_out, n_rows: int, size: int) -> DataFrame:
    """``rows (row_id, label, features)`` packed by the digest of their ids, held-out rows apart.

    A step sums one gradient a task, so there are no more tasks than cores: what a step moves does not grow with the rows.
    """
    shards = n_rows // min(max(SHARD_ROWS, n_rows // MOST_SHARDS), LARGEST_SHARD) + 1
    raw = F.unwrap_udt(F.col("features"))
    dealt = rows.select(
        F.pmod(F.xxhash64(F.col(row_id).cast("string")), F.lit(shards)).cast("int").alias("shard"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.col(row_id).cast("string").alias("row"),
        F.col("label").cast("double").alias("label"),
        F.coalesce(raw["indices"], F.sequence(F.lit(0), F.lit(size - 1))).alias("indices"),
        raw["values"].alias("vals"),
    )

    def pack(key, table: pa.Table) -> pa.Table:
        table = table.sort_by("row").combine_chunks()
        lists = [table.column(c).combine_chunks() for c in ("indices", "vals")]
        lists = [a.chunk(0) if isinstance(a, pa.ChunkedArray) else a for a in lists]
        flat = [a.flatten().to_numpy(zero_copy_only=False) for a in lists]
        lengths = lists[1].value_lengths().to_numpy().astype(np.int32)
        made = [table.column("label").to_numpy(), lengths, flat[0].astype(np.int32), flat[1].astype(np.float64)]
        head = [pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()]), pa.array([table.num_rows], pa.int32())]
        return pa.table([*head, *(pa.array([a.tobytes()], pa.binary()) for a in made)], names=["shard", "held_out", "n", "labels", "lengths", "indices", "vals"])

    packed = dealt.groupBy("shard", "held_out").applyInArrow(lambda key, table: pack(key, table), _SHARD)
    return packed.coalesce(min(-(-shards // SHARDS_PER_TASK), rows.sparkSession.sparkContext.defaultParallelism))


def _arrays(batch: pa.RecordBatch):
    for labels, lengths, indices, values in zip(*(batch.column(c).to_pylist() for c in ("labels", "lengths", "indices", "vals"))):
        yield np.frombuffer(labels), np.frombuffer(lengths, np.int32), np.frombuffer(indices, np.int32), np.frombuffer(values)


def step_sums(shards: DataFrame, weights: np.ndarray, layers: list[int], n: int) -> tuple[np.ndarray, float, int]:
    """Mean gradient over the fitted shards' ``n`` rows, their mean loss, and how many held-out rows are judged rightly."""
    shared = shards.sparkSession.sparkContext.broadcast(weights)

    def work(batches):
        total, right, met = np.zeros(len(shared.value) + 1), 0, False
        for batch in batches:
            for held_out, arrays in zip(batch.column("held_out").to_pylist(), _arrays(batch)):
                if held_out:
                    p, _, _ = forward(shared.value, layers, *arrays[1:])
                    right += int(((p > 0.5) == (arrays[0] > 0.5)).sum())
                else:
                    loss, gradient = loss_gradient(shared.value, layers, *arrays)
                    total += np.round(np.append(gradient, loss) / max(n, 1) * GRID) / GRID
                    met = True
        cells = total if met else total[:0]
        pieces = [cells[low : low + PIECE] for low in range(0, len(cells), PIECE)]
        rows = [(k, piece) for k, piece in enumerate(pieces)] + ([(-1, np.array([float(right)]))] if right else [])
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in rows], pa.int32()), pa.array([p for _, p in rows], pa.list_(pa.float64()))], names=["piece", "cells"]
            )

    parts = shards.mapInArrow(work, "piece int, cells array<double>")
    met = parts.groupBy("piece").agg(F.collect_list("cells").alias("all"))  # a short piece of each task
    added = F.reduce(F.slice("all", 2, F.size("all")), F.col("all")[0], lambda x, y: F.zip_with(x, y, lambda a, b: a + b))
    sums = met.select("piece", added.alias("cells")).toArrow()  # as long as the weights
    shared.destroy()
    found = {k: cells.values.to_numpy() for k, cells in zip(sums["piece"].to_pylist(), sums["cells"])}
    whole = np.concatenate([found[k] for k in sorted(found) if k >= 0] or [np.zeros(len(weights) + 1)])
    return whole[:-1], float(whole[-1]), int(found.get(-1, [0])[0])


def penalised(gradient: np.ndarray, weights: np.ndarray, layers: list[int], alpha: float, n: int) -> np.ndarray:
    """Adds the gradient of ``alpha / 2n`` times the squared matrix weights; offsets are free."""
    out = gradient.copy()
    for (matrix, _), (own, _) in zip(unpacked(out, layers), unpacked(weights, layers)):
        matrix += alpha / max(n, 1) * own
    return out


# --- fitting ---------------------------------------------------------------------


def fit_perceptron(
    rows: DataFrame,
    size: int,
    row_id: str,
    held_out,
    hidden: tuple = (100, 50),
    alpha: float = 0.01,
    rate: float = 0.001,
    max_iter: int = 300,
    patience: int = 10,
    tolerance: float = 1e-4,
    seed: int = 42,
    batch_rows: int = BATCH_ROWS,
    most_steps: int = MOST_STEPS,
) -> PerceptronModel:
    """``held_out`` is a boolean column of ``rows``; without such rows all epochs run."""
    layers = [size, *hidden, 1]
    shards = packed_shards(rows, row_id, held_out, rows.count(), size).persist(StorageLevel.MEMORY_AND_DISK)
    counted = {r["shard"]: r for r in shards.groupBy("shard").agg(
        F.coalesce(F.sum(F.when(~F.col("held_out"), F.col("n"))), F.lit(0)).alias("fitted"),
        F.coalesce(F.sum(F.when(F.col("held_out"), F.col("n"))), F.lit(0)).alias("judged"),
    ).collect()}  # a row per ``SHARD_ROWS`` rows
    order = sorted(counted)
    n_fitted, n_judged = (sum(r[c] for r in counted.values()) for c in ("fitted", "judged"))
    steps = max(1, min(most_steps, n_fitted // max(1, batch_rows), len(order)))
    weights, adam = initial_weights(layers, seed), Adam(weight_count(layers), rate)
    best, best_right, waited, history = weights, -1.0, 0, []
    rng = np.random.default_rng(seed)
    spark = rows.sparkSession
    for epoch in range(max_iter + 1):
        dealt = np.array_split(rng.permutation(len(order)), steps)
        start = weights
        for step, some in enumerate(dealt):
            mine = [order[i] for i in some]
            n = sum(counted[s]["fitted"] for s in mine)
            wanted = F.col("shard").isin(mine) & ~F.col("held_out")
            with shuffles_dropped(spark):  # a step moves the weights once a task
                gradient, loss, right = step_sums(shards.filter(wanted | F.col("held_out") if step == 0 else wanted), weights, layers, n)
            if step == 0 and epoch and n_judged:
                share = right / n_judged
                history.append(share)
                waited = waited + 1 if share < best_right + tolerance else 0
                if share > best_right:
                    best, best_right = start, share
                if waited > patience:
                    break
            if epoch == max_iter:
                break  # this epoch only judges the last one
            weights = adam.step(weights, penalised(gradient, weights, layers, alpha, n))
        else:
            continue
        break
    shards.unpersist()
    return PerceptronModel(inputCol="features", layers=layers, weights=encoded(best if history else weights), history=history)


def encoded(weights: np.ndarray) -> str:
    return base64.b64encode(weights.astype("<f4").tobytes()).decode()


@lru_cache(maxsize=4)
def decoded(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), "<f4").astype(np.float64)


class PerceptronModel(Transformer, HasInputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``probability`` of both classes and ``prediction``; weights are single precision."""

    layers = Param(Params._dummy(), "layers", "units per layer", TypeConverters.toListInt)
    weights = Param(Params._dummy(), "weights", "all weights, encoded", TypeConverters.toString)
    history = Param(Params._dummy(), "history", "accuracy on held-out rows after each epoch", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCol=None, layers=None, weights=None, history=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        layers = self.getOrDefault(self.layers)
        shared = dataset.sparkSession.sparkContext.broadcast(self.getOrDefault(self.weights))

        @F.pandas_udf("double")
        def judge(indices: pd.Series, values: pd.Series) -> pd.Series:
            weights, out = decoded(shared.value), np.zeros(len(values))
            for low in range(0, len(values), SHARD_ROWS):
                some = slice(low, low + SHARD_ROWS)
                at = [np.arange(layers[0]) if i is None else i for i in indices[some]]
                lengths = np.array([len(i) for i in at], np.int64)
                flat = [np.concatenate([np.zeros(0), *x]) for x in (at, list(values[some]))]
                out[some] = forward(weights, layers, lengths, flat[0].astype(np.int64), flat[1])[0]
            return pd.Series(out)

        raw = F.unwrap_udt(F.col(self.getInputCol()))
        judged = dataset.withColumn("_p", judge(raw["indices"], raw["values"]))
        both = array_to_vector(F.array(1 - F.col("_p"), F.col("_p")))
        return judged.withColumn("probability", both).withColumn("prediction", (F.col("_p") > 0.5).cast("double")).drop("_p")
