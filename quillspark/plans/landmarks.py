"""An RBF kernel for linear models by landmarks (Nystroem), chosen by randomly pivoted Cholesky in blocks.

With landmarks L and ``A A' = K(L, L)^-1`` the features of a row are ``phi(x) = k(x, L) A``.  Their products equal the kernel wherever
one of the two rows is a landmark, and never exceed it by length: what a row keeps outside, ``1 - |phi(x)|^2``, is its residual, and
``|k(x, y) - phi(x) phi(y)| <= sqrt(residual(x) residual(y))`` for every pair.  So one pass over the rows bounds the error of all pairs.

Landmarks come in rounds (Chen, Epperly, Tropp and Webber, 2022): each draws rows with chances in proportion to their residuals under the
landmarks before it, as the smallest ``-ln(u) / residual`` with a ``u`` from the row's digest.  A round is one pass over the rows and
brings no more than its landmarks to the driver.

Defined cases: an empty vector is the origin; repeated landmarks are dropped by the rank of their kernel matrix; with fewer distinct
rows than landmarks asked for, rounds end when no residual is left; a table without rows has no landmarks and is refused.
"""

from __future__ import annotations

import base64
import io
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.hashing import order_key

RANK_CUT = 1e-12  # directions of the landmarks' kernel matrix below this share of the largest are left out
NOTHING_LEFT = 1e-9
ROWS_AT_ONCE = 500
_UNIT_DIGITS = 13


# --- kernel and whitening --------------------------------------------------------


def squared(values: np.ndarray) -> float:
    return float(values @ values)


def kernel_rows(indices, values, dense: np.ndarray, gamma: float) -> np.ndarray:
    """Kernel of sparse rows (null indices: all places) with landmarks, whose dense form has a column per landmark."""
    norms = np.einsum("ij,ij->j", dense, dense)
    out = np.zeros((len(values), dense.shape[1]))
    for i, (at, cells) in enumerate(zip(indices, values)):
        product = cells @ (dense if at is None else dense[at])  # only the rows of the terms that are there
        out[i] = squared(cells) + norms - 2 * product
    np.maximum(out, 0, out=out)
    out *= -gamma
    return np.exp(out, out=out)


def pieces(rows: int) -> Iterator[slice]:
    """A batch in pieces: dense kernel rows take far more room than the sparse rows they are made of."""
    return (slice(at, at + ROWS_AT_ONCE) for at in range(0, rows, ROWS_AT_ONCE))


def whitening(kernel: np.ndarray) -> np.ndarray:
    """``A`` with ``A A' = kernel^-1`` on the directions that the landmarks span."""
    lengths, directions = np.linalg.eigh(kernel)
    kept = lengths > RANK_CUT * lengths[-1]
    return directions[:, kept] / np.sqrt(lengths[kept])


def encoded(size: int, rows: list, gamma: float) -> str:
    """Sparse landmarks and their whitening as one text."""
    indices = [np.arange(size) if at is None else np.asarray(at, np.int64) for at, _ in rows]
    values = [np.asarray(v, np.float64) for _, v in rows]
    dense = _dense(size, [len(v) for v in values], np.concatenate(indices), np.concatenate(values))
    made = io.BytesIO()
    np.savez_compressed(
        made, size=size, gamma=gamma, lengths=[len(v) for v in values], indices=np.concatenate(indices).astype(np.int32),
        values=np.concatenate(values), whitening=whitening(kernel_rows(indices, values, dense, gamma)),
    )
    return base64.b64encode(made.getvalue()).decode()


def _dense(size, lengths, indices, values) -> np.ndarray:
    dense = np.zeros((size, len(lengths)))
    dense[indices, np.repeat(np.arange(len(lengths)), lengths)] = values
    return dense


@lru_cache(maxsize=1)  # a job has one machine
def decoded(text: str) -> tuple[np.ndarray, np.ndarray, float]:
    """Dense landmarks (a column each), whitening and kernel width; made once a worker."""
    with np.load(io.BytesIO(base64.b64decode(text))) as held:
        dense = _dense(int(held["size"]), held["lengths"], held["indices"], held["values"])
        return dense, held["whitening"], float(held["gamma"])


# --- the transformer -------------------------------------------------------------


class LandmarkFeatures(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Vectors to their features under fitted landmarks, in Arrow batches."""

    machine = Param(Params._dummy(), "machine", "landmarks and whitening, encoded", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, machine=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def features(self, dataset: DataFrame) -> Column:
        shared = dataset.sparkSession.sparkContext.broadcast(self.getOrDefault(self.machine))  # bounded by the landmarks

        @F.pandas_udf("array<double>")
        def project(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            dense, whiten, gamma = decoded(shared.value)
            for indices, values in batches:
                for part in pieces(len(values)):
                    yield pd.Series(list(kernel_rows(indices.iloc[part], values.iloc[part], dense, gamma) @ whiten))

        raw = F.unwrap_udt(F.col(self.getInputCol()))
        return project(raw["indices"], raw["values"])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getOutputCol(), array_to_vector(self.features(dataset)))

    def residuals(self, dataset: DataFrame) -> DataFrame:
        """Adds ``residual``: the part of the row's own kernel that its features miss."""
        length = F.aggregate("_phi", F.lit(0.0), lambda s, x: s + x * x)
        mapped = dataset.withColumn("_phi", self.features(dataset))
        return mapped.withColumn("residual", F.greatest(F.lit(0.0), 1 - length)).drop("_phi")


def fit_landmarks(
    rows: DataFrame, row_id: str, size: int, gamma: float, count: int = 256, rounds: int = 4, seed: int = 42,
    input_col: str = "features", output_col: str = "mapped",
) -> LandmarkFeatures:
    """``count`` landmarks in ``rounds``; both bound what comes to the driver, whatever the number of rows."""
    chosen, mapper, raw = [], None, F.unwrap_udt(F.col(input_col))
    for step in range(rounds):
        wanted = (count * (step + 1)) // rounds - len(chosen)
        digest = order_key(seed + step, F.col(row_id))
        if mapper is None:
            drawn = rows.orderBy(digest, row_id)
        else:
            unit = (F.conv(F.substring(digest, 1, _UNIT_DIGITS), 16, 10).cast("double") + 1) / float(16**_UNIT_DIGITS)
            left = mapper.residuals(rows).filter(F.col("residual") > NOTHING_LEFT)
            drawn = left.orderBy(-F.log(unit) / F.col("residual"), row_id)
        found = drawn.limit(wanted).select(raw["indices"].alias("at"), raw["values"].alias("cells")).collect()
        if not found:
            break
        chosen += [(r["at"], r["cells"]) for r in found]
        mapper = LandmarkFeatures(inputCol=input_col, outputCol=output_col, machine=encoded(size, chosen, gamma))
    if mapper is None:
        raise ValueError("no rows to take landmarks from")
    return mapper


def kernel_map_error(mapper: LandmarkFeatures, rows: DataFrame) -> DataFrame:
    """One row: ``n_rows``, the mean residual, and the largest, which bounds the kernel's error over all pairs."""
    residual = F.col("residual")
    return mapper.residuals(rows).agg(
        F.count(residual).alias("n_rows"), F.avg(residual).alias("mean_residual"), F.max(residual).alias("largest_error")
    )
