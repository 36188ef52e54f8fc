"""Random Fourier features: an RBF kernel for linear models (Rahimi & Recht, 2007)."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


PROJECTED_ROWS = 256  # rows multiplied at once; their dense form is the largest array


@lru_cache(maxsize=4)
def directions(seed: int, size: int, count: int, gamma: float) -> tuple[np.ndarray, np.ndarray]:
    """The projection is a function of its seed, so workers draw it instead of receiving it."""
    rng = np.random.default_rng(seed)
    return (
        rng.standard_normal((size, count)) * np.sqrt(2 * gamma),
        rng.uniform(0, 2 * np.pi, count),
    )


class RandomFourierFeatures(
    Transformer, HasInputCol, HasOutputCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable
):
    """Sparse vectors of ``inputSize`` to ``numFeatures`` dense cosines, in Arrow batches."""

    gamma = Param(Params._dummy(), "gamma", "kernel width", TypeConverters.toFloat)
    inputSize = Param(Params._dummy(), "inputSize", "length of the input", TypeConverters.toInt)
    numFeatures = Param(Params._dummy(), "numFeatures", "length of the output", TypeConverters.toInt)

    @keyword_only
    def __init__(
        self, *, inputCol=None, outputCol=None, gamma=1.0, inputSize=1, numFeatures=256, seed=42
    ):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        seed, size = self.getSeed(), self.getOrDefault(self.inputSize)
        count, gamma = self.getOrDefault(self.numFeatures), self.getOrDefault(self.gamma)

        @F.pandas_udf("array<double>")
        def project(indices: pd.Series, values: pd.Series) -> pd.Series:
            weights, shift = directions(seed, size, count, gamma)
            out = np.zeros((len(values), count))
            for low in range(0, len(values), PROJECTED_ROWS):
                some = slice(low, low + PROJECTED_ROWS)
                at = [np.arange(size) if i is None else i for i in indices[some]]
                lengths = np.array([len(i) for i in at], np.int64)
                row = np.repeat(np.arange(len(at)), lengths)
                dense = np.zeros((len(at), size))
                if len(row):
                    dense[row, np.concatenate(at).astype(np.int64)] = np.concatenate(list(values[some]))
                out[some] = np.sqrt(2 / count) * np.cos(dense @ weights + shift)
            return pd.Series(list(out))

        raw = F.unwrap_udt(F.col(self.getInputCol()))
        return dataset.withColumn(
            self.getOutputCol(), array_to_vector(project(raw["indices"], raw["values"]))
        )
