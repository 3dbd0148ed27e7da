"""Radial kernel machines by random Fourier features.

``exp(-gamma |x - y|^2)`` is the mean of ``cos(w·(x - y))`` over normal ``w``
with variance ``2 gamma``. With ``dimensions`` such directions and random
phases the transformed vectors' inner product estimates the kernel with an
error of about ``1 / sqrt(dimensions)``, so a linear machine on them works like
one with the radial kernel: one pass over the rows, nothing quadratic in them.
The directions follow from the seed alone; workers draw them instead of
receiving them.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@lru_cache(maxsize=4)
def directions(inputs: int, dimensions: int, gamma: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions (inputs x dimensions) and phases; ``gamma`` 0 means 1 / inputs."""
    rng = np.random.default_rng(seed)
    gamma = gamma or 1.0 / max(inputs, 1)
    return rng.normal(scale=np.sqrt(2 * gamma), size=(inputs, dimensions)), rng.uniform(0, 2 * np.pi, dimensions)


def fourier(x: np.ndarray, dimensions: int, gamma: float, seed: int) -> np.ndarray:
    w, phase = directions(x.shape[1], dimensions, gamma, seed)
    out = x @ w  # the one large array: all that follows is done in place
    out += phase
    np.cos(out, out=out)
    out *= np.sqrt(2.0 / dimensions)
    return out


class RandomFourierFeatures(Transformer, HasInputCol, HasOutputCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    """A vector column mapped to random Fourier features of the radial kernel."""

    gamma = Param(Params._dummy(), "gamma", "kernel width exp(-gamma |x-y|^2); 0 means 1 / number of inputs", TypeConverters.toFloat)
    dimensions = Param(Params._dummy(), "dimensions", "number of features", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol: str = "features", outputCol: str = "fourier", gamma: float = 0.0, dimensions: int = 512, seed: int = 42) -> None:
        super().__init__()
        self._setDefault(inputCol="features", outputCol="fourier", gamma=0.0, dimensions=512, seed=42)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        size, gamma, seed = self.getOrDefault(self.dimensions), self.getOrDefault(self.gamma), self.getSeed()

        @F.arrow_udf("array<double>")
        def features(vectors: pa.Array) -> pa.Array:
            if len(vectors) == 0:
                return pa.array([], pa.list_(pa.float64()))
            if vectors.null_count:
                raise ValueError("a vector is null")
            x = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)
            ends = np.arange(0, (len(x) + 1) * size, size, dtype=np.int32)
            # the array's own memory becomes the column: no list of rows, no copy
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(fourier(x, size, gamma, seed).reshape(-1)))

        return dataset.withColumn(self.getOutputCol(), array_to_vector(features(vector_to_array(self.getInputCol()))))
