"""Random Fourier features (Rahimi and Recht 2007): a linear model on them acts as an RBF kernel."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F


class FourierFeatures(
    Transformer, HasInputCol, HasOutputCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable
):
    """Maps a vector to ``size`` cosines of random projections.

    The projections follow from the seed, so the stage saves as its parameters.
    ``gamma`` of 0 means one over the number of inputs, right for scaled inputs.
    """

    size = Param(Params._dummy(), "size", "number of cosines", TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "kernel width", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCol="features", outputCol="curved", size=128, gamma=0.0, seed=42):
        super().__init__()
        self._setDefault(size=128, gamma=0.0, seed=42)
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        size, gamma, seed = self.getOrDefault(self.size), self.getOrDefault(self.gamma), self.getSeed()

        @F.pandas_udf("array<double>")
        def project(vectors: pd.Series) -> pd.Series:
            rows = np.stack(vectors.to_numpy())
            rng = np.random.default_rng(seed)
            width = gamma or 1.0 / rows.shape[1]
            weights = rng.normal(scale=np.sqrt(2 * width), size=(rows.shape[1], size))
            shift = rng.uniform(0, 2 * np.pi, size)
            return pd.Series(list(np.sqrt(2.0 / size) * np.cos(rows @ weights + shift)))

        return df.withColumn(self.getOutputCol(), array_to_vector(project(vector_to_array(self.getInputCol()))))
