"""Support-vector style regression with a Gaussian kernel.

The kernel is approximated by random cosine features, which are plain column
expressions, and the tube loss by the Huber loss of MLlib.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .base import Fitted, Model

_META = "basis"
_MODEL = "linear"


def _cosines(features: Sequence[str], waves: np.ndarray, phases: np.ndarray) -> Column:
    scale = math.sqrt(2.0 / len(phases))
    inputs = [F.col(f).cast("double") for f in features]
    out = []
    for wave, phase in zip(waves, phases):
        angle: Column = F.lit(float(phase))
        for x, w in zip(inputs, wave):
            angle = angle + x * F.lit(float(w))
        out.append(F.cos(angle) * F.lit(scale))
    return array_to_vector(F.array(*out))


class FittedKernel(Fitted):
    def __init__(self, features: Sequence[str], waves: np.ndarray, phases: np.ndarray, model: LinearRegressionModel):
        self.features = list(features)
        self.waves, self.phases, self.model = waves, phases, model

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        out = self.model.transform(df.withColumn("_cosines", _cosines(self.features, self.waves, self.phases)))
        return out.select(*[c for c in df.columns if c != output], F.col("_prediction").alias(output))

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        rows = [(i, w.tolist(), float(p)) for i, (w, p) in enumerate(zip(self.waves, self.phases))]
        basis = spark.createDataFrame(rows, "position int, wave array<double>, phase double")
        basis = basis.withColumn("features", F.array(*[F.lit(f) for f in self.features]))
        basis.coalesce(1).write.mode("overwrite").parquet(f"{path}/{_META}")
        self.model.write().overwrite().save(f"{path}/{_MODEL}")


class KernelRegressor(Model):
    def __init__(self, components: int = 64, gamma: float | None = None, regularisation: float = 1e-4, seed: int = 0,
                 max_iter: int = 50):
        self.components, self.gamma = components, gamma
        self.regularisation, self.seed, self.max_iter = regularisation, seed, max_iter

    def _gamma(self, df: DataFrame, features: Sequence[str]) -> float:
        """1 / (p * variance over all feature values), from one aggregation."""
        if self.gamma is not None:
            return self.gamma
        cols = [F.col(f).cast("double") for f in features]
        row = df.agg(
            *[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
            *[F.var_pop(c).alias(f"v{i}") for i, c in enumerate(cols)],
        ).first()
        means = np.array([row[f"m{i}"] for i in range(len(cols))])
        spread = float(np.mean([row[f"v{i}"] for i in range(len(cols))]) + means.var())
        return 1.0 / (len(cols) * spread) if spread > 0 else 1.0

    def fit(self, df: DataFrame, features: Sequence[str], label: str = "target", weight: str | None = None) -> FittedKernel:
        gamma = self._gamma(df, features)
        random = np.random.default_rng(self.seed)
        waves = random.normal(0.0, math.sqrt(2 * gamma), (self.components, len(features)))
        phases = random.uniform(0.0, 2 * math.pi, self.components)
        table = df.select(
            _cosines(features, waves, phases).alias("_cosines"),
            F.col(label).cast("double").alias("_label"),
            *([F.col(weight).cast("double").alias("_weight")] if weight else []),
        )
        estimator = LinearRegression(
            featuresCol="_cosines", labelCol="_label", predictionCol="_prediction", loss="huber",
            regParam=self.regularisation, maxIter=self.max_iter,
        )
        if weight:
            estimator = estimator.setWeightCol("_weight")
        return FittedKernel(features, waves, phases, estimator.fit(table))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FittedKernel:
        # One row per cosine component.
        rows = spark.read.parquet(f"{path}/{_META}").orderBy("position").collect()
        return FittedKernel(
            rows[0]["features"],
            np.array([r["wave"] for r in rows]),
            np.array([r["phase"] for r in rows]),
            LinearRegressionModel.load(f"{path}/{_MODEL}"),
        )
