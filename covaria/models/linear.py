"""Least-squares model from one aggregation."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.gram import LinearFit, Moments, fit_moments, moments
from .base import Fitted, Model


class FittedLinear(Fitted):
    def __init__(self, features: Sequence[str], fit: LinearFit):
        self.features = list(features)
        self.fit = fit

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        return df.withColumn(output, self.fit.expression(self.features))

    def predict_array(self, x: np.ndarray) -> np.ndarray:
        """Predictions for rows of feature values."""
        return x @ np.asarray(self.fit.weights, float) + self.fit.intercept

    def weights_table(self, spark: SparkSession) -> DataFrame:
        rows = [(i, f, float(w)) for i, (f, w) in enumerate(zip(self.features, self.fit.weights))]
        rows.append((len(rows), None, float(self.fit.intercept)))
        return spark.createDataFrame(rows, "position int, feature string, weight double")

    def save(self, path: str) -> None:
        self.weights_table(SparkSession.active()).coalesce(1).write.mode("overwrite").parquet(path)

    def importance(self, spark: SparkSession) -> DataFrame:
        return (
            self.weights_table(spark)
            .filter(F.col("feature").isNotNull())
            .select("feature", F.abs("weight").alias("score"))
            .orderBy(F.desc("score"), "feature")
        )


class GramRegressor(Model):
    def __init__(self, ridge: float = 0.0):
        self.ridge = ridge

    def fit(self, df: DataFrame, features: Sequence[str], label: str = "target", weight: str | None = None) -> FittedLinear:
        return self.solved(moments(df, features, label, weight=weight), features)

    def solved(self, sums: dict[int, Moments], features: Sequence[str]) -> FittedLinear:
        """The model of rows whose sums are known."""
        if not sums:
            raise ValueError("no rows to fit")
        return FittedLinear(features, fit_moments(sums[0], self.ridge))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FittedLinear:
        # One row per feature.
        rows = spark.read.parquet(path).orderBy("position").collect()
        weights = np.array([r["weight"] for r in rows if r["feature"] is not None])
        features = [r["feature"] for r in rows if r["feature"] is not None]
        (intercept,) = [r["weight"] for r in rows if r["feature"] is None]
        return FittedLinear(features, LinearFit(weights, intercept))
