"""Nearest-neighbour mean as a model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.neighbours import with_nearest_mean
from ..session import cut_lineage
from .base import Fitted, Model


class FittedNeighbours(Fitted):
    def __init__(self, features: Sequence[str], table: DataFrame, k: int, key: str):
        self.features, self.table, self.k, self.key = list(features), table, k, key

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        if self.key not in df.columns:
            raise ValueError(f"nearest neighbours need a row key column {self.key!r}")
        return with_nearest_mean(df, self.table, self.features, self.k, self.key, "_label", output)

    def save(self, path: str) -> None:
        columns = [F.lit(self.k).alias("_k"), F.lit(self.key).alias("_key")]
        self.table.select("*", *columns).write.mode("overwrite").parquet(path)


class NeighbourRegressor(Model):
    iterative = False

    def __init__(self, k: int = 5, key: str = "key"):
        self.k, self.key = k, key

    def fit(self, df: DataFrame, features: Sequence[str], label: str = "target", weight: str | None = None) -> FittedNeighbours:
        if weight is not None:
            raise ValueError("nearest neighbours cannot use a weight")
        # Read by every search, when a table held for the fit is gone.
        table = cut_lineage(df.select(self.key, *features, F.col(label).cast("double").alias("_label")))
        return FittedNeighbours(features, table, self.k, self.key)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FittedNeighbours:
        table = spark.read.parquet(path)
        one = table.select("_k", "_key").first()
        table = table.drop("_k", "_key")
        features = [c for c in table.columns if c not in (one["_key"], "_label")]
        return FittedNeighbours(features, table, one["_k"], one["_key"])
