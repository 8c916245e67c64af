"""Models made of models: bootstrapped, voting, and quantile interval."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from functools import reduce
from statistics import NormalDist
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.split import resample, subsample
from ..session import held
from .base import Fitted, FittedPipeline, MLlibModel, Model
from .kernel import KernelRegressor
from .linear import GramRegressor
from .neighbours import NeighbourRegressor
from .trees import boosted_trees, decision_tree, leafwise_trees, random_forest, symmetric_trees, without_effect


def mean_of(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.col(c) for c in columns]) / F.lit(float(len(columns)))


_KINDS: dict[str, type[Model]] = {
    "FittedPipeline": MLlibModel,
    "FittedLinear": GramRegressor,
    "FittedKernel": KernelRegressor,
    "FittedNeighbours": NeighbourRegressor,
}


class FittedEnsemble(Fitted):
    """Equal-weight mean; per-member predictions stay available."""

    def __init__(self, members: Sequence[Fitted]):
        self.members = list(members)
        self.features = self.members[0].features

    def transform_all(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        names = [f"{output}_{i}" for i in range(len(self.members))]
        for name, member in zip(names, self.members):
            df = member.transform(df, name)
        return df.withColumn(output, mean_of(names))

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        return self.transform_all(df, output).select(*[c for c in df.columns if c != output], output)

    def save(self, path: str) -> None:
        kinds = [type(m).__name__ for m in self.members]
        spark = SparkSession.active()
        spark.createDataFrame([(json.dumps(kinds),)], "value string").coalesce(1).write.mode("overwrite").text(
            f"{path}/members"
        )
        for i, member in enumerate(self.members):
            member.save(f"{path}/member_{i}")

    @staticmethod
    def restore(spark: SparkSession, path: str) -> "FittedEnsemble":
        kinds = json.loads(spark.read.text(f"{path}/members").first()["value"])
        return FittedEnsemble([_KINDS[k].load(spark, f"{path}/member_{i}") for i, k in enumerate(kinds)])


class BootstrappedRegressor(Model):
    """N models on one row sample that differ in their seed.

    `resample_each` draws a new sample per model (true bagging).
    """

    def __init__(
        self,
        member: Callable[[int], Model],
        n_models: int = 10,
        fraction: float = 0.9,
        replace: bool = False,
        seed: int = 0,
        key: str = "key",
        resample_each: bool = False,
    ):
        self.member, self.n_models, self.fraction = member, n_models, fraction
        self.replace, self.seed, self.key, self.resample_each = replace, seed, key, resample_each

    def _sample(self, df: DataFrame, seed: str) -> DataFrame:
        if not self.replace:
            return subsample(df, self.key, self.fraction, seed)
        drawn = resample(df, self.key, self.fraction, seed)
        # A row drawn c times appears c times, with keys of its own.
        copies = drawn.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        renamed = F.concat_ws("#", F.col(self.key).cast("string"), F.col("_copy").cast("string"))
        return copies.withColumn(self.key, renamed).drop("copies", "_copy")

    def fit(self, df: DataFrame, features: Sequence[str], label: str = "target", weight: str | None = None) -> FittedEnsemble:
        if self.resample_each:
            members = []
            for i in range(self.n_models):
                members.append(self.member(i).fit(self._sample(df, f"{self.seed}:{i}"), features, label, weight))
            return FittedEnsemble(members)
        with held(self._sample(df, str(self.seed))) as sample:
            return FittedEnsemble([self.member(i).fit(sample, features, label, weight) for i in range(self.n_models)])

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FittedEnsemble:
        return FittedEnsemble.restore(spark, path)


def _bootstrap_settings(param: dict[str, Any] | None) -> tuple[dict[str, Any], dict[str, Any]]:
    p = dict(param or {})
    settings = {
        "n_models": int(p.pop("bootstrapped_number_of_models", 10)),
        "fraction": float(p.pop("bootstrapped_fraction", 0.9)),
        "replace": bool(p.pop("bootstrapped_replace", False)),
        "seed": int(p.pop("bootstrapped_random_state", 0) or 0),
        "resample_each": bool(p.pop("resample_each", False)),
    }
    return p, settings


def bootstrapped_trees(param: dict[str, Any] | None = None) -> BootstrappedRegressor:
    p, settings = _bootstrap_settings(param)
    return BootstrappedRegressor(lambda i: boosted_trees({**p, "seed": i}), **settings)


def bootstrapped_kernel(param: dict[str, Any] | None = None) -> BootstrappedRegressor:
    p, settings = _bootstrap_settings(param)
    without_effect(p, {"components", "gamma", "regularisation", "seed", "max_iter"}, set())
    return BootstrappedRegressor(lambda i: KernelRegressor(**{**p, "seed": i}), **settings)


# The settings of the members.
def voting_members(key: str = "key", scale: float = 1.0) -> list[Model]:
    """The ten members of the super learner; `scale` shrinks their tree counts."""

    def rounds(n: int) -> int:
        return max(1, round(n * scale))

    return [
        decision_tree(),
        random_forest({"n_estimators": rounds(10), "random_state": 1}),
        boosted_trees({"num_boost_round": rounds(100), "max_depth": 7, "learning_rate": 0.1, "subsample": 0.7,
                       "colsample_bytree": 0.8, "colsample_bylevel": 1, "gamma": 0, "min_child_weight": 1}),
        boosted_trees({"num_boost_round": rounds(100), "max_depth": 3, "learning_rate": 0.1, "subsample": 1.0,
                       "colsample_bylevel": 1, "gamma": 0, "min_child_weight": 1}),
        leafwise_trees({"num_leaves": 31, "learning_rate": 0.05, "n_estimators": rounds(100)}),
        symmetric_trees({"iterations": rounds(20), "learning_rate": 0.1, "depth": 12}),
        KernelRegressor(),
        NeighbourRegressor(5, key),
        # Bagging: every tree sees all features of a bootstrap sample.
        random_forest({"n_estimators": rounds(100), "max_features": "all"}),
        # Extra trees: all rows, random feature subsets, coarse thresholds.
        random_forest({"n_estimators": rounds(100), "bootstrap": False, "max_features": "onethird", "max_bin": 32}),
    ]


class SuperLearner(Model):
    def __init__(self, members: Sequence[Model] | None = None, key: str = "key"):
        self.members = list(members) if members is not None else voting_members(key)
        self.key = key

    def fit(self, df: DataFrame, features: Sequence[str], label: str = "target", weight: str | None = None) -> FittedEnsemble:
        if weight is not None:
            raise ValueError("the vote cannot use a weight: not all its members can")
        keep = [c for c in (self.key,) if c in df.columns]
        chosen = [*keep, *features, label]
        # A table that the caller holds already is not held twice.
        with held(df if df.columns == chosen else df.select(*chosen)) as table:
            return FittedEnsemble([m.fit(table, features, label) for m in self.members])

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FittedEnsemble:
        return FittedEnsemble.restore(spark, path)


def interval_columns(
    mean: Column, low: Column, high: Column, lower_alpha: float = 0.05, upper_alpha: float = 0.95, interval: float = 0.95
) -> dict[str, Column]:
    """Variance from a quantile gap, and the normal interval around the mean."""
    normal = NormalDist()
    gap = normal.inv_cdf(upper_alpha) - normal.inv_cdf(lower_alpha)
    half = normal.inv_cdf(0.5 + interval / 2)
    deviation = (high - low) / F.lit(gap)
    return {
        "mean": mean,
        "variance": deviation * deviation,
        "lower": mean - F.lit(half) * F.abs(deviation),
        "upper": mean + F.lit(half) * F.abs(deviation),
    }


class FittedQuantile(Fitted):
    def __init__(self, centre: FittedPipeline, tree: FittedPipeline, leaves: DataFrame, alphas: tuple[float, float]):
        self.centre, self.tree, self.leaves, self.alphas = centre, tree, leaves, alphas
        self.features = centre.features

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        return self.centre.transform(df, output)

    def predict_dist(self, df: DataFrame, interval: float = 0.95) -> DataFrame:
        """Adds mean, variance, lower, upper."""
        placed = self.tree.raw(self.centre.transform(df, "_mean"))
        # At most 2**depth leaves.
        joined = placed.join(F.broadcast(self.leaves), "_leaf", "left")
        out = interval_columns(F.col("_mean"), F.col("_low"), F.col("_high"), *self.alphas, interval=interval)
        return joined.select(*df.columns, *[c.alias(n) for n, c in out.items()])

    def save(self, path: str) -> None:
        self.centre.save(f"{path}/centre")
        self.tree.save(f"{path}/tree")
        alphas = [F.lit(a).alias(n) for a, n in zip(self.alphas, ("_lower", "_upper"))]
        self.leaves.select("*", *alphas).write.mode("overwrite").parquet(f"{path}/leaves")


class QuantileIntervalRegressor(Model):
    """Mean from boosted trees, spread from the target quantiles per tree leaf."""

    def __init__(
        self,
        lower_alpha: float = 0.05,
        upper_alpha: float = 0.95,
        n_estimators: int = 100,
        learning_rate: float = 0.1,
        max_depth: int = 3,
        leaf_depth: int = 6,
        accuracy: int = 10_000,
    ):
        self.alphas = (lower_alpha, upper_alpha)
        self.mean_param = {
            "num_boost_round": n_estimators, "learning_rate": learning_rate, "max_depth": max_depth, "gamma": 0,
            "subsample": 1.0, "colsample_bylevel": 1, "min_child_weight": 1,
        }
        if not 0 <= leaf_depth <= 16:
            raise ValueError("leaf_depth must be from 0 to 16: the table of leaves is broadcast")
        self.leaf_depth, self.accuracy = leaf_depth, accuracy

    def fit(self, df: DataFrame, features: Sequence[str], label: str = "target", weight: str | None = None) -> FittedQuantile:
        from pyspark.ml.regression import DecisionTreeRegressor

        centre = boosted_trees(self.mean_param).fit(df, features, label, weight)
        depth = self.leaf_depth
        tree = MLlibModel(
            lambda: DecisionTreeRegressor(maxDepth=depth, maxBins=256, leafCol="_leaf", minInstancesPerNode=20)
        ).fit(df, features, label, weight)
        # Sketch-based percentiles merge before the shuffle, so a crowded leaf is no problem.
        bounds = F.percentile_approx(F.col(label).cast("double"), F.array(*[F.lit(a) for a in self.alphas]), self.accuracy)
        leaves = (
            tree.raw(df.select(*features, label))
            .groupBy("_leaf")
            .agg(bounds.alias("_q"))
            .select("_leaf", F.col("_q")[0].alias("_low"), F.col("_q")[1].alias("_high"))
        )
        table = df.sparkSession.createDataFrame(leaves.collect(), leaves.schema)  # at most 2**depth rows
        return FittedQuantile(centre, tree, table, self.alphas)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FittedQuantile:
        leaves = spark.read.parquet(f"{path}/leaves")
        one = leaves.select("_lower", "_upper").first()
        return FittedQuantile(
            MLlibModel.load(spark, f"{path}/centre"),
            MLlibModel.load(spark, f"{path}/tree"),
            leaves.drop("_lower", "_upper"),
            (one["_lower"], one["_upper"]),
        )
