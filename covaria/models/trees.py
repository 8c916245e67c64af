"""Tree models on MLlib, configured with the usual booster parameter names."""

from __future__ import annotations

import math
from typing import Any

from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor

from .base import MLlibModel

# Default parameters of the boosted-tree model.  Those without
# an MLlib twin are accepted and have no effect.
BOOSTER_DEFAULTS: dict[str, Any] = {
    "booster": "gbtree",
    "learning_rate": 0.3,
    "gamma": 0.11,
    "max_depth": 13,
    "min_child_weight": 4,
    "max_delta_step": 3,
    "subsample": 0.65,
    "colsample_bytree": 1,
    "colsample_bylevel": 0.45,
    "colsample_bynode": 1,
    "lambda": 1,
    "alpha": 0,
    "tree_method": "hist",
    "max_leaves": 0,
    "max_bin": 256,
    "num_parallel_tree": 1,
    "objective": "reg:squarederror",
    "seed": 0,
    "num_boost_round": 500,
    "base_score": 0.5,
}

# Default parameters of the symmetric-tree model.
SYMMETRIC_DEFAULTS: dict[str, Any] = {
    "learning_rate": 0.1,
    "random_seed": 0,
    "depth": 15,
    "max_bin": 255,
    "iterations": 100,
}

# Search ranges [low, high] (or options) declared by the models.
BOOSTER_SPACE: dict[str, list[Any]] = {
    "learning_rate": [0.01, 0.1],
    "gamma": [0, 1],
    "max_depth": [3, 25],
    "min_child_weight": [0, 1],
    "max_delta_step": [0, 1],
    "subsample": [0, 1],
    "colsample_bytree": [0, 1],
    "colsample_bylevel": [0, 1],
    "colsample_bynode": [0, 1],
    "lambda": [0.8, 1],
    "alpha": [0, 0.1],
    "sketch_eps": [0.01, 0.05],
    "scale_pos_weight": [0.1, 0],
    "max_bin": [256, 500],
    "num_boost_round": [300, 900],
    "base_score": [0.2, 0.7],
}
SYMMETRIC_SPACE: dict[str, list[Any]] = {
    "num_boost_round": [20, 1000],
    "learning_rate": [0.01, 10],
    "random_seed": [0],
    "depth": [4, 6, 10],
    "l2_leaf_reg": [1, 3, 5, 7, 9],
    "random_strength": [0, 10],
    "bagging_temperature": [0, 50],
    "max_bin": [128, 255],
    "grow_policy": ["SymmetricTree", "Depthwise", "Lossguide"],
    "min_child_samples": [0, 100],
    "early_stopping_rounds": [20, 50],
}

# Names of settings that have no meaning here.
MACHINE = {"n_jobs", "nthread", "verbosity", "verbose", "device", "eval_metric", "objective", "random_state"}

# Limit of the MLlib tree format, and the least share of rows or features for a tree.
MAX_DEPTH = 30
SMALLEST_SHARE = 1e-3
# What a model of MLlib makes use of; other names that the declared defaults or spaces have are known but have no twin.
BOOSTER_USED = {
    "learning_rate", "max_depth", "max_bin", "num_boost_round", "gamma", "min_child_weight", "subsample", "colsample_bytree",
    "colsample_bylevel", "colsample_bynode", "seed",
}
SYMMETRIC_USED = {"iterations", "num_boost_round", "learning_rate", "depth", "max_bin", "min_child_samples", "random_seed"}


def without_effect(param: dict[str, Any] | None, used: set[str], known: set[str]) -> list[str]:
    """Names of `param` that have no effect here; unknown names are an error."""
    unknown = sorted(set(param or {}) - used - known)
    if unknown:
        raise ValueError(f"unknown parameters {unknown}; known: {sorted(used | known)}")
    return sorted(set(param or {}) - used)



def _bounded(name: str, value: float, low: float, high: float) -> float:
    """Values that MLlib cannot take are refused: a moved value would make different trials the same."""
    if not low <= value <= high:
        raise ValueError(f"{name}={value} is outside {low} to {high}, the range of MLlib")
    return value


def _fraction(name: str, value: float) -> float:
    return _bounded(name, float(value), SMALLEST_SHARE, 1.0)


def _depth(value: Any) -> int:
    return int(_bounded("max_depth", int(value), 0, MAX_DEPTH))


def boosted_trees(param: dict[str, Any] | None = None) -> MLlibModel:
    unused = without_effect(param, BOOSTER_USED, {*BOOSTER_DEFAULTS, *BOOSTER_SPACE} | MACHINE)
    p = {**BOOSTER_DEFAULTS, **(param or {})}
    columns = math.prod(_fraction(f"colsample_by{k}", p[f"colsample_by{k}"]) for k in ("tree", "level", "node"))

    def build() -> GBTRegressor:
        return GBTRegressor(
            maxIter=max(1, int(p["num_boost_round"] or 100)),
            stepSize=_fraction("learning_rate", p["learning_rate"] or 0.3),
            maxDepth=_depth(p["max_depth"] or 6),
            maxBins=max(2, int(p["max_bin"] or 256)),
            subsamplingRate=_fraction("subsample", p["subsample"]),
            featureSubsetStrategy="all" if columns >= 1 else str(max(SMALLEST_SHARE, columns)),
            minInstancesPerNode=max(1, math.ceil(float(p["min_child_weight"]))),
            minInfoGain=max(0.0, float(p["gamma"] or 0)),
            seed=int(p["seed"]),
        )

    return MLlibModel(build, unused)


def symmetric_trees(param: dict[str, Any] | None = None) -> MLlibModel:
    unused = without_effect(param, SYMMETRIC_USED, {*SYMMETRIC_DEFAULTS, *SYMMETRIC_SPACE} | MACHINE)
    # Without parameters: the defaults above.  With some: the library's own.
    p = dict(SYMMETRIC_DEFAULTS) if not param else {"depth": 6, "learning_rate": 0.03, "max_bin": 254, **param}
    rounds = p.get("iterations") or p.get("num_boost_round") or 1000

    def build() -> GBTRegressor:
        return GBTRegressor(
            maxIter=max(1, int(rounds)),
            stepSize=_fraction("learning_rate", p["learning_rate"]),
            maxDepth=_depth(p["depth"]),
            maxBins=max(2, int(p["max_bin"])),
            minInstancesPerNode=max(1, int(p.get("min_child_samples", 1))),
            seed=int(p.get("random_seed", 0)),
        )

    return MLlibModel(build, unused)


def leafwise_trees(param: dict[str, Any] | None = None) -> MLlibModel:
    """Same booster; a leaf budget becomes the depth that can hold it."""
    p = dict(param or {})
    leaves, rounds = p.pop("num_leaves", None), p.pop("n_estimators", None)
    if leaves is not None and "max_depth" not in p:
        p["max_depth"] = max(1, math.ceil(math.log2(leaves)))
    if rounds is not None and "num_boost_round" not in p:
        p["num_boost_round"] = rounds
    base = {"subsample": 1.0, "colsample_bylevel": 1.0, "gamma": 0.0, "num_boost_round": 100, "learning_rate": 0.1, "max_depth": 5}
    return boosted_trees({**base, **p})


def random_forest(param: dict[str, Any] | None = None) -> MLlibModel:
    used = {"n_estimators": 100, "max_depth": 10, "max_bin": 256, "random_state": 0, "subsample": 1.0, "max_features": "all", "bootstrap": True}
    unused = without_effect(param, set(used), {*MACHINE, "criterion", "oob_score"})
    p = {**used, **(param or {})}

    def build() -> RandomForestRegressor:
        return RandomForestRegressor(
            numTrees=int(p["n_estimators"]),
            maxDepth=_depth(p["max_depth"]),
            maxBins=int(p["max_bin"]),
            seed=int(p["random_state"]),
            subsamplingRate=_fraction("subsample", p["subsample"]),
            featureSubsetStrategy=str(p["max_features"]),
            bootstrap=bool(p["bootstrap"]),
        )

    return MLlibModel(build, unused)


def decision_tree(param: dict[str, Any] | None = None) -> MLlibModel:
    used = {"max_depth": 10, "max_bin": 256, "random_state": 0}
    unused = without_effect(param, set(used), {*MACHINE, "criterion", "splitter"})
    p = {**used, **(param or {})}

    def build() -> DecisionTreeRegressor:
        return DecisionTreeRegressor(
            maxDepth=_depth(p["max_depth"]), maxBins=int(p["max_bin"]), seed=int(p["random_state"])
        )

    return MLlibModel(build, unused)
