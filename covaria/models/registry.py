"""Models by name."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import SparkSession

from ..functions.distributions import Distribution, choice, randint, uniform
from . import classifiers as c
from .base import Fitted, MLlibModel, Model
from .ensembles import (
    BootstrappedRegressor,
    QuantileIntervalRegressor,
    SuperLearner,
    bootstrapped_kernel,
    bootstrapped_trees,
)
from .kernel import KernelRegressor
from .linear import GramRegressor
from .neighbours import NeighbourRegressor
from .trees import (
    BOOSTER_SPACE,
    SYMMETRIC_SPACE,
    boosted_trees,
    decision_tree,
    leafwise_trees,
    SMALLEST_SHARE,
    random_forest,
    symmetric_trees,
    without_effect,
)

Factory = Callable[[dict[str, Any] | None], Model]


def _known(kind: type[Model], names: set[str]) -> Factory:
    """A model whose parameters are its own arguments; other names are an error."""

    def make(param: dict[str, Any] | None = None) -> Model:
        without_effect(param, names, set())
        return kind(**(param or {}))

    return make


KERNEL_NAMES = {"components", "gamma", "regularisation", "seed", "max_iter"}


def _vote(param: dict[str, Any] | None = None) -> Model:
    """The vote has members with fixed settings: whatever booster parameters it is given have no effect and are reported."""
    p = dict(param or {})
    model = SuperLearner(key=p.pop("key", "key"))
    model.unused = sorted(p)
    return model


REGRESSORS: dict[str, Factory] = {
    "XGBRegressor": boosted_trees,
    "CatBoostRegressor": symmetric_trees,
    "LightGBMRegressor": leafwise_trees,
    "RandomForestRegressor": random_forest,
    "DecisionTreeRegressor": decision_tree,
    "SVMRegressor": _known(KernelRegressor, KERNEL_NAMES),
    "BootstrappedXGBRegressor": bootstrapped_trees,
    "BootstrappedSVMRegressor": bootstrapped_kernel,
    "SuperLearnerRegressor": _vote,
    "QuantileGradientBoosting": _known(
        QuantileIntervalRegressor, {"lower_alpha", "upper_alpha", "n_estimators", "learning_rate", "max_depth", "leaf_depth", "accuracy"}
    ),
    "KNeighborsRegressor": _known(NeighbourRegressor, {"k", "key"}),
    "GramRegressor": _known(GramRegressor, {"ridge"}),
}

CLASSIFIERS: dict[str, Callable[..., c.Classifier]] = {
    "LogisticRegression": c.logistic_regression,
    "RandomForestClassifier": c.forest_classifier,
    "DecisionTreeClassifier": c.tree_classifier,
    "GaussianNB": lambda p=None: c.GaussianBayes(),
    "KNeighborsClassifier": lambda p=None: c.NeighbourClassifier(**(p or {})),
    "LinearSVC": c.linear_svc,
}

_LOADERS: dict[str, type[Model]] = {
    "SVMRegressor": KernelRegressor,
    "BootstrappedXGBRegressor": BootstrappedRegressor,
    "BootstrappedSVMRegressor": BootstrappedRegressor,
    "SuperLearnerRegressor": SuperLearner,
    "QuantileGradientBoosting": QuantileIntervalRegressor,
    "KNeighborsRegressor": NeighbourRegressor,
    "GramRegressor": GramRegressor,
}


def regressor(name: str, param: dict[str, Any] | None = None) -> Model:
    if name not in REGRESSORS:
        raise ValueError(f"unknown model {name!r}; known: {sorted(REGRESSORS)}")
    return REGRESSORS[name](param)


def classifier(name: str, param: dict[str, Any] | None = None) -> c.Classifier:
    if name not in CLASSIFIERS:
        raise ValueError(f"unknown classifier {name!r}; known: {sorted(CLASSIFIERS)}")
    return CLASSIFIERS[name](param)


def load(spark: SparkSession, name: str, path: str) -> Fitted:
    if name not in REGRESSORS:
        raise ValueError(f"unknown model {name!r}; known: {sorted(REGRESSORS)}")
    return _LOADERS.get(name, MLlibModel).load(spark, path)


def _space(declared: dict[str, list[Any]]) -> dict[str, Distribution]:
    out: dict[str, Distribution] = {}
    for name, ends in declared.items():
        if len(ends) != 2 or any(isinstance(e, str) for e in ends):
            out[name] = choice(ends)
        elif name in ("max_depth", "max_bin", "num_boost_round", "min_child_samples", "early_stopping_rounds"):
            out[name] = randint(int(min(ends)), int(max(ends)) + 1)
        else:
            low, high = float(min(ends)), float(max(ends))
            if name == "learning_rate" or name == "subsample" or name.startswith("colsample"):
                low, high = max(low, SMALLEST_SHARE), min(high, 1.0)  # what MLlib can take
            out[name] = uniform(low, high)
    return out


def default_space(name: str) -> dict[str, Distribution]:
    """The search space a model declares for itself (may be empty)."""
    declared = {
        "XGBRegressor": BOOSTER_SPACE,
        "BootstrappedXGBRegressor": BOOSTER_SPACE,
        "CatBoostRegressor": SYMMETRIC_SPACE,
    }
    return _space(declared.get(name, {}))
