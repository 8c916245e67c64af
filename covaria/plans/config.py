"""Run configuration: plain values, checked when made."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from ..functions.metrics import SCORERS
from ..models.registry import CLASSIFIERS, REGRESSORS, default_space
from ..operators.search import METHODS

# Names of the ranking methods.
RANKING_METHODS = (
    "FeatureRankingByRandomness",
    "FeatureRankingByEliminationCV",
    "FeatureRankingByEliminationOOS",
    "FeatureRankingByShap",
    "FeatureRankingByGroupCV",
)

STAGES = (
    "data_preparation",
    "data_exploration",
    "feature_extraction",
    "hyper_parameter_optimization",
    "model_exploration",
    "prediction_mapping",
    "covariate_drift",
)


class ConfigError(ValueError):
    pass


def _one_of(what: str, value: str, known: Sequence[str]) -> None:
    if value not in known:
        raise ConfigError(f"{what} {value!r} is not one of {sorted(known)}")


@dataclass(frozen=True)
class TargetConfig:
    property: str | None = None
    weight: str | None = None
    group: str | None = None
    group_splits: int | None = None
    percentage_oos: float | None = None
    # Degrees to EPSG:3577 metres before sampling.
    geographic: bool = False


@dataclass(frozen=True)
class RankingConfig:
    method: str = "FeatureRankingByEliminationCV"
    scoring_function: str = "r2_scorer"
    n_splits: int = 5
    no_features_to_select: int = -1
    permutations: int = 4


# Stands for the search space that a model declares for itself.
DECLARED = "declared"


@dataclass(frozen=True)
class SearchConfig:
    algorithm: str = "RandomSearch"
    # By name and distribution, or "declared" for the space that the model declares for itself.
    space: Mapping[str, Any] | str = field(default_factory=dict)
    n_iteration: int = 10
    n_splits: int = 5
    scoring_functions: Sequence[str] = tuple(SCORERS)
    metric: str = "oos_mean_absolute_error_scorer"


@dataclass(frozen=True)
class ExplorationConfig:
    n_splits: int = 5
    scoring_functions: Sequence[str] = tuple(SCORERS)


@dataclass(frozen=True)
class WorkflowConfig:
    covariates: Sequence[str]
    target: TargetConfig = TargetConfig()
    model: str = "GramRegressor"
    parameters: Mapping[str, Any] = field(default_factory=dict)
    ranking: RankingConfig = RankingConfig()
    search: SearchConfig = SearchConfig()
    exploration: ExplorationConfig = ExplorationConfig()
    drift_classifier: str = "LogisticRegression"
    stages: Sequence[str] = STAGES
    output_folder: str | None = None
    # Results of an earlier run, for stages that are switched off now.
    selected_features: Sequence[str] | None = None
    trained_model: str | None = None
    key: str = "point_id"
    seed: int = 0
    # Spark jobs that run side by side.
    jobs: int = 2

    def __post_init__(self) -> None:
        if not self.covariates:
            raise ConfigError("no covariates")
        for stage in self.stages:
            _one_of("stage", stage, STAGES)
        _one_of("model", self.model, list(REGRESSORS))
        _one_of("classifier", self.drift_classifier, list(CLASSIFIERS))
        _one_of("ranking method", self.ranking.method, RANKING_METHODS)
        _one_of("scorer", self.ranking.scoring_function, list(SCORERS))
        _one_of("search algorithm", self.search.algorithm, METHODS)
        if isinstance(self.search.space, str):
            _one_of("search space", self.search.space, [DECLARED])
            if not default_space(self.model):
                raise ConfigError(f"{self.model} declares no search space")
        for name in [*self.search.scoring_functions, *self.exploration.scoring_functions]:
            _one_of("scorer", name, list(SCORERS))
        family, _, scorer = self.search.metric.partition("_")
        _one_of("score family", family, ["oos", "cv", "groupcv"])
        _one_of("scorer of the search metric", scorer, list(self.search.scoring_functions))
        percentage = self.target.percentage_oos
        if percentage is not None and not 0 <= percentage <= 100:
            raise ConfigError("percentage_oos must lie between 0 and 100")
        if self.ranking.method == "FeatureRankingByGroupCV" and self.target.group is None:
            raise ConfigError("FeatureRankingByGroupCV needs a group property")
        if self.target.group is not None and not self.target.group_splits:
            raise ConfigError("a group property needs group_splits")
