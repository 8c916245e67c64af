"""Feature ranking: stepwise elimination, Shapley values, random choice."""

from __future__ import annotations

import math
from abc import ABC, abstractmethod
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..functions.hashing import order_value
from ..functions.metrics import SCORERS, score, scorer
from ..models.base import Model
from ..models.linear import GramRegressor
from ..session import held
from .gram import BUILTIN_WIDTH, MOMENT_SCORERS, absolute_errors, fit_moments, fold_fits, fold_prediction, leave_one_out, moments, squared_scores
from .scoring import fold_scores

LOG_SCHEMA = T.StructType(
    [
        T.StructField("iteration", T.IntegerType(), False),
        T.StructField("position", T.IntegerType(), False),
        T.StructField("feature", T.StringType(), False),
        T.StructField("score", T.DoubleType(), True),
    ]
)


class SubsetScorer(ABC):
    """Scores several feature subsets of one prepared table."""

    @abstractmethod
    def scores(self, subsets: Sequence[Sequence[str]]) -> list[float]: ...


def _wide(name: str, features: Sequence[str]) -> bool:
    """Whether all subsets are scored by matrix products: an expression for each would blow up generated code."""
    return name == "mean_absolute_error_scorer" and len(features) + 1 > BUILTIN_WIDTH


def _negated(value: float | None) -> float | None:
    return None if value is None else -value


def _average(values: Sequence[float | None]) -> float | None:
    return None if any(v is None for v in values) else sum(values) / len(values)


class MomentFolds(SubsetScorer):
    """Squared-error scores from fold moments: no job per subset."""

    def __init__(self, df: DataFrame, features: Sequence[str], name: str, fold: str, ridge: float, label: str = "target"):
        self.folds = moments(df, features, label, by=fold)
        self.at = {f: i for i, f in enumerate(features)}
        self.name, self.ridge = name, ridge

    def scores(self, subsets: Sequence[Sequence[str]]) -> list[float]:
        out = []
        for subset in subsets:
            index = [self.at[f] for f in subset] + [len(self.at)]
            folds = {f: m.pick(index) for f, m in self.folds.items()}
            values = [
                squared_scores(fit_moments(leave_one_out(folds, f), self.ridge), folds[f])[self.name]
                for f in sorted(folds)
            ]
            out.append(_average(values))
        return out


class LinearFolds(SubsetScorer):
    """Any scorer for the linear model: one pass over the data for all subsets."""

    def __init__(self, df: DataFrame, features: Sequence[str], name: str, fold: str, ridge: float, label: str = "target"):
        self.df, self.fold, self.label, self.name, self.ridge = df, fold, label, name, ridge
        self.at = {f: i for i, f in enumerate(features)}
        self.folds = moments(df, features, label, by=fold)

    def scores(self, subsets: Sequence[Sequence[str]]) -> list[float]:
        if _wide(self.name, self.at):
            fits: dict = {f: [] for f in self.folds if f is not None}
            for subset in subsets:
                index = [self.at[f] for f in subset]
                for f, fit in fold_fits({f: m.pick([*index, len(self.at)]) for f, m in self.folds.items()}, self.ridge).items():
                    if f is not None:
                        fits[f].append((index, fit))
            errors = absolute_errors(self.df, list(self.at), self.label, fits, self.fold)
            return [_average([_negated(errors[f][i]) for f in errors]) for i in range(len(subsets))]
        aggs = []
        for i, subset in enumerate(subsets):
            index = [self.at[f] for f in subset] + [len(self.at)]
            fits = fold_fits({f: m.pick(index) for f, m in self.folds.items()}, self.ridge)
            guess = fold_prediction(fits, subset, self.fold)
            aggs.append(scorer(self.name)(F.col(self.label), guess, len(subset)).alias(f"s{i}"))
        rows = self.df.groupBy(self.fold).agg(*aggs).orderBy(self.fold).collect()  # one row per fold
        return [_average([r[f"s{i}"] for r in rows]) for i in range(len(subsets))]


class ModelFolds(SubsetScorer):
    """Any model: fits run as concurrent Spark jobs on one held table."""

    def __init__(self, df: DataFrame, model: Model, name: str, fold: str, label: str = "target", jobs: int = 4):
        self.df, self.model, self.name, self.fold, self.label, self.jobs = df, model, name, fold, label, jobs

    def _one(self, subset: Sequence[str]) -> float | None:
        per_fold = fold_scores(self.df, subset, self.model, [self.name], self.fold, self.label)
        return per_fold.agg(F.avg(self.name)).first()[0]

    def scores(self, subsets: Sequence[Sequence[str]]) -> list[float]:
        with ThreadPoolExecutor(self.jobs) as pool:
            return list(pool.map(self._one, subsets))


class MomentHoldout(SubsetScorer):
    def __init__(self, train: DataFrame, oos: DataFrame, features: Sequence[str], name: str, ridge: float, label: str = "target"):
        self.train = moments(train, features, label)[0]
        self.oos = moments(oos, features, label)[0]
        self.at = {f: i for i, f in enumerate(features)}
        self.name, self.ridge = name, ridge

    def scores(self, subsets: Sequence[Sequence[str]]) -> list[float]:
        out = []
        for subset in subsets:
            index = [self.at[f] for f in subset] + [len(self.at)]
            out.append(squared_scores(fit_moments(self.train.pick(index), self.ridge), self.oos.pick(index))[self.name])
        return out


class LinearHoldout(SubsetScorer):
    def __init__(self, train: DataFrame, oos: DataFrame, features: Sequence[str], name: str, ridge: float, label: str = "target"):
        self.train = moments(train, features, label)[0]
        self.oos, self.label, self.name, self.ridge = oos, label, name, ridge
        self.at = {f: i for i, f in enumerate(features)}

    def scores(self, subsets: Sequence[Sequence[str]]) -> list[float]:
        if _wide(self.name, self.at):
            index = [[self.at[f] for f in subset] for subset in subsets]
            fits = {0: [(i, fit_moments(self.train.pick([*i, len(self.at)]), self.ridge)) for i in index]}
            return [_negated(e) for e in absolute_errors(self.oos, list(self.at), self.label, fits)[0]]
        aggs = []
        for i, subset in enumerate(subsets):
            index = [self.at[f] for f in subset] + [len(self.at)]
            guess = fit_moments(self.train.pick(index), self.ridge).expression(subset)
            aggs.append(scorer(self.name)(F.col(self.label), guess, len(subset)).alias(f"s{i}"))
        row = self.oos.agg(*aggs).first()
        return [row[f"s{i}"] for i in range(len(subsets))]


class ModelHoldout(SubsetScorer):
    def __init__(self, train: DataFrame, oos: DataFrame, model: Model, name: str, label: str = "target", jobs: int = 4):
        self.train, self.oos, self.model, self.name, self.label, self.jobs = train, oos, model, name, label, jobs

    def _one(self, subset: Sequence[str]) -> float | None:
        predicted = self.model.fit(self.train, subset, self.label).transform(self.oos)
        return score(predicted, [self.name], len(subset), label=self.label).first()[0]

    def scores(self, subsets: Sequence[Sequence[str]]) -> list[float]:
        with ThreadPoolExecutor(self.jobs) as pool:
            return list(pool.map(self._one, subsets))


def eliminate(features: Sequence[str], subset_scorer: SubsetScorer, score_last: bool) -> list[tuple[int, int, str, float | None]]:
    """Rows (iteration, position, feature, score).

    Each step removes the feature whose removal scores best, first in column
    order on ties.  The last feature gets score 0, or its own score.
    """
    left = list(features)
    rows: list[tuple[int, int, str, float | None]] = []
    iteration = 0
    while len(left) > 1:
        scores = subset_scorer.scores([[f for f in left if f != gone] for gone in left])
        rows += [(iteration, i, f, s) for i, (f, s) in enumerate(zip(left, scores))]
        worth = [float("-inf") if x is None or math.isnan(x) else x for x in scores]
        best = max(range(len(left)), key=lambda i: (worth[i], -i))
        left.pop(best)
        iteration += 1
    if left:
        last = subset_scorer.scores([left])[0] if score_last else 0.0
        rows.append((iteration, 0, left[0], last))
    return rows


def log_table(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    return spark.createDataFrame(list(rows), LOG_SCHEMA)


def _score() -> Column:
    return F.when(~F.isnan("score"), F.col("score"))


def eliminated(log: DataFrame) -> DataFrame:
    """(feature, rank, score): the winner of each iteration; rank 0 went first.  NaN counts as no score."""
    return log.groupBy("iteration").agg(
        F.max_by("feature", F.struct(_score(), -F.col("position"))).alias("feature"), F.max(_score()).alias("score")
    ).select("feature", F.col("iteration").alias("rank"), "score")


def arg_max(results: DataFrame) -> DataFrame:
    return results.agg(F.max_by("feature", F.struct(_score(), -F.col("position"))).alias("feature"))


def check_scorer(name: str) -> None:
    if name not in SCORERS:
        raise ValueError(f"unknown scorer {name!r}; known: {sorted(SCORERS)}")


def cv_elimination(
    df: DataFrame, features: Sequence[str], model: Model, scorer_name: str, fold: str = "fold", label: str = "target", jobs: int = 4
) -> DataFrame:
    """Elimination log; `df` is clean and carries a fold column."""
    check_scorer(scorer_name)
    spark = df.sparkSession
    if isinstance(model, GramRegressor):
        if scorer_name in MOMENT_SCORERS:
            return log_table(spark, eliminate(features, MomentFolds(df, features, scorer_name, fold, model.ridge, label), False))
        with held(df.select(*features, label, fold)) as table:
            return log_table(spark, eliminate(features, LinearFolds(table, features, scorer_name, fold, model.ridge, label), False))
    # Keys stay: a neighbour model needs them.
    used = [c for c in ("key",) if c in df.columns] + [*features, label, fold]
    with held(df.select(*used)) as table:
        return log_table(spark, eliminate(features, ModelFolds(table, model, scorer_name, fold, label, jobs), False))


def oos_elimination(
    train: DataFrame, oos: DataFrame, features: Sequence[str], model: Model, scorer_name: str, label: str = "target", jobs: int = 4
) -> DataFrame:
    check_scorer(scorer_name)
    spark = train.sparkSession
    if isinstance(model, GramRegressor):
        if scorer_name in MOMENT_SCORERS:
            return log_table(spark, eliminate(features, MomentHoldout(train, oos, features, scorer_name, model.ridge, label), True))
        with held(oos.select(*features, label)) as table:
            return log_table(spark, eliminate(features, LinearHoldout(train, table, features, scorer_name, model.ridge, label), True))
    used = [c for c in ("key",) if c in train.columns] + [*features, label]
    with held(train.select(*used)) as a, held(oos.select(*used)) as b:
        return log_table(spark, eliminate(features, ModelHoldout(a, b, model, scorer_name, label, jobs), True))


def random_ranking(spark: SparkSession, features: Sequence[str], k: int, seed: str | int = 0) -> DataFrame:
    """k features by seeded hash, in column order; rank = total - index, score = index / 10."""
    if k > len(features):
        raise ValueError(f"cannot choose {k} of {len(features)} features")
    names = spark.createDataFrame([(i, f) for i, f in enumerate(features)], "index int, feature string")
    drawn = names.withColumn("_r", F.row_number().over(Window.orderBy(order_value(seed, "feature"))))
    return (
        drawn.filter(F.col("_r") <= k)
        .orderBy("index")
        .select("feature", (F.lit(len(features)) - F.col("index")).alias("rank"), (F.col("index") / 10).alias("score"))
    )


def ranked_report(eliminated_rows: DataFrame, all_features: DataFrame) -> DataFrame:
    """(Rank, Feature, Score, Iteration), last eliminated first.

    `eliminated_rows` has (iteration, feature, score); `all_features` has
    (position, feature).  Features that never went get the last score plus
    0.01 for each of them in turn, and the last iteration.
    """
    stayed = all_features.join(eliminated_rows.select("feature"), "feature", "left_anti")
    # One row of totals: the tables have one row per feature.
    last = eliminated_rows.agg(F.max("iteration").alias("i"), F.max_by("score", "iteration").alias("s")).first()
    size = stayed.count()
    turn = F.row_number().over(Window.orderBy("position"))
    kept = stayed.withColumn("_turn", turn).select(
        F.lit(last["i"]).alias("iteration"),
        "feature",
        (F.lit(last["s"]) + F.col("_turn") * F.lit(0.01)).alias("score"),
        "_turn",
    )
    rows = eliminated_rows.select("iteration", "feature", "score", F.lit(0).alias("_turn")).unionByName(kept)
    return rows.orderBy(F.desc("iteration"), F.desc("_turn")).select(
        (F.col("iteration") - F.lit(size)).cast("int").alias("Rank"),
        F.col("feature").alias("Feature"),
        F.col("score").alias("Score"),
        F.col("iteration").alias("Iteration"),
    )


def select_features(ranking: DataFrame, method: str, k: int = -1) -> list[str]:
    """Chosen features by rank: the last k eliminated, or the k most important."""
    ordered = [r["feature"] for r in ranking.orderBy("rank").select("feature").collect()]  # one row per feature
    if k == -1:
        return ordered
    if method in ("shap", "random"):
        return ordered[:k]
    return ordered[max(len(ordered) - k, 0):]
