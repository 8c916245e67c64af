"""Parameter search: trial tables, trial scores, best trial."""

from __future__ import annotations

import copy
import math
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext
from dataclasses import dataclass
from functools import partial
from threading import Lock
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.distributions import TRIAL, Distribution
from ..functions.hashing import unit_uniform
from ..models.base import Fitted, Model
from ..models.linear import GramRegressor
from ..session import cut_lineage, held
from .clean import all_present, clean
from .gram import fold_fits, fold_prediction, moments
from .scoring import fold_scores, group_scores
from .split import assign_folds, subsample
from ..functions.metrics import mean_scores, score

TRIAL_SCHEMA = T.StructType(
    [
        T.StructField("trial_id", T.LongType(), False),
        T.StructField("params", T.MapType(T.StringType(), T.StringType()), False),
        T.StructField("scores", T.MapType(T.StringType(), T.DoubleType()), False),
    ]
)

# Names under which a halving search keeps, with a trial's scores, the share of rows and the round of its last scoring.
BUDGET, RUNG = "budget", "rung"
# The fold of a row's group.
GROUP = "groupcv_class"
# Marks of rows that the folds have, and that have no gap in any column.
FOLDED, WHOLE = "_folded", "_whole"
# Fits of MLlib hold their rows, each its own: on more rows than these, one trial at a time makes its fits, of stored rows.
HELD_ROWS = 5_000_000
Space = dict[str, Distribution]
Objective = Callable[[dict[str, Any], float], dict[str, float]]


def trial_table(spark: SparkSession, space: Space, n: int, seed: str | int = 0, start: int = 0) -> DataFrame:
    """n drawn trials: trial_id and one typed column per parameter."""
    return draw_trials(spark.range(start, start + n).withColumnRenamed("id", TRIAL), space, seed)


def draw_trials(ids: DataFrame, space: Space, seed: str | int = 0) -> DataFrame:
    """Draw every parameter for the given trial ids."""
    return ids.select(TRIAL, *[d.draw(name, seed).alias(name) for name, d in space.items()])


def grid_table(spark: SparkSession, values: dict[str, Sequence[Any]]) -> DataFrame:
    """Every combination, by division of the trial number: no join."""
    size = math.prod(len(v) for v in values.values())
    out, stride = [], size
    for name, options in values.items():
        stride //= len(options)
        index = F.pmod(F.floor(F.col("id") / F.lit(stride)), F.lit(len(options))).cast("int")
        out.append(F.element_at(F.array(*[F.lit(o) for o in options]), index + F.lit(1)).alias(name))
    return spark.range(size).select(F.col("id").alias(TRIAL), *out)


def grid_values(space: dict[str, Distribution | Sequence[Any]]) -> dict[str, Sequence[Any]]:
    """Value lists for a grid: plain lists and choices as they are."""
    out: dict[str, Sequence[Any]] = {}
    for name, d in space.items():
        if isinstance(d, Distribution):
            if d.options is None:
                raise ValueError(f"grid search needs a list of values for {name!r}")
            out[name] = d.options
        else:
            out[name] = list(d)
    return out


def _near(name: str, d: Distribution, good: Sequence[Any], seed: str, width: float) -> Column:
    """A value near a randomly chosen good one, inside the declared bounds."""
    u = unit_uniform(f"{seed}:{name}:pick", TRIAL)
    index = F.floor(u * F.lit(len(good))).cast("int") + F.lit(1)
    centre = F.element_at(F.array(*[F.lit(g) for g in good]), index)
    fresh = d.draw(name, seed)
    if d.options is not None:
        return F.when(unit_uniform(f"{seed}:{name}:keep", TRIAL) < 0.75, centre).otherwise(fresh)
    if d.low is None or d.high is None:
        return fresh
    a = unit_uniform(f"{seed}:{name}:a", TRIAL)
    b = unit_uniform(f"{seed}:{name}:b", TRIAL)
    step = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - a)) * F.cos(F.lit(2 * math.pi) * b)
    low, high = (math.log(d.low), math.log(d.high)) if d.log else (float(d.low), float(d.high))
    at = F.log(centre.cast("double")) if d.log else centre.cast("double")
    moved = F.greatest(F.lit(low), F.least(F.lit(high), at + step * F.lit((high - low) * width)))
    value = F.exp(moved) if d.log else moved
    if d.quantum is not None:
        value = F.bround(value / F.lit(float(d.quantum))) * F.lit(float(d.quantum))
    if d.integer:
        # The upper end of an integer range is not drawn unless it is quantised.
        top = int(d.high) if d.quantum is not None else int(d.high) - 1
        return F.least(F.floor(value), F.lit(top)).cast("long")
    return value


def near_trials(
    spark: SparkSession, space: Space, good: Sequence[dict[str, Any]], n: int, seed: str | int, start: int, width: float
) -> DataFrame:
    ids = spark.range(start, start + n).withColumnRenamed("id", TRIAL)
    return ids.select(
        TRIAL, *[_near(k, d, [g[k] for g in good], str(seed), width).alias(k) for k, d in space.items()]
    )


@dataclass
class TrialObjective:
    """Scores one parameter set: out-of-sample, k-fold and grouped.

    The cleaned, split tables are made once and shared by all trials.  With a
    folder, the model of a trial's out-of-sample score is kept there, under the
    trial's number; a trial that is scored again on more rows replaces it.
    """

    training: DataFrame
    oos: DataFrame
    features: Sequence[str]
    model: Callable[[dict[str, Any]], Model]
    scorers: Sequence[str]
    n_splits: int
    key: str = "key"
    seed: str | int = 1
    save_to: str | None = None
    trial: int | None = None

    def for_trial(self, trial: int) -> TrialObjective:
        """The same tables, for the trial of this number."""
        one = copy.copy(self)
        one.trial = trial
        return one

    def prepare(self) -> None:
        # The rows are judged by all columns; only those that a trial reads are kept, once for the folds and the whole.
        used = {self.key, *self.features, "target", GROUP}
        self.clean_oos = clean(self.oos).select(*[c for c in self.oos.columns if c in used])
        columns = [c for c in self.training.columns if c in used]
        marked = self.training.select(
            *columns, all_present(self.training, [*self.features, "target"]).alias(FOLDED), all_present(self.training).alias(WHOLE)
        ).filter(F.col(FOLDED) | F.col(WHOLE))
        self.use(assign_folds(marked, self.key, self.n_splits, self.seed, among=F.col(FOLDED)))
        self.once: dict[Any, Any] = {}
        self.turn = Lock()
        # Few rows stay in the splits that they come in: MLlib places its bins by a sample of each split.
        self.many = self.training.count() > HELD_ROWS
        self.fits = Lock() if self.many else nullcontext()

    def use(self, rows: DataFrame) -> None:
        """Take the folds and the training rows from this table, which has the rows of both."""
        self.rows = rows
        self.folds = rows.filter(FOLDED).select(self.key, *self.features, "target", "fold")
        self.clean_training = rows.filter(WHOLE).drop(FOLDED, WHOLE, "fold")

    def kept(self, df: DataFrame) -> DataFrame:
        """Many rows are stored: in memory they are several times as large, and have no room beside those of the fits."""
        return cut_lineage(df) if self.many else df

    def _shared(self, name: Any, make: Callable[[], Any]) -> Any:
        """What no parameter changes is made by the first trial that asks."""
        with self.turn:
            if name not in self.once:
                self.once[name] = make()
            return self.once[name]

    def tables(self, budget: float) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Training, out-of-sample and folded rows; less than all are drawn once for all trials."""
        whole = self.clean_training, self.clean_oos, self.folds
        if budget >= 1.0:
            return whole
        return self._shared(("rows", budget), lambda: tuple(self.kept(subsample(t, self.key, budget, "budget")) for t in whole))

    def _scores(self, model: Model, budget: float) -> tuple[Fitted, list[DataFrame]]:
        training, oos, folds = self.tables(budget)
        n = len(self.features)
        if not isinstance(model, GramRegressor):
            # The tables are clean and stored, so no trial holds them again.
            with self.fits:
                fitted = model.fit(training, self.features)
                alone = score(fitted.transform(oos), self.scorers, n)
                crossed, grouped = fold_scores(folds, self.features, model, self.scorers), group_scores(training, self.features, model, self.scorers)
            return fitted, [mean_scores(alone, self.scorers, "oos"), mean_scores(crossed, self.scorers, "cv"), grouped]
        # The sums of a linear model are those of the rows: every trial solves the same ones.
        sums = partial(moments, features=self.features, label="target")
        fitted = model.solved(self._shared(("all", budget), lambda: sums(training)), self.features)
        rows = [mean_scores(score(fitted.transform(oos), self.scorers, n), self.scorers, "oos")]
        for table, fold, prefix in ((folds, "fold", "cv"), (training, GROUP, "groupcv")):
            if fold not in table.columns:
                rows.append(group_scores(training, self.features, model, self.scorers))
                continue
            fits = fold_fits(self._shared((prefix, budget), lambda t=table, f=fold: sums(t, by=f)), model.ridge)
            guessed = table.withColumn("prediction", fold_prediction(fits, self.features, fold))
            rows.append(mean_scores(score(guessed, self.scorers, n, by=[fold]), self.scorers, prefix))
        return fitted, rows

    def __call__(self, params: dict[str, Any], budget: float = 1.0) -> dict[str, float]:
        out: dict[str, float] = {}
        fitted, rows = self._scores(self.model(params), budget)
        if self.save_to is not None and self.trial is not None:
            fitted.save(model_path(self.save_to, self.trial))
        for row in rows:
            out.update({k: v for k, v in row.first().asDict().items()})
        return out


def model_path(folder: str, trial: int) -> str:
    return f"{folder.rstrip('/')}/{trial}/model"


def run_trials(trials: DataFrame, objective: Objective, jobs: int = 2, budget: float = 1.0) -> list[tuple[int, dict, dict]]:
    """Score every trial; a trial is a handful of Spark jobs, a few trials run at a time."""
    rows = [r.asDict() for r in trials.orderBy(TRIAL).collect()]  # one row per trial

    def one(row: dict[str, Any]) -> tuple[int, dict, dict]:
        params = {k: v for k, v in row.items() if k != TRIAL}
        scorer = objective.for_trial(row[TRIAL]) if isinstance(objective, TrialObjective) else objective
        return row[TRIAL], params, scorer(params, budget)

    with ThreadPoolExecutor(jobs) as pool:
        return list(pool.map(one, rows))


def results_table(spark: SparkSession, results: Sequence[tuple[int, dict, dict]]) -> DataFrame:
    rows = [(i, {k: str(v) for k, v in p.items()}, s) for i, p, s in results]
    return spark.createDataFrame(rows, TRIAL_SCHEMA)


def best_trial(trials: DataFrame, metric: str) -> DataFrame:
    """The row with the largest score; the lowest trial id on ties.

    NaN counts as no score.  Trials that were scored on part of the rows only
    (a `budget` under 1 among their scores) are no candidates.
    """
    value = F.col("scores")[metric]
    order = F.struct(value, -F.col("trial_id"))
    whole = F.coalesce(F.col("scores")[BUDGET], F.lit(1.0)) >= 1.0
    return trials.filter(value.isNotNull() & ~F.isnan(value) & whole).agg(
        F.max_by("trial_id", order).alias("trial_id"),
        F.max_by("params", order).alias("params"),
        F.max_by("scores", order).alias("scores"),
    )


def _top(results: Sequence[tuple[int, dict, dict]], metric: str, share: float) -> list[tuple[int, dict, dict]]:
    scored = [r for r in results if r[2].get(metric) is not None and not math.isnan(r[2][metric])]
    if not scored:
        raise ValueError(f"no trial has a score {metric!r}")
    scored.sort(key=lambda r: (-r[2][metric], r[0]))
    return scored[: max(1, math.ceil(share * len(scored)))]


def sampled_search(
    spark: SparkSession, space: Space, objective: Objective, metric: str, n: int, seed: str | int = 0, jobs: int = 2,
    rounds: int = 1, share: float = 0.25, width: float = 0.15,
) -> list[tuple[int, dict, dict]]:
    """Random trials; with several rounds, later ones are drawn near the best share so far."""
    rounds = max(1, min(rounds, n))
    sizes = [n // rounds + (1 if i < n % rounds else 0) for i in range(rounds)]
    results: list[tuple[int, dict, dict]] = []
    for i, size in enumerate(sizes):
        if i == 0:
            trials = trial_table(spark, space, size, seed)
        else:
            good = [p for _, p, _ in _top(results, metric, share)]
            trials = near_trials(spark, space, good, size, f"{seed}:{i}", len(results), width / i)
        results += run_trials(trials, objective, jobs)
    return results


def halving_search(
    spark: SparkSession, space: Space, objective: Objective, metric: str, n: int, seed: str | int = 0, jobs: int = 2, factor: int = 4
) -> list[tuple[int, dict, dict]]:
    """Many trials on few rows, the best of them on more rows, the last on all rows.

    Every trial is in the result, with its last scores, the share of rows that
    these were made on, and the round; those on all rows come first.
    """
    steps = max(0, math.floor(math.log(max(n, 1), factor)))
    everyone = trial_table(spark, space, n, seed)
    alive = [r[TRIAL] for r in everyone.select(TRIAL).collect()]  # one row per trial
    done: dict[int, tuple[int, dict, dict]] = {}
    for rung, step in enumerate(range(steps, -1, -1)):
        budget = float(factor) ** -step
        results = run_trials(everyone.filter(F.col(TRIAL).isin(alive)), objective, jobs, budget=budget)
        done.update({i: (i, params, {**scores, BUDGET: budget, RUNG: float(rung)}) for i, params, scores in results})
        if step:
            alive = [r[0] for r in _top(results, metric, 1 / factor)]
    return sorted(done.values(), key=lambda r: (-r[2][BUDGET], r[0]))


METHODS = ("GridSearch", "RandomSearch", "HyperOptSearch", "BayesianOptimization", "HyperBand")


@dataclass
class SearchResult:
    trials: DataFrame
    best: DataFrame
    model: Fitted | None
    model_path: str | None
    # Parameters of the trials that have no effect on this model.
    unused: Sequence[str] = ()
    # (trial_id, path): the saved model of every trial, where they were saved.
    models: DataFrame | None = None


def search(
    training: DataFrame,
    oos: DataFrame,
    features: Sequence[str],
    model: Callable[[dict[str, Any]], Model],
    space: dict[str, Any],
    method: str,
    metric: str,
    scorers: Sequence[str],
    n_iteration: int = 10,
    n_splits: int = 5,
    key: str = "key",
    seed: str | int = 0,
    jobs: int = 2,
    save_to: str | None = None,
    convert: Callable[[dict[str, Any]], dict[str, Any]] = dict,
) -> SearchResult:
    """Run a search, save the model of every trial, refit the best parameters on all training rows and save that model."""
    if method not in METHODS:
        raise ValueError(f"unknown search method {method!r}; known: {METHODS}")
    spark = training.sparkSession
    objective = TrialObjective(training, oos, features, lambda p: model(convert(p)), scorers, n_splits, key, save_to=save_to)
    objective.prepare()
    with held(objective.clean_oos) as o, nullcontext(objective.kept(objective.rows)) if objective.many else held(objective.rows) as rows:
        objective.clean_oos = o
        objective.use(rows)
        if method == "GridSearch":
            results = run_trials(grid_table(spark, grid_values(space)), objective, jobs)
        elif method == "HyperBand":
            results = halving_search(spark, space, objective, metric, n_iteration, seed, jobs)
        else:
            rounds = {"RandomSearch": 1, "HyperOptSearch": 3, "BayesianOptimization": 5}[method]
            results = sampled_search(spark, space, objective, metric, n_iteration, seed, jobs, rounds)
        (winner, params, _), *_ = _top([r for r in results if r[2].get(BUDGET, 1.0) >= 1.0], metric, 0.0)
        chosen = model(convert(params))
        fitted = chosen.fit(objective.clean_training, features)
    path = None
    if save_to is not None:
        path = model_path(save_to, winner)
        fitted.save(path)
        kept = [(i, model_path(save_to, i)) for i, _, _ in results]
    trials = results_table(spark, results)
    models = None if save_to is None else spark.createDataFrame(kept, "trial_id long, path string")
    return SearchResult(trials, best_trial(trials, metric), fitted, path, list(getattr(chosen, "unused", ())), models)

