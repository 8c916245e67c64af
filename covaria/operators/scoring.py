"""Out-of-sample, cross-validated and grouped scores of any model."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.metrics import mean_scores, score
from ..models.base import Fitted, Model
from ..models.linear import GramRegressor
from ..session import held
from .clean import clean, clean_selected
from .gram import fold_fits, fold_prediction, moments
from .split import assign_folds, test_part, train_part


def out_of_fold(
    df: DataFrame, features: Sequence[str], model: Model, fold: str = "fold", label: str = "target"
) -> DataFrame:
    """Add each row's prediction by the model that was trained without its fold."""
    if isinstance(model, GramRegressor):
        fits = fold_fits(moments(df, features, label, by=fold), model.ridge)
        return df.withColumn("prediction", fold_prediction(fits, features, fold))
    folds = sorted(r[0] for r in df.select(fold).distinct().collect())  # one row per fold
    parts = [
        model.fit(train_part(df, i, fold), features, label).transform(test_part(df, i, fold)) for i in folds
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def fold_scores(
    df: DataFrame, features: Sequence[str], model: Model, scorers: Sequence[str], fold: str = "fold", label: str = "target"
) -> DataFrame:
    """One row of scores per fold."""
    predicted = out_of_fold(df, features, model, fold, label)
    return score(predicted, scorers, len(features), by=[fold], label=label)


def cross_validation_scores(
    training: DataFrame,
    features: Sequence[str],
    model: Model,
    scorers: Sequence[str],
    n_splits: int,
    key: str = "key",
    seed: str | int = 1,
) -> DataFrame:
    """Row `cv_<scorer>`: clean on the used columns, split, score, average."""
    table = assign_folds(clean_selected(training, features, keep=[key]), key, n_splits, seed)
    return mean_scores(fold_scores(table, features, model, scorers), scorers, "cv")


def group_scores(
    training: DataFrame, features: Sequence[str], model: Model, scorers: Sequence[str], fold: str = "groupcv_class"
) -> DataFrame:
    """Row `groupcv_<scorer>`; all null where there is no group column."""
    if fold not in training.columns:
        spark = training.sparkSession
        return spark.range(1).select(*[F.lit(None).cast("double").alias(f"groupcv_{s}") for s in scorers])
    return mean_scores(fold_scores(clean(training), features, model, scorers, fold), scorers, "groupcv")


def fit_and_predict(
    training: DataFrame, oos: DataFrame, features: Sequence[str], model: Model, label: str = "target", weight: str | None = None
) -> tuple[Fitted, DataFrame]:
    rows = clean(training)
    if isinstance(model, GramRegressor) or not model.iterative:
        fitted = model.fit(rows, features, label, weight)
    else:
        # Iterative fits read their rows many times.
        keep = [c for c in {"key", weight} if c in rows.columns]
        with held(rows.select(*keep, *features, label)) as table:
            fitted = model.fit(table, features, label, weight)
    return fitted, fitted.transform(clean(oos))


def out_of_sample_scores(
    training: DataFrame, oos: DataFrame, features: Sequence[str], model: Model, scorers: Sequence[str], weight: str | None = None
) -> DataFrame:
    """Row `oos_<scorer>`: clean both tables on all columns, fit on one, score on the other."""
    _, predicted = fit_and_predict(training, oos, features, model, weight=weight)
    return mean_scores(score(predicted, scorers, len(features)), scorers, "oos")


def predicted_vs_real(
    predicted: DataFrame, real: str = "label_oos", guess: str = "label_pred", keep: Sequence[str] = (), label: str = "target"
) -> DataFrame:
    return predicted.select(
        *keep, F.col(label).cast("double").alias(real), F.col("prediction").cast("double").alias(guess)
    )
