"""Scorers as aggregate columns.  Greater is always better."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

Scorer = Callable[[Column, Column, int], Column]


def _error(y: Column, p: Column) -> Column:
    return y.cast("double") - p.cast("double")


def mean_squared_error_scorer(y: Column, p: Column, n_covariates: int = 0) -> Column:
    e = _error(y, p)
    return -F.avg(e * e)


def mean_absolute_error_scorer(y: Column, p: Column, n_covariates: int = 0) -> Column:
    return -F.avg(F.abs(_error(y, p)))


def rmse_scorer(y: Column, p: Column, n_covariates: int = 0) -> Column:
    e = _error(y, p)
    return -F.sqrt(F.avg(e * e))


def r2_scorer(y: Column, p: Column, n_covariates: int = 0) -> Column:
    """1 - SSE/SST; a constant target scores 1 when fitted exactly, else 0."""
    e = _error(y, p)
    sse = F.sum(e * e)
    # var_pop runs the stable one-pass update, unlike sum(y*y) - sum(y)^2/n.
    sst = F.var_pop(y.cast("double")) * F.count(y)
    return F.when(sst > 0, F.lit(1.0) - sse / sst).when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0))


def adjusted_r2_scorer(y: Column, p: Column, n_covariates: int = 0) -> Column:
    """R2 corrected for the number of features, floored at 0; null if n <= p + 1."""
    n = F.count(y)
    free = n - F.lit(n_covariates) - F.lit(1)
    value = F.lit(1.0) - (F.lit(1.0) - r2_scorer(y, p)) * (n - F.lit(1)) / free
    return F.when(free > 0, F.greatest(value, F.lit(0.0)))


SCORERS: dict[str, Scorer] = {
    "mean_squared_error_scorer": mean_squared_error_scorer,
    "mean_absolute_error_scorer": mean_absolute_error_scorer,
    "r2_scorer": r2_scorer,
    "rmse_scorer": rmse_scorer,
    "adjusted_r2_scorer": adjusted_r2_scorer,
}


def scorer(name: str) -> Scorer:
    try:
        return SCORERS[name]
    except KeyError:
        raise ValueError(f"unknown scorer {name!r}; known: {sorted(SCORERS)}") from None


def score(
    predictions: DataFrame,
    names: Sequence[str],
    n_covariates: int,
    by: Sequence[str] = (),
    label: str = "target",
    prediction: str = "prediction",
) -> DataFrame:
    """All scorers in one aggregation, per group of `by` columns."""
    y, p = F.col(label), F.col(prediction)
    aggs = [scorer(n)(y, p, n_covariates).alias(n) for n in names]
    return predictions.groupBy(*by).agg(*aggs)


def mean_scores(per_fold: DataFrame, names: Sequence[str], prefix: str) -> DataFrame:
    """Unweighted mean over folds as one row, columns `<prefix>_<scorer>`."""
    return per_fold.agg(*[F.avg(n).alias(f"{prefix}_{n}") for n in names])


def long_scores(row: DataFrame) -> DataFrame:
    """One-row wide scores to (score_name, score)."""
    pairs = ", ".join(f"'{c}', `{c}`" for c in row.columns)
    return row.selectExpr(f"stack({len(row.columns)}, {pairs}) AS (score_name, score)")


def keep_known_scores(scores: Column, names: Sequence[str]) -> Column:
    """Drop map entries whose name contains none of the scorer names."""

    def wanted(key: Column, _value: Column) -> Column:
        hit = F.lit(False)
        for n in names:
            hit = hit | key.contains(n)
        return hit

    return F.map_filter(scores, wanted)


def interleave(predictions: DataFrame, label: str = "y_oos", prediction: str = "y_pred") -> DataFrame:
    """Long form (iteration, label, data_point): one row per value pair member."""
    return predictions.selectExpr(
        "iteration",
        f"stack(2, 'y_pred', CAST({prediction} AS DOUBLE), 'y_oos', CAST({label} AS DOUBLE)) AS (label, data_point)",
    )
