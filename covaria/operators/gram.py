"""Linear least squares from cross-product sums.

One aggregation per data set yields, for every fold, the row count, the
column means and the centred cross products of features and target.  From
these few numbers any fold can be left out, any feature dropped and any
squared-error score computed without touching the data again.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

# Tasks get this module's helpers with the closure, whether or not the package
# is installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Up to this many columns the sums are built-in covariance aggregates; wider
# tables would blow up generated code, so Arrow batches feed matrix products.
BUILTIN_WIDTH = 12
_MERGE_GROUPS = 512
# Cross products travel in square blocks of this many columns.
BLOCK = 64


@dataclass(frozen=True)
class Moments:
    """Count, means and centred cross products of [features..., target]."""

    n: float
    mean: np.ndarray
    cross: np.ndarray

    @staticmethod
    def empty(width: int) -> "Moments":
        return Moments(0.0, np.zeros(width), np.zeros((width, width)))

    def merge(self, other: "Moments") -> "Moments":
        if self.n == 0:
            return other
        if other.n == 0:
            return self
        n = self.n + other.n
        gap = other.mean - self.mean
        mean = self.mean + gap * (other.n / n)
        cross = self.cross + other.cross + np.outer(gap, gap) * (self.n * other.n / n)
        return Moments(n, mean, cross)

    def pick(self, index: Sequence[int]) -> "Moments":
        index = list(index)
        return Moments(self.n, self.mean[index], self.cross[np.ix_(index, index)])


def merge_all(parts: Iterable[Moments], width: int) -> Moments:
    total = Moments.empty(width)
    for part in parts:
        total = total.merge(part)
    return total


@dataclass(frozen=True)
class LinearFit:
    weights: np.ndarray
    intercept: float

    def expression(self, features: Sequence[str]) -> Column:
        out = F.lit(float(self.intercept))
        for name, w in zip(features, self.weights):
            out = out + F.lit(float(w)) * F.col(name).cast("double")
        return out


def fit_moments(m: Moments, ridge: float = 0.0) -> LinearFit:
    """Least squares of the last column on the others."""
    p = len(m.mean) - 1
    if p == 0 or m.n == 0:
        return LinearFit(np.zeros(p), float(m.mean[-1]) if m.n else 0.0)
    scale = np.sqrt(np.diag(m.cross)[:p] / m.n)
    live = scale > 0
    weights = np.zeros(p)
    if live.any():
        s = scale[live]
        a = m.cross[:p, :p][np.ix_(live, live)] / np.outer(s, s) / m.n
        b = m.cross[:p, p][live] / s / m.n
        # lstsq gives the minimum-norm solution for collinear features.
        solved = np.linalg.lstsq(a + ridge * np.eye(len(s)), b, rcond=1e-12)[0]
        weights[live] = solved / s
    return LinearFit(weights, float(m.mean[p] - weights @ m.mean[:p]))


def squared_scores(fit: LinearFit, test: Moments) -> dict[str, float]:
    """Squared-error scores of a fit on data known only by its moments."""
    p = len(test.mean) - 1
    w = fit.weights
    bias = test.mean[p] - fit.intercept - w @ test.mean[:p]
    sst = float(test.cross[p, p])
    sse = float(sst - 2 * w @ test.cross[:p, p] + w @ test.cross[:p, :p] @ w + test.n * bias**2)
    sse = max(sse, 0.0)
    mse = sse / test.n if test.n else float("nan")
    r2 = 1 - sse / sst if sst > 0 else (1.0 if sse == 0 else 0.0)
    free = test.n - p - 1
    adjusted = max(1 - (1 - r2) * (test.n - 1) / free, 0.0) if free > 0 else None
    return {
        "mean_squared_error_scorer": -mse,
        "rmse_scorer": -float(np.sqrt(mse)),
        "r2_scorer": r2,
        "adjusted_r2_scorer": adjusted,
    }


MOMENT_SCORERS = frozenset({"mean_squared_error_scorer", "rmse_scorer", "r2_scorer", "adjusted_r2_scorer"})


def _builtin_moments(df: DataFrame, columns: Sequence[str], by: str | None) -> dict[int, Moments]:
    as_double = [F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)]
    table = df.select(*([F.col(by).alias("_by")] if by else []), *as_double)
    width = len(columns)
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.avg(f"_{i}").alias(f"m{i}") for i in range(width)]
    aggs += [F.covar_pop(f"_{i}", f"_{j}").alias(f"c{i}_{j}") for i in range(width) for j in range(i, width)]
    grouped = table.groupBy("_by") if by else table.groupBy()
    out: dict[int, Moments] = {}
    # One row per fold.
    for row in grouped.agg(*aggs).collect():
        n = float(row["n"])
        if n == 0:
            continue
        cross = np.zeros((width, width))
        for i in range(width):
            for j in range(i, width):
                cross[i, j] = cross[j, i] = row[f"c{i}_{j}"] * n
        out[row["_by"] if by else 0] = Moments(n, np.array([row[f"m{i}"] for i in range(width)]), cross)
    return out


_PARTIAL = "fold long, bucket int, i int, j int, n double, mean_i array<double>, mean_j array<double>, cross array<double>"


def _block_rows(fold: int, bucket: int, m: Moments, block: int) -> Iterator[dict]:
    """The upper triangle of the cross products, block by block."""
    cuts = [slice(k, k + block) for k in range(0, len(m.mean), block)]
    for i, a in enumerate(cuts):
        for j, b in enumerate(cuts[i:], i):
            yield {
                "fold": fold, "bucket": bucket, "i": i, "j": j, "n": m.n, "mean_i": m.mean[a].tolist(), "mean_j": m.mean[b].tolist(),
                "cross": m.cross[a, b].ravel().tolist(),
            }


def _batch_moments(width: int, weighted: bool, block: int):
    def partials(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        context = TaskContext.get()
        bucket = (context.partitionId() if context else 0) % _MERGE_GROUPS
        held: dict[int, Moments] = {}
        for batch in batches:
            folds = batch["fold"].to_numpy()
            values = batch.iloc[:, 1 : 1 + width].to_numpy(dtype=float)
            weight = batch["weight"].to_numpy(dtype=float) if weighted else None
            for fold in np.unique(folds):
                at = folds == fold
                x = values[at]
                w = weight[at] if weighted else np.ones(len(x))
                total = w.sum()
                if total <= 0:
                    continue
                mean = w @ x / total
                centred = x - mean
                part = Moments(float(total), mean, (centred * w[:, None]).T @ centred)
                held[int(fold)] = held.get(int(fold), Moments.empty(width)).merge(part)
        for fold, m in held.items():
            yield pd.DataFrame(list(_block_rows(fold, bucket, m, block)))

    return partials


def _merge_blocks(rows: pd.DataFrame) -> pd.DataFrame:
    """One block of one fold: counts, means of its rows and columns, and its cross products."""
    n, total = 0.0, None
    for r in rows.itertuples(index=False):
        a, b = np.asarray(r.mean_i), np.asarray(r.mean_j)
        cross = np.asarray(r.cross).reshape(len(a), len(b))
        if total is None:
            n, mean_i, mean_j, total = r.n, a, b, cross
            continue
        both = n + r.n
        gap_i, gap_j = a - mean_i, b - mean_j
        total = total + cross + np.outer(gap_i, gap_j) * (n * r.n / both)
        mean_i, mean_j = mean_i + gap_i * (r.n / both), mean_j + gap_j * (r.n / both)
        n = both
    first = rows.iloc[0]
    return pd.DataFrame([{
        "fold": int(first["fold"]), "bucket": 0, "i": int(first["i"]), "j": int(first["j"]), "n": n,
        "mean_i": mean_i.tolist(), "mean_j": mean_j.tolist(), "cross": total.ravel().tolist(),
    }])


def _batched_moments(df: DataFrame, columns: Sequence[str], by: str | None, weight: str | None) -> dict[int, Moments]:
    width = len(columns)
    # The keys keep their type, and null is a key: batches see their places in this list.
    keys = [r[0] for r in df.select(by).distinct().collect()] if by else [0]  # one row per fold
    fold = F.lit(0)
    for place, key in enumerate(keys if by else []):
        fold = F.when(F.col(by).eqNullSafe(F.lit(key)), F.lit(place)).otherwise(fold)
    fold = fold.cast("long")
    table = df.select(
        fold.alias("fold"),
        *[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)],
        *([F.col(weight).cast("double").alias("weight")] if weight else []),
    )
    partial = table.mapInPandas(_batch_moments(width, weight is not None, BLOCK), _PARTIAL)
    # Two merge levels: no group holds more than (tasks / 512) blocks, however many columns there are.
    merged = partial.groupBy("fold", "bucket", "i", "j").applyInPandas(_merge_blocks, _PARTIAL)
    final = merged.groupBy("fold", "i", "j").applyInPandas(_merge_blocks, _PARTIAL)
    out: dict[int, Moments] = {}
    # The matrix of each fold, which the solution needs as a whole.
    for r in final.collect():
        m = out.get(keys[int(r["fold"])])
        if m is None:
            m = out[keys[int(r["fold"])]] = Moments(r["n"], np.zeros(width), np.zeros((width, width)))
        a, b = r["i"] * BLOCK, r["j"] * BLOCK
        cross = np.array(r["cross"]).reshape(len(r["mean_i"]), len(r["mean_j"]))
        m.mean[a : a + BLOCK] = r["mean_i"]
        m.cross[a : a + BLOCK, b : b + BLOCK] = cross
        m.cross[b : b + BLOCK, a : a + BLOCK] = cross.T
    return out


def absolute_errors(
    df: DataFrame, features: Sequence[str], label: str, fits: dict[int, Sequence[tuple[Sequence[int], LinearFit]]], by: str | None = None
) -> dict[int, list[float]]:
    """Mean absolute error of several fits for each value of `by` (key 0 without one), in one pass.

    `fits` has for each key the same number of (places of features, fit).  A
    batch is one matrix product for all of them, so a pass costs the same
    generated code whatever their number.  Rows with a null are left out.
    """
    keys = [k for k in fits if k is not None]
    stacked = []
    for key in keys:
        weights = np.zeros((len(features) + 1, len(fits[key])))
        for k, (index, fit) in enumerate(fits[key]):
            weights[list(index), k] = fit.weights
            weights[-1, k] = fit.intercept
        stacked.append(weights)
    place = F.lit(0) if by is None else F.array_position(F.array(*[F.lit(k) for k in keys]), F.col(by)).cast("int") - 1
    table = df.select(place.alias("fold"), *[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate([*features, label])])
    table = table.dropna().filter("fold >= 0")

    def partials(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = [np.zeros(w.shape[1]) for w in stacked]
        counts = [0] * len(stacked)
        for batch in batches:
            folds = batch["fold"].to_numpy()
            values = batch.iloc[:, 1:].to_numpy(dtype=float)
            for fold in np.unique(folds):
                x = values[folds == fold]
                guess = x[:, :-1] @ stacked[fold][:-1] + stacked[fold][-1]
                sums[fold] += np.abs(guess - x[:, -1:]).sum(axis=0)
                counts[fold] += len(x)
        for fold, total in enumerate(sums):
            if counts[fold]:
                yield pd.DataFrame({"fold": fold, "fit": np.arange(len(total)), "n": counts[fold], "total": total})

    found = table.mapInPandas(partials, "fold int, fit int, n long, total double")
    rows = found.groupBy("fold", "fit").agg((F.sum("total") / F.sum("n")).alias("mean")).collect()  # folds times fits
    out = {key: [None] * len(fits[key]) for key in keys}
    for r in rows:
        out[keys[r["fold"]]][r["fit"]] = r["mean"]
    return out


def moments(
    df: DataFrame,
    features: Sequence[str],
    label: str = "target",
    by: str | None = None,
    weight: str | None = None,
    method: str = "auto",
) -> dict[int, Moments]:
    """Moments per value of the fold column (key 0 without one)."""
    columns = [*features, label]
    if method == "auto":
        method = "builtin" if weight is None and len(columns) <= BUILTIN_WIDTH else "batched"
    if method == "builtin":
        if weight is not None:
            raise ValueError("weights need the batched method")
        return _builtin_moments(df, columns, by)
    return _batched_moments(df, columns, by, weight)


def leave_one_out(folds: dict[int, Moments], fold: int) -> Moments:
    """Everything but one fold; merged, not subtracted, to keep precision."""
    width = len(next(iter(folds.values())).mean)
    return merge_all((m for f, m in folds.items() if f != fold), width)


def fold_fits(folds: dict[int, Moments], ridge: float = 0.0) -> dict[int, LinearFit]:
    return {f: fit_moments(leave_one_out(folds, f), ridge) for f in folds}


def fold_prediction(fits: dict[int, LinearFit], features: Sequence[str], by: str = "fold") -> Column:
    """Out-of-fold prediction as one expression: each row uses its fold's weights."""
    # Rows without a fold have no prediction.
    order = sorted(f for f in fits if f is not None)
    index = F.array_position(F.array(*[F.lit(f) for f in order]), F.col(by))

    def per_fold(values: list[float]) -> Column:
        return F.element_at(F.array(*[F.lit(float(v)) for v in values]), index.cast("int"))

    out = per_fold([fits[f].intercept for f in order])
    for i, name in enumerate(features):
        out = out + per_fold([fits[f].weights[i] for f in order]) * F.col(name).cast("double")
    return F.when(F.col(by).isNotNull(), out)
