"""Tables behind the exploration charts."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .gram import moments

MAX_BINS = 10
# Width and height of the density canvas.
CANVAS = (850, 500)


def nice_step(low: float, high: float, max_bins: int = MAX_BINS) -> float:
    """Smallest of 1, 2, 5 times a power of ten that needs at most max_bins steps."""
    span = (high - low) or abs(low) or 1.0
    power = math.floor(math.log10(span)) - 3
    while True:
        for digit in (1, 2, 5):
            step = float(f"{digit}e{power}")
            if span / step <= max_bins:
                return step
        power += 1


def _named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def melt(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., covariate, value) with one row per covariate."""
    pairs = [v for c in columns for v in (F.lit(c), _named(c).cast("double"))]
    return df.select(*keep, F.stack(F.lit(len(columns)), *pairs).alias("covariate", "value"))


def histogram(df: DataFrame, columns: Sequence[str], max_bins: int = MAX_BINS) -> DataFrame:
    """(covariate, bin_start, bin_end, n) for all covariates in one pass after min/max.

    A task counts whole batches into one short array per covariate, so neither
    values nor rows are multiplied.  Nulls and values that are not finite are
    left out.
    """
    plain = df.select(*[_named(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    inside = [F.when(F.abs(F.col(c)) < float("inf"), F.col(c)) for c in plain.columns]
    ends = plain.agg(*[f(v) for v in inside for f in (F.min, F.max)]).first()
    spans = {i: (ends[2 * i], ends[2 * i + 1]) for i in range(len(columns)) if ends[2 * i] is not None}
    steps = {i: nice_step(lo, hi, max_bins) for i, (lo, hi) in spans.items()}
    first = {i: math.floor(spans[i][0] / s) for i, s in steps.items()}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {i: np.zeros(math.floor(spans[i][1] / s) - first[i] + 1, np.int64) for i, s in steps.items()}
        for b in batches:
            for i, step in steps.items():
                v = b.column(i).to_numpy(zero_copy_only=False)
                bins = np.floor(v[np.isfinite(v)] / step).astype(np.int64) - first[i]
                counts[i] += np.bincount(bins, minlength=len(counts[i]))
        rows = [(i, first[i] + k, n) for i, c in counts.items() for k, n in enumerate(c.tolist()) if n]
        made = np.array(rows, np.int64).reshape(-1, 3)
        yield pa.RecordBatch.from_arrays([pa.array(made[:, j]) for j in range(3)], ["column", "bin", "n"])

    found = plain.mapInArrow(count, "column long, bin long, n long").groupBy("column", "bin").agg(F.sum("n").alias("n"))
    names = F.array(*[F.lit(c) for c in columns])
    sizes = F.array(*[F.lit(steps.get(i)).cast("double") for i in range(len(columns))])
    step = F.get(sizes, F.col("column").cast("int"))
    return found.select(
        F.get(names, F.col("column").cast("int")).alias("covariate"), (F.col("bin") * step).alias("bin_start"),
        ((F.col("bin") + 1) * step).alias("bin_end"), "n",
    )


def point_density(df: DataFrame, width: int = CANVAS[0], height: int = CANVAS[1], x: str = "x", y: str = "y") -> DataFrame:
    """(px, py, n, shade): points per pixel and the log shade."""
    e = df.agg(F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1")).first()

    def pixel(name: str, low: float, high: float, size: int):
        span = (high - low) or 1.0
        return F.least(F.floor((F.col(name) - F.lit(low)) / F.lit(span) * F.lit(size)), F.lit(size - 1)).cast("int")

    if e["x0"] is None:
        e = {"x0": 0.0, "x1": 0.0, "y0": 0.0, "y1": 0.0}
    return (
        df.select(pixel(x, e["x0"], e["x1"], width).alias("px"), pixel(y, e["y0"], e["y1"], height).alias("py"))
        .groupBy("px", "py")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("shade", F.log1p(F.col("n").cast("double")))
    )


def scatter(df: DataFrame, columns: Sequence[str], label: str = "target", x: str = "x", y: str = "y") -> DataFrame:
    """(covariate, value, target, x, y): every point against every covariate."""
    return melt(df, columns, keep=[label, x, y])


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, r) for every pair; all pairs come from one aggregation."""
    m = moments(df, columns[:-1], columns[-1])[0]
    rows = []
    for i, a in enumerate(columns):
        for j, b in enumerate(columns):
            spread = math.sqrt(m.cross[i, i] * m.cross[j, j])
            rows.append((a, b, float(m.cross[i, j] / spread) if spread > 0 else None))
    return df.sparkSession.createDataFrame(rows, "a string, b string, r double")


def collinear(corr: DataFrame, limit: float = 0.999) -> DataFrame:
    """Pairs that are (nearly) multiples of each other."""
    return corr.filter((F.col("a") < F.col("b")) & (F.abs("r") >= limit))
