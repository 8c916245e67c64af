"""Squared-log-error objective: gradient and second derivative."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def gradient(p: Column, y: Column) -> Column:
    return (F.log1p(p) - F.log1p(y)) / (p + F.lit(1.0))


def hessian(p: Column, y: Column) -> Column:
    return (F.log1p(y) - F.log1p(p) + F.lit(1.0)) / F.pow(p + F.lit(1.0), F.lit(2.0))


def squared_log(p: Column, y: Column) -> Column:
    """struct(grad, hess); predictions below -1 are lifted to just above it."""
    lifted = F.when(p < -1, F.lit(-1 + 1e-6)).otherwise(p)
    return F.struct(gradient(lifted, y).alias("grad"), hessian(lifted, y).alias("hess"))
