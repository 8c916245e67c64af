"""Prediction maps over an area of interest."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from ..models.base import Fitted
from ..schema import MISSING
from .raster import apply_mask, cell_of, grid_axes, prediction_grid, sample_at_points


def grid_features(
    spark: SparkSession, area: Row | dict[str, Any], cells: DataFrame, meta: DataFrame, features: Sequence[str]
) -> DataFrame:
    """(row, col, x, y, features...) for every grid point; gaps hold -9999."""
    grid = prediction_grid(spark, grid_axes(area))
    row, col = cell_of(F.col("x"), F.col("y"), area)
    sampled = sample_at_points(grid, cells, meta, features, unique=area)
    return sampled.select(row.alias("row"), col.alias("col"), "*").na.fill(MISSING, list(features))


def score_map(
    spark: SparkSession,
    area: Row | dict[str, Any],
    cells: DataFrame,
    meta: DataFrame,
    features: Sequence[str],
    predict: Callable[[DataFrame], DataFrame],
    mask: DataFrame | None = None,
    nodata: float | None = MISSING,
) -> DataFrame:
    """(row, col, x, y, value); `predict` adds the value column.  Outside the mask: -9999."""
    points = grid_features(spark, area, cells, meta, features)
    scored = predict(points).select("row", "col", "x", "y", "value")
    return scored if mask is None else apply_mask(scored, mask, "value", nodata)


def prediction_map(
    spark: SparkSession,
    area: Row | dict[str, Any],
    cells: DataFrame,
    meta: DataFrame,
    model: Fitted,
    mask: DataFrame | None = None,
    nodata: float | None = MISSING,
) -> DataFrame:
    def predict(points: DataFrame) -> DataFrame:
        # Row number on the grid: a neighbour model looks rows up by key.
        keyed = points.withColumn("key", F.concat_ws("/", "row", "col"))
        return model.transform(keyed, "value")

    return score_map(spark, area, cells, meta, model.features, predict, mask, nodata)
