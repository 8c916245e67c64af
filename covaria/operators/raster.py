"""Raster tables: bands, sampling at points, grids, masks, mosaics.

A raster is rows of `raster_cells` plus one row of `raster_meta`.  The one
thing the optimizer cannot do alone is turn "point lies in cell" into an
equi-join; computing (row, col) first does that.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from ..functions.naming import band_name
from ..functions.projection import GEOGRAPHIC, PROJECTED, check_crs, from_albers, to_albers
from ..schema import MISSING
from .joins import BROADCAST_ROWS, fits, is_small, lookup_join

TILE = 256


def _with_meta(df: DataFrame, meta: DataFrame, key: str) -> DataFrame:
    # One row per raster file: a list of names, not data; still checked.
    side = F.broadcast(meta) if is_small(meta) else meta
    return df.join(side, key)


def split_bands(cells: DataFrame, meta: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """One single-band covariate per band: (covariate, row, col, value).

    With `names` only these covariates.  They are turned into raster names and
    bands first, so the choice reaches the scan of the stored cells.
    """
    if names is not None:
        listed = band_meta(meta.withColumn("_raster", F.col("raster"))).filter(F.col("covariate").isin(list(names)))
        stored = [(r["_raster"], r["band"]) for r in listed.select("_raster", "band").collect()]  # metadata only
        by_raster: dict[str, list[int]] = {}
        for raster, band in stored:
            by_raster.setdefault(raster, []).append(band)
        chosen = F.lit(False)
        for raster, bands in by_raster.items():
            chosen = chosen | ((F.col("raster") == raster) & F.col("band").isin(bands))
        cells = cells.filter(chosen)
    named = _with_meta(cells, meta.select("raster", "n_bands"), "raster")
    return named.select(
        band_name(F.col("raster"), F.col("band"), F.col("n_bands")).alias("covariate"), "row", "col", "value"
    )


def band_meta(meta: DataFrame) -> DataFrame:
    """The covariate list that `split_bands` yields, with its geometry."""
    exploded = meta.withColumn("band", F.explode(F.sequence(F.lit(1), F.col("n_bands"))))
    return exploded.withColumn("covariate", band_name(F.col("raster"), F.col("band"), F.col("n_bands"))).drop("raster")


def extent(meta: DataFrame) -> DataFrame:
    """Bounds of the union of the rasters."""
    return meta.agg(
        F.min("x0").alias("x_min"),
        F.min(F.col("y0") - F.col("dy") * F.col("height")).alias("y_min"),
        F.max(F.col("x0") + F.col("dx") * F.col("width")).alias("x_max"),
        F.max("y0").alias("y_max"),
    )


def cell_of(x: Column, y: Column, meta: Row | None = None) -> tuple[Column, Column]:
    """(row, col) of the half-open cell that holds the point."""
    if meta is None:
        x0, y0, dx, dy = (F.col(c) for c in ("x0", "y0", "dx", "dy"))
    else:
        x0, y0, dx, dy = (F.lit(float(meta[c])) for c in ("x0", "y0", "dx", "dy"))
    return F.floor((y0 - y) / dy).cast("int"), F.floor((x - x0) / dx).cast("int")


def stack(cells: DataFrame, names: Sequence[str]) -> DataFrame:
    """Aligned single-band covariates side by side: (row, col, <names>).

    A fixed name list needs no extra job, and the partial aggregation merges
    cells before the shuffle.
    """
    picked = [F.max(F.when(F.col("covariate") == n, F.col("value"))).alias(n) for n in names]
    return cells.filter(F.col("covariate").isin(list(names))).groupBy("row", "col").agg(*picked)


def _grid_groups(meta: DataFrame, names: Sequence[str]) -> tuple[list[tuple[Row, list[str]]], dict[str, Row]]:
    """Covariates by common grid.  Metadata only: one row per covariate."""
    rows = {r["covariate"]: r for r in meta.filter(F.col("covariate").isin(list(names))).collect()}
    absent = [n for n in names if n not in rows]
    if absent:
        raise ValueError(f"no such covariate: {absent}")
    groups: dict[tuple, list[str]] = {}
    for n in names:
        r = rows[n]
        groups.setdefault((r["x0"], r["y0"], r["dx"], r["dy"], r["width"], r["height"]), []).append(n)
    return [(rows[g[0]], g) for g in groups.values()], rows


def sample_at_points(
    points: DataFrame,
    cells: DataFrame,
    meta: DataFrame,
    names: Sequence[str],
    outside: str = "nodata",
    x: str = "x",
    y: str = "y",
    unique: Row | dict[str, Any] | None = None,
) -> DataFrame:
    """Add one column per covariate: the value of the cell under each point.

    If the points are few and a grid is large, only the cells under them are stacked.  `unique`
    is a grid that has one point in each cell: there no hot cell is looked for.

    Covariates on one grid are stacked first, so the points travel once per
    grid, not once per covariate, and need no pivot afterwards.  Outside the
    extent the value is the covariate's nodata number, or 0 if it has none;
    `outside="null"` gives null there.  Missing cells inside get nodata.
    """
    out = points
    groups, info = _grid_groups(meta, names)
    large = any(grid["width"] * grid["height"] > BROADCAST_ROWS for grid, _ in groups)
    few = large and unique is None and fits(points.select(x, y), points.count())
    for grid, members in groups:
        row, col = cell_of(F.col(x), F.col(y), grid)
        placed = out.withColumns({"row": row, "col": col})
        inside = F.col("row").between(0, grid["height"] - 1) & F.col("col").between(0, grid["width"] - 1)
        # The cells under the points, whatever grids were sampled before.
        places = points.select(row.alias("row"), col.alias("col"))
        near = cells.filter(inside)
        if few:
            near = near.join(F.broadcast(places.filter(inside)), ["row", "col"], "left_semi")
        # One row per cell of the extent: the metadata bounds the lookup side.
        wide = stack(near, members)
        alone = unique is not None and all(grid[k] == unique[k] for k in ("x0", "y0", "dx", "dy"))
        joined = lookup_join(
            placed, wide, ["row", "col"], "left", bound=grid["width"] * grid["height"], unique_left=alone, probe=places
        )
        filled: dict[str, Column] = {}
        for n in members:
            nodata = info[n]["nodata"]
            blank = F.lit(None).cast("float") if outside == "null" else F.lit(float(nodata or 0.0)).cast("float")
            gap = F.lit(None if nodata is None else float(nodata)).cast("float")
            filled[n] = F.when(inside, F.coalesce(F.col(n), gap)).otherwise(blank)
        out = joined.withColumns(filled).drop("row", "col")
    return out.select(*points.columns, *names)


def tiles(cells: DataFrame, size: int = TILE) -> DataFrame:
    """Cells packed into square tiles: (covariate, tile_row, tile_col, values).

    A tile never holds more than size * size cells, so the collected list is
    bounded.
    """
    index = F.pmod(F.col("row"), F.lit(size)) * F.lit(size) + F.pmod(F.col("col"), F.lit(size))
    packed = cells.groupBy(
        "covariate",
        F.floor(F.col("row") / size).cast("int").alias("tile_row"),
        F.floor(F.col("col") / size).cast("int").alias("tile_col"),
    ).agg(F.collect_list(F.struct(index.cast("int").alias("i"), F.col("value"))).alias("_cells"))
    # Slots without a cell join the list as nulls; one sort brings all into place.
    slots = F.array_except(F.sequence(F.lit(0), F.lit(size * size - 1)), F.transform("_cells", lambda c: c["i"]))
    blank = F.lit(None).cast(cells.schema["value"].dataType)
    empty = F.transform(slots, lambda i: F.struct(i.alias("i"), blank.alias("value")))
    return packed.select(
        "covariate", "tile_row", "tile_col",
        F.transform(F.array_sort(F.concat("_cells", empty)), lambda c: c["value"]).alias("values"),
    )


def sample_tiles_at_points(
    points: DataFrame, tiled: DataFrame, meta: DataFrame, names: Sequence[str], size: int = TILE, x: str = "x", y: str = "y"
) -> DataFrame:
    """As `sample_at_points`, from tiles: points meet tiles, and each takes its slot of the tile.

    The shuffle moves one row per tile of the lookup side instead of one per
    cell; points of a crowded tile are dealt out.
    """
    out = points
    groups, info = _grid_groups(meta, names)
    for grid, members in groups:
        row, col = cell_of(F.col(x), F.col(y), grid)
        inside = row.between(0, grid["height"] - 1) & col.between(0, grid["width"] - 1)
        place = {"tile_row": F.floor(row / size).cast("int"), "tile_col": F.floor(col / size).cast("int")}
        placed = out.withColumns({**place, "_inside": inside, "_slot": F.pmod(row, F.lit(size)) * size + F.pmod(col, F.lit(size)) + 1})
        wide = tiled.filter(F.col("covariate").isin(members)).groupBy("tile_row", "tile_col").agg(
            *[F.first(F.when(F.col("covariate") == n, F.col("values")), ignorenulls=True).alias(f"_t{i}") for i, n in enumerate(members)]
        )
        # A tile is too wide for a broadcast by rows: count cells.
        tile_count = math.ceil(grid["width"] / size) * math.ceil(grid["height"] / size)
        joined = lookup_join(
            placed, wide, ["tile_row", "tile_col"], "left", bound=tile_count * size * size, probe=points.select(*[c.alias(k) for k, c in place.items()])
        )
        filled: dict[str, Column] = {}
        for i, n in enumerate(members):
            nodata = info[n]["nodata"]
            gap = F.lit(None if nodata is None else float(nodata)).cast("float")
            value = F.coalesce(F.get(F.col(f"_t{i}"), F.col("_slot") - 1), gap)
            filled[n] = F.when(F.col("_inside"), value).otherwise(F.lit(float(nodata or 0.0)).cast("float"))
        out = joined.withColumns(filled).drop("tile_row", "tile_col", "_inside", "_slot", *[f"_t{i}" for i in range(len(members))])
    return out.select(*points.columns, *names)


def untile(tiled: DataFrame, size: int = TILE) -> DataFrame:
    return (
        tiled.select("covariate", "tile_row", "tile_col", F.posexplode("values").alias("i", "value"))
        .filter(F.col("value").isNotNull())
        .select(
            "covariate",
            (F.col("tile_row") * size + F.floor(F.col("i") / size)).cast("int").alias("row"),
            (F.col("tile_col") * size + F.pmod("i", F.lit(size))).cast("int").alias("col"),
            "value",
        )
    )


@dataclass(frozen=True)
class GridAxes:
    """Half-open integer ranges lo, lo+step, ... < hi for x and y."""

    x_lo: int
    x_hi: int
    x_step: int
    y_lo: int
    y_hi: int
    y_step: int

    @property
    def nx(self) -> int:
        return max(0, math.ceil((self.x_hi - self.x_lo) / self.x_step))

    @property
    def ny(self) -> int:
        return max(0, math.ceil((self.y_hi - self.y_lo) / self.y_step))


def grid_axes(meta: Row | dict[str, Any]) -> GridAxes:
    """Prediction axes of an area raster; bounds and steps round half to even."""
    left, top = round(meta["x0"]), round(meta["y0"])
    right = round(meta["x0"] + meta["dx"] * meta["width"])
    bottom = round(meta["y0"] - meta["dy"] * meta["height"])
    step_x, step_y = max(abs(round(meta["dx"])), 1), max(abs(round(meta["dy"])), 1)
    return GridAxes(left + 1, right, step_x, bottom + 1, top, step_y)


def prediction_grid(spark: SparkSession, axes: GridAxes) -> DataFrame:
    """(x, y) int32 points by division of one range: no cross join, no shuffle."""
    nx = axes.nx
    cells = spark.range(nx * axes.ny)
    return cells.select(
        (F.lit(axes.x_lo) + F.pmod("id", F.lit(max(nx, 1))) * F.lit(axes.x_step)).cast("int").alias("x"),
        (F.lit(axes.y_lo) + F.floor(F.col("id") / F.lit(max(nx, 1))) * F.lit(axes.y_step)).cast("int").alias("y"),
    )


def mosaic(strips: DataFrame, order: str = "strip", bounds: tuple[float, float, float, float] | None = None) -> DataFrame:
    """One value per cell: the first strip that has one wins.

    min_by merges before the shuffle, so a cell covered by very many strips
    is no hot group.
    """
    scope = strips.filter(F.col("value").isNotNull())
    if bounds is not None:
        left, bottom, right, top = bounds
        scope = scope.filter(
            (F.col("x") >= left) & (F.col("x") < right) & (F.col("y") > bottom) & (F.col("y") <= top)
        )
    return scope.groupBy("row", "col").agg(F.min_by("value", order).alias("value"))


def apply_mask(
    grid: DataFrame,
    mask: DataFrame,
    column: str = "value",
    nodata: float | None = MISSING,
    zero_outside: bool = False,
    missing: float = MISSING,
) -> DataFrame:
    """Cells outside the mask become -9999: absent, null or nodata there, and 0 if asked."""
    value = F.col("value")
    keep = value.isNotNull() & ~F.isnan(value)
    if nodata is not None:
        keep = keep & (value != F.lit(nodata))
    if zero_outside:
        keep = keep & (value != 0)
    inside = mask.filter(keep).select("row", "col", F.lit(True).alias("_inside"))
    # A map has one row per cell.
    joined = lookup_join(grid, inside, ["row", "col"], "left", unique_left=True)
    return joined.withColumn(
        column, F.when(F.col("_inside"), F.col(column)).otherwise(F.lit(missing))
    ).drop("_inside")


def _crs_of(source: Row | dict[str, Any]) -> str:
    """The raster's code; without one, degrees."""
    found = source.asDict() if isinstance(source, Row) else source
    return check_crs(found.get("crs") or GEOGRAPHIC[0])


def suggested_grid(spark: SparkSession, source: Row | dict[str, Any], steps: int = 21) -> dict[str, Any]:
    """A projected grid for a raster in degrees or in a zone: its outline's
    bounds, square cells that keep the number of cells along the diagonal."""
    width, height = int(source["width"]), int(source["height"])
    along = spark.range(steps * steps).select(
        (F.pmod("id", F.lit(steps)) / F.lit(steps - 1)).alias("u"), (F.floor(F.col("id") / steps) / F.lit(steps - 1)).alias("w")
    )
    lon = F.lit(float(source["x0"])) + F.col("u") * F.lit(float(source["dx"]) * width)
    lat = F.lit(float(source["y0"])) - F.col("w") * F.lit(float(source["dy"]) * height)
    x, y = to_albers(lon, lat, _crs_of(source))
    corner = (F.col("u") == F.col("w")) & F.col("u").isin(0.0, 1.0)
    e = along.select(x.alias("x"), y.alias("y"), F.when(corner, F.col("u")).alias("corner")).agg(
        F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y1"), F.max("y").alias("y0"),
        F.max(F.when(F.col("corner") == 0, F.col("x"))).alias("ax"), F.max(F.when(F.col("corner") == 0, F.col("y"))).alias("ay"),
        F.max(F.when(F.col("corner") == 1, F.col("x"))).alias("bx"), F.max(F.when(F.col("corner") == 1, F.col("y"))).alias("by"),
    ).first()
    step = math.hypot(e["bx"] - e["ax"], e["by"] - e["ay"]) / math.hypot(width, height)
    return {
        "x0": e["x0"], "y0": e["y0"], "dx": step, "dy": step, "nodata": source["nodata"],
        "width": max(1, int((e["x1"] - e["x0"]) / step + 0.5)), "height": max(1, int((e["y0"] - e["y1"]) / step + 0.5)),
    }


def reproject(
    cells: DataFrame, source: Row | dict[str, Any], target: Row | dict[str, Any], spark: SparkSession
) -> DataFrame:
    """Nearest-cell copy of a raster in degrees or in a zone (its `crs`) onto an EPSG:3577 grid.

    Every target cell centre is mapped back, so each target cell is produced
    once and gaps cannot appear.
    """
    width, height = int(target["width"]), int(target["height"])
    base = spark.range(width * height).select(
        F.floor(F.col("id") / F.lit(width)).cast("int").alias("row_out"),
        F.pmod("id", F.lit(width)).cast("int").alias("col_out"),
    )
    x = F.lit(float(target["x0"])) + (F.col("col_out") + F.lit(0.5)) * F.lit(float(target["dx"]))
    y = F.lit(float(target["y0"])) - (F.col("row_out") + F.lit(0.5)) * F.lit(float(target["dy"]))
    lon, lat = from_albers(x, y, _crs_of(source))
    placed = base.withColumns({"_lon": lon, "_lat": lat})
    row = F.floor((F.lit(float(source["y0"])) - F.col("_lat")) / F.lit(float(source["dy"]))).cast("int")
    col = F.floor((F.col("_lon") - F.lit(float(source["x0"]))) / F.lit(float(source["dx"]))).cast("int")
    # The source grid bounds its cells, so they need not be counted.
    found = lookup_join(
        placed.select("row_out", "col_out", row.alias("row"), col.alias("col")), cells, ["row", "col"], "left",
        bound=int(source["width"]) * int(source["height"]), unique_left=True,
    )
    nodata = source["nodata"]
    gap = F.lit(None if nodata is None else float(nodata)).cast("float")
    return found.select(
        F.col("row_out").alias("row"), F.col("col_out").alias("col"), F.coalesce("value", gap).alias("value")
    )


def to_projection(
    spark: SparkSession, cells: DataFrame, meta: DataFrame, grid: Row | dict[str, Any] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Bring the covariates of other coordinate systems onto grids of EPSG:3577: (cells, meta).

    `meta` may have a column `crs`; a null there, or no such column, means
    that a covariate is projected already, and an unknown code is an error.
    The new grid is `grid`, or for each covariate the one that
    `suggested_grid` finds.  Only metadata comes to the driver, one row for
    each covariate.
    """
    if "crs" not in meta.columns:
        return cells, meta
    others = [r for r in meta.collect() if check_crs(r["crs"]) != PROJECTED]
    if not others:
        return cells, meta
    names = [r["covariate"] for r in others]
    out = cells.filter(~F.col("covariate").isin(names)).select("covariate", "row", "col", "value")
    rows = []
    for r in others:
        target = dict(grid.asDict() if isinstance(grid, Row) else grid) if grid is not None else suggested_grid(spark, r)
        one = cells.filter(F.col("covariate") == r["covariate"]).select("row", "col", "value")
        out = out.unionByName(reproject(one, r, target, spark).select(F.lit(r["covariate"]).alias("covariate"), "row", "col", "value"))
        place = {k: target[k] for k in ("x0", "y0", "dx", "dy", "width", "height")}
        rows.append({**r.asDict(), **place, "crs": PROJECTED})
    moved = spark.createDataFrame(rows, meta.schema)
    return out, meta.filter(F.col("crs").isNull() | (F.col("crs") == PROJECTED)).unionByName(moved)
