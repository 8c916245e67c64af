"""Maps made tile by tile: sampling, reprojection, prediction and masking on arrays of 256 x 256 cells.

A map is cut into square tiles of its own row and column numbers.  For every
tile the numbers of the source tiles under it are worked out first, so only
tiles are shuffled, each once for every map tile that reads it.  All work on
single cells is done inside the arrays.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from ..functions.projection import from_albers
from ..models.base import Fitted
from ..schema import MISSING
from .joins import lookup_join, row_bytes
from .raster import TILE, _crs_of, _grid_groups, grid_axes

MASK = "_mask"


@dataclass(frozen=True)
class Lattice:
    """Cell (r, c) of a map stands at (x + c * dx, y + r * dy)."""

    x: float
    dx: float
    nx: int
    y: float
    dy: float
    ny: int

    def shape(self, tile_row: int, tile_col: int, size: int) -> tuple[int, int]:
        return max(0, min(size, self.ny - tile_row * size)), max(0, min(size, self.nx - tile_col * size))

    def places(self, tile_row: int, tile_col: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        """x and y of the cells of a tile, as two arrays of its shape."""
        h, w = self.shape(tile_row, tile_col, size)
        x = self.x + (tile_col * size + np.arange(w)) * self.dx
        y = self.y + (tile_row * size + np.arange(h)) * self.dy
        return np.broadcast_to(x, (h, w)), np.broadcast_to(y[:, None], (h, w))


@dataclass(frozen=True)
class Layer:
    """Rasters on one grid, in the map's own system or in `crs`.

    A map cell outside the grid gets `outside`, a missing source cell `gap`
    (each by name, None for null).
    """

    names: tuple[str, ...]
    x0: float
    y0: float
    dx: float
    dy: float
    width: int
    height: int
    outside: dict[str, float | None]
    gap: dict[str, float | None]
    crs: str | None = None

    def cells(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, column, and whether the grid has the cell, for points of the map."""
        if self.crs is not None:
            x, y = from_albers(x, y, self.crs)
        row, col = np.floor((self.y0 - y) / self.dy), np.floor((x - self.x0) / self.dx)
        with np.errstate(invalid="ignore"):
            inside = (row >= 0) & (row < self.height) & (col >= 0) & (col < self.width)
        return np.where(inside, row, 0).astype(np.int64), np.where(inside, col, 0).astype(np.int64), inside


def _layer(names: Sequence[str], grid: Row | dict[str, Any], outside: dict, gap: dict, crs: str | None = None) -> Layer:
    place = [float(grid[k]) for k in ("x0", "y0", "dx", "dy")]
    return Layer(tuple(names), *place, int(grid["width"]), int(grid["height"]), outside, gap, crs)


def _needs(spark: SparkSession, lattice: Lattice, layers: Sequence[Layer], size: int) -> DataFrame:
    """(out_row, out_col, layer, tile_row, tile_col): the source tiles under each map tile, at least one row for each."""
    across, down = math.ceil(lattice.nx / size), math.ceil(lattice.ny / size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple[int, int, int, int, int]] = []
            for i in b.column(0).to_pylist():
                at = divmod(i, across)
                x, y = lattice.places(*at, size)
                for k, layer in enumerate(layers):
                    row, col, inside = layer.cells(x, y)
                    met = np.unique(np.stack([row[inside] // size, col[inside] // size], axis=1), axis=0)
                    rows += [(*at, k, r, c) for r, c in met.tolist()] or [(*at, k, -1, -1)]
            made = np.array(rows, np.int32).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays([pa.array(made[:, j]) for j in range(5)], ["out_row", "out_col", "layer", "tile_row", "tile_col"])

    schema = "out_row int, out_col int, layer int, tile_row int, tile_col int"
    return spark.range(across * down).mapInArrow(run, schema)


def gather(spark: SparkSession, lattice: Lattice, tiled: DataFrame, layers: Sequence[Layer], size: int = TILE) -> DataFrame:
    """(tile_row, tile_col, one array per name): what lies under every cell of the map, tile by tile.

    `tiled` is what `raster.tiles` makes.  A task holds one map tile with the
    source tiles under it at a time.
    """
    names = [n for layer in layers for n in layer.names]
    owner = F.create_map(*[F.lit(v) for k, layer in enumerate(layers) for n in layer.names for v in (n, k)])
    listed = F.create_map(*[x for k, layer in enumerate(layers) for x in (F.lit(k), F.array(*map(F.lit, layer.names)))])
    needs = _needs(spark, lattice, layers, size).withColumn("covariate", F.explode(listed[F.col("layer")])).drop("layer")
    source = tiled.filter(F.col("covariate").isin(names) & owner[F.col("covariate")].isNotNull())
    count = sum(len(layer.names) * math.ceil(layer.width / size) * math.ceil(layer.height / size) for layer in layers)
    tiles = source.select("covariate", "tile_row", "tile_col", "values")
    # A tile has a known number of values, which count for as many rows of the usual bytes.
    bound = count * math.ceil((size * size * 8 + 256) / row_bytes(tiles))
    met = lookup_join(needs, tiles, ["covariate", "tile_row", "tile_col"], "left", bound=bound)
    by_name = {n: layer for layer in layers for n in layer.names}

    def fill(group: pa.Table) -> pa.Table:
        at = group.column("out_row")[0].as_py(), group.column("out_col")[0].as_py()
        x, y = lattice.places(*at, size)
        out, known, placed = {}, {}, {}
        for n, r, c, values in zip(
            group.column("covariate").to_pylist(), group.column("tile_row").to_pylist(), group.column("tile_col").to_pylist(), group.column("values")
        ):
            layer = by_name[n]
            if layer.crs is None or id(layer) not in placed:
                placed[id(layer)] = layer.cells(x, y)
            row, col, inside = placed[id(layer)]
            if n not in out:
                out[n], known[n] = np.zeros(x.shape, np.float32), np.zeros(x.shape, bool)
            if not values.is_valid:
                continue
            here = inside & (row // size == r) & (col // size == c)
            slot = row[here] % size * size + col[here] % size
            data = values.values
            out[n][here] = data.fill_null(0).to_numpy(zero_copy_only=False)[slot]
            known[n][here] = ~data.is_null().to_numpy(zero_copy_only=False)[slot]
        columns = []
        for n in names:
            inside = placed[id(by_name[n])][2]
            for where, value in ((~inside, by_name[n].outside[n]), (inside & ~known[n], by_name[n].gap[n])):
                if value is not None:
                    out[n][where] = value
                    known[n][where] = True
            cells = pa.array(out[n].ravel(), mask=~known[n].ravel())
            columns.append(pa.ListArray.from_arrays(pa.array([0, len(cells)], pa.int32()), cells))
        ids = [pa.array([v], pa.int32()) for v in at]
        return pa.Table.from_arrays([*ids, *columns], ["tile_row", "tile_col", *names])

    schema = ", ".join(["tile_row int", "tile_col int", *[f"`{n}` array<float>" for n in names]])
    return met.groupBy("out_row", "out_col").applyInArrow(fill, schema)


def map_lattice(area: Row | dict[str, Any]) -> Lattice:
    """The points of `raster.prediction_grid`."""
    axes = grid_axes(area)
    return Lattice(axes.x_lo, axes.x_step, axes.nx, axes.y_lo, axes.y_step, axes.ny)


def _evaluated(tiles: DataFrame, model: Fitted, size: int, lattice: Lattice) -> DataFrame:
    """`tiles` with the array `value`: the model on all cells of a tile at once."""
    features = list(model.features)
    if hasattr(model, "predict_array"):

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for i in range(b.num_rows):
                    x = np.stack([_numbers(b.column(j + 3)[i]) for j in range(len(features))], axis=1)
                    cells = pa.array(model.predict_array(x))
                    made = pa.ListArray.from_arrays(pa.array([0, len(cells)], pa.int32()), cells)
                    yield pa.RecordBatch.from_arrays([*[b.column(j).slice(i, 1) for j in range(3)], made], ["tile_row", "tile_col", MASK, "value"])

        rows = tiles.select("tile_row", "tile_col", MASK, *features)
        return rows.mapInArrow(run, f"tile_row int, tile_col int, `{MASK}` array<float>, value array<double>")

    # Any other model works on rows: the cells of a tile follow each other in a partition, so they are packed as they come.
    zipped = F.arrays_zip(*[F.col(f) for f in features], F.col(MASK))
    cells = tiles.select("tile_row", "tile_col", F.posexplode(zipped).alias("pos", "cell"))
    cells = cells.select(
        "tile_row", "tile_col", "pos", F.col(f"cell.{MASK}").alias(MASK), *[F.col(f"cell.{f}").alias(f) for f in features]
    ).na.fill(MISSING, features)
    scored = model.transform(cells, "value").select("tile_row", "tile_col", "pos", MASK, F.col("value").cast("double").alias("value"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts = None, []

        def out() -> pa.RecordBatch:
            h, w = lattice.shape(*at, size)
            rows = pa.Table.from_batches(parts).combine_chunks()
            if not np.array_equal(rows.column("pos").to_numpy(), np.arange(h * w)):
                raise ValueError("the model moves rows between partitions: use prediction_map for it")
            lists = [
                pa.ListArray.from_arrays(pa.array([0, h * w], pa.int32()), rows.column(c).combine_chunks()) for c in (MASK, "value")
            ]
            return pa.RecordBatch.from_arrays([*[pa.array([v], pa.int32()) for v in at], *lists], ["tile_row", "tile_col", MASK, "value"])

        for b in batches:
            ids = np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()], axis=1)
            ends = [*(np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1).tolist(), b.num_rows]
            start = 0
            for end in ends:
                if end > start:
                    key = tuple(ids[start].tolist())
                    if at is not None and key != at:
                        yield out()
                        parts = []
                    at = key
                    parts.append(b.slice(start, end - start))
                start = end
        if at is not None:
            yield out()

    return scored.mapInArrow(pack, f"tile_row int, tile_col int, `{MASK}` array<float>, value array<double>")


def _numbers(values: pa.Scalar) -> np.ndarray:
    """A list of cells in double precision; nulls and NaN are -9999."""
    found = values.values.cast(pa.float64()).fill_null(MISSING).to_numpy(zero_copy_only=False)
    return np.where(np.isnan(found), MISSING, found)


def tiled_prediction_map(
    spark: SparkSession,
    area: Row | dict[str, Any],
    tiled: DataFrame,
    meta: DataFrame,
    model: Fitted,
    mask: DataFrame | None = None,
    nodata: float | None = MISSING,
    zero_outside: bool = False,
    size: int = TILE,
) -> DataFrame:
    """`prediction_map` as tiles: (tile_row, tile_col, value), the values of a tile by row and column of the grid.

    `tiled` has the covariates and `mask` the mask, as `raster.tiles` makes
    them.  Cells outside the mask become -9999.  Two runs of shuffled tiles are
    all that moves: the source tiles, and these again by map tile.
    """
    groups, info = _grid_groups(meta, model.features)
    layers = [
        _layer(
            members, grid, {n: float(info[n]["nodata"] or 0.0) for n in members},
            {n: None if info[n]["nodata"] is None else float(info[n]["nodata"]) for n in members},
        ) for grid, members in groups
    ]
    source = tiled.select("covariate", "tile_row", "tile_col", "values")
    if mask is not None:
        layers.append(_layer([MASK], area, {MASK: None}, {MASK: None}))
        source = source.unionByName(mask.select(F.lit(MASK).alias("covariate"), "tile_row", "tile_col", "values"))
    lattice = map_lattice(area)
    found = gather(spark, lattice, source, layers, size)
    if mask is None:
        found = found.withColumn(MASK, F.transform(F.col(model.features[0]), lambda _: F.lit(None).cast("float")))
    scored = _evaluated(found, model, size, lattice)
    if mask is None:
        return scored.drop(MASK)

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                m = b.column(2)[i].values.cast(pa.float64()).to_numpy(zero_copy_only=False)
                keep = ~np.isnan(m)
                for bad, asked in ((nodata, nodata is not None), (0.0, zero_outside)):
                    if asked:
                        keep &= m != bad
                value = b.column(3)[i].values.to_numpy(zero_copy_only=False)
                cells = pa.array(np.where(keep, value, MISSING))
                made = pa.ListArray.from_arrays(pa.array([0, len(cells)], pa.int32()), cells)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, 1), b.column(1).slice(i, 1), made], ["tile_row", "tile_col", "value"])

    return scored.mapInArrow(cover, "tile_row int, tile_col int, value array<double>")


def map_cells(tiles: DataFrame, area: Row | dict[str, Any], size: int = TILE) -> DataFrame:
    """A tiled prediction map as (row, col, x, y, value), row and col those of the area's grid."""
    lattice = map_lattice(area)
    width = F.least(F.lit(size), F.lit(lattice.nx) - F.col("tile_col") * size)
    cells = tiles.select("tile_row", "tile_col", width.alias("_w"), F.posexplode("value").alias("pos", "value")).select(
        (F.lit(lattice.x) + (F.col("tile_col") * size + F.pmod("pos", "_w")) * lattice.dx).cast("int").alias("x"),
        (F.lit(lattice.y) + (F.col("tile_row") * size + F.expr("pos div _w")) * lattice.dy).cast("int").alias("y"), "value",
    )
    row = F.floor((F.lit(float(area["y0"])) - F.col("y")) / F.lit(float(area["dy"]))).cast("int")
    col = F.floor((F.col("x") - F.lit(float(area["x0"]))) / F.lit(float(area["dx"]))).cast("int")
    return cells.select(row.alias("row"), col.alias("col"), "x", "y", "value")


def reproject_tiles(
    spark: SparkSession, tiled: DataFrame, names: Sequence[str], source: Row | dict[str, Any], target: Row | dict[str, Any], size: int = TILE
) -> DataFrame:
    """`raster.reproject` from tiles to tiles: (covariate, tile_row, tile_col, values) on the target grid.

    Cells without a source cell get the source's nodata, null if it has none.
    """
    lattice = Lattice(
        float(target["x0"]) + 0.5 * float(target["dx"]), float(target["dx"]), int(target["width"]),
        float(target["y0"]) - 0.5 * float(target["dy"]), -float(target["dy"]), int(target["height"]),
    )
    nodata = source["nodata"]
    gap = {n: None if nodata is None else float(nodata) for n in names}
    found = gather(spark, lattice, tiled, [_layer(names, source, gap, gap, _crs_of(source))], size)
    width = F.least(F.lit(size), F.lit(lattice.nx) - F.col("tile_col") * size)
    # Tiles of the edge are narrower; `raster.tiles` fills them up, and so does this.
    each = found.select("tile_row", "tile_col", width.alias("_w"), F.explode(F.array(
        *[F.struct(F.lit(n).alias("covariate"), F.col(n).alias("v")) for n in names]
    )).alias("e"))
    filled = F.expr(
        f"flatten(transform(sequence(0, {size - 1}), r -> if(r * _w < size(e.v),"
        f" concat(slice(e.v, r * _w + 1, _w), array_repeat(CAST(NULL AS FLOAT), {size} - _w)), array_repeat(CAST(NULL AS FLOAT), {size}))))"
    )
    return each.select("e.covariate", "tile_row", "tile_col", filled.alias("values"))
