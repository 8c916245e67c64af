"""Queries on rasters, points, grids, masks and projections."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import projection
from ..operators import points as point_ops, raster
from ..operators.drift import random_points
from ..operators.predict import grid_features, prediction_map
from ..operators.tilemap import map_cells, reproject_tiles, tiled_prediction_map
from ..models.linear import FittedLinear
from ..operators.gram import LinearFit
from ..session import shared_folder
from ..sources import sinks
from . import views as v
from .registry import query
from .workflow import build_training_table

_COVARIATES = ["price", "parts_1", "parts_2"]


def _single(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    meta = v.raster_meta(spark, sf)
    return raster.split_bands(v.raster_cells(spark, sf), meta), raster.band_meta(meta)


@query("multiband_split", f"WITH {v.CELLS_SQL} SELECT covariate, row, col, CAST(value AS DOUBLE) AS value FROM cells")
def multiband_split(spark: SparkSession, sf: str) -> DataFrame:
    cells, _ = _single(spark, sf)
    return cells.withColumn("value", F.col("value").cast("double"))


@query(
    "raster_extent",
    f"WITH {v.META_SQL} SELECT min(x0) AS x_min, min(y0 - dy * height) AS y_min, max(x0 + dx * width) AS x_max,"
    " max(y0) AS y_max FROM meta",
)
def raster_extent(spark: SparkSession, sf: str) -> DataFrame:
    return raster.extent(v.raster_meta(spark, sf))


_SAMPLE_SQL = f"""{v.META_SQL}, {v.CELLS_SQL}, {v.POINTS_SQL},
  placed AS (SELECT p.*, CAST(floor(({v.Y0} - y) / {v.STEP}) AS INTEGER) AS row, CAST(floor((x - {v.X0}) / {v.STEP}) AS INTEGER) AS col,
    (SELECT max(height) FROM meta) AS height FROM points p),
  sampled AS (SELECT point_id, x, y, price AS amount, customer,
    CASE WHEN row < 0 OR col < 0 OR row >= height OR col >= {v.GRID_WIDTH} THEN -9999.0 ELSE coalesce(a.value, -9999.0) END AS price,
    CASE WHEN row < 0 OR col < 0 OR row >= height OR col >= {v.GRID_WIDTH} THEN 0.0 ELSE b.value END AS parts_1,
    CASE WHEN row < 0 OR col < 0 OR row >= height OR col >= {v.GRID_WIDTH} THEN 0.0 ELSE c.value END AS parts_2
  FROM placed
    LEFT JOIN cells a USING (row, col) LEFT JOIN cells b USING (row, col) LEFT JOIN cells c USING (row, col)
  WHERE coalesce(a.covariate, 'price') = 'price' AND coalesce(b.covariate, 'parts_1') = 'parts_1'
    AND coalesce(c.covariate, 'parts_2') = 'parts_2')"""


@query(
    "point_raster_sample",
    f"WITH {_SAMPLE_SQL} SELECT point_id, CAST(CAST(price AS FLOAT) AS DOUBLE) AS price,"
    " CAST(CAST(parts_1 AS FLOAT) AS DOUBLE) AS parts_1, CAST(CAST(parts_2 AS FLOAT) AS DOUBLE) AS parts_2 FROM sampled",
)
def point_raster_sample(spark: SparkSession, sf: str) -> DataFrame:
    cells, meta = _single(spark, sf)
    points = v.points(spark, sf).select("point_id", "x", "y")
    sampled = raster.sample_at_points(points, cells, meta, _COVARIATES)
    return sampled.select("point_id", *[F.col(c).cast("double").alias(c) for c in _COVARIATES])


@query(
    "tiled_point_sample",
    f"WITH {_SAMPLE_SQL} SELECT point_id, CAST(CAST(price AS FLOAT) AS DOUBLE) AS price,"
    " CAST(CAST(parts_1 AS FLOAT) AS DOUBLE) AS parts_1, CAST(CAST(parts_2 AS FLOAT) AS DOUBLE) AS parts_2 FROM sampled",
)
def tiled_point_sample(spark: SparkSession, sf: str) -> DataFrame:
    """`point_raster_sample` from tiles of the default size."""
    cells, meta = _single(spark, sf)
    points = v.points(spark, sf).select("point_id", "x", "y")
    sampled = raster.sample_tiles_at_points(points, raster.tiles(cells), meta, _COVARIATES)
    return sampled.select("point_id", *[F.col(c).cast("double").alias(c) for c in _COVARIATES])


@query(
    "mask_sample",
    f"WITH {v.MASK_SQL}, {v.POINTS_SQL} SELECT point_id, CAST(value AS DOUBLE) AS value FROM points JOIN mask"
    f" ON row = floor(({v.Y0} - y) / {v.STEP}) AND col = floor((x - {v.X0}) / {v.STEP}) WHERE value <> 0",
)
def mask_sample(spark: SparkSession, sf: str) -> DataFrame:
    """Points whose mask value is not 0; outside the raster reads as 0."""
    area = v.area_of(spark, sf)
    cells = v.mask_cells(spark, sf).withColumn("covariate", F.lit("value"))
    meta = raster.band_meta(v.raster_meta(spark, sf)).filter("covariate = 'price'").withColumns(
        {"covariate": F.lit("value"), "nodata": F.lit(area["nodata"]).cast("double")}
    )
    sampled = raster.sample_at_points(v.points(spark, sf).select("point_id", "x", "y"), cells, meta, ["value"])
    return sampled.filter("value != 0").select("point_id", F.col("value").cast("double").alias("value"))


@query(
    "training_table",
    f"WITH {_SAMPLE_SQL} SELECT point_id, CAST(CAST(amount AS FLOAT) AS DOUBLE) AS target,"
    " CAST(CAST(price AS FLOAT) AS DOUBLE) AS price, CAST(CAST(parts_1 AS FLOAT) AS DOUBLE) AS parts_1,"
    " CAST(CAST(parts_2 AS FLOAT) AS DOUBLE) AS parts_2, x, y, CAST(CAST(customer AS FLOAT) AS DOUBLE) AS groupcv FROM sampled"
    " WHERE price <> -9999 AND parts_1 IS NOT NULL AND parts_2 IS NOT NULL",
)
def training_table(spark: SparkSession, sf: str) -> DataFrame:
    """GeoJSON points x covariate stack, cast and cleaned: the data preparation stage."""
    cells, meta = _single(spark, sf)
    table, _ = build_training_table(v.point_features(spark, sf), cells, meta, _COVARIATES, "price", group="customer")
    return table.select(
        "point_id", *[F.col(c).cast("double").alias(c) for c in ("target", *_COVARIATES, "x", "y", "groupcv")]
    )


_AXES_SQL = f"""axes AS (SELECT CAST({round(v.X0) + 1} AS BIGINT) AS xl, CAST({round(v.X0 + v.STEP * v.GRID_WIDTH)} AS BIGINT) AS xh,
  CAST({v.Y0} - {v.STEP} * max(height) AS BIGINT) + 1 AS yl, CAST({round(v.Y0)} AS BIGINT) AS yh FROM meta)"""
_GRID_SQL = f"""grid AS (SELECT CAST(x AS INTEGER) AS x, CAST(y AS INTEGER) AS y FROM axes,
  LATERAL (SELECT unnest(range(xl, xh, {int(v.STEP)})) AS x) a, LATERAL (SELECT unnest(range(yl, yh, {int(v.STEP)})) AS y) b)"""


@query("prediction_grid", f"WITH {v.META_SQL}, {_AXES_SQL}, {_GRID_SQL} SELECT x, y FROM grid")
def prediction_grid(spark: SparkSession, sf: str) -> DataFrame:
    return raster.prediction_grid(spark, raster.grid_axes(v.area_of(spark, sf)))


_GRID_CELL = f"CAST(floor(({v.Y0} - y) / {v.STEP}) AS INTEGER) AS row, CAST(floor((x - {v.X0}) / {v.STEP}) AS INTEGER) AS col"
_GRID_FEATURES_SQL = f"""{v.META_SQL}, {v.CELLS_SQL}, {_AXES_SQL}, {_GRID_SQL},
  gcells AS (SELECT x, y, {_GRID_CELL} FROM grid),
  wide AS (SELECT row, col, max(value) FILTER (covariate = 'price') AS price,
    max(value) FILTER (covariate = 'parts_1') AS parts_1 FROM cells GROUP BY row, col),
  gf AS (SELECT row, col, x, y, CAST(coalesce(price, -9999) AS DOUBLE) AS price, CAST(coalesce(parts_1, -9999) AS DOUBLE) AS parts_1
    FROM gcells LEFT JOIN wide USING (row, col))"""


@query("grid_raster_sample", f"WITH {_GRID_FEATURES_SQL} SELECT row, col, x, y, price, parts_1 FROM gf")
def grid_raster_sample(spark: SparkSession, sf: str) -> DataFrame:
    cells, meta = _single(spark, sf)
    out = grid_features(spark, v.area_of(spark, sf), cells, meta, ["price", "parts_1"])
    return out.select("row", "col", "x", "y", F.col("price").cast("double").alias("price"), F.col("parts_1").cast("double").alias("parts_1"))


_LINE = FittedLinear(["price", "parts_1"], LinearFit(np.array([0.5, -2.0]), 10.0))
_LINE_SQL = "10.0 + 0.5 * price + -2.0 * parts_1"


@query("grid_predict_linear", f"WITH {_GRID_FEATURES_SQL} SELECT row, col, x, y, round({_LINE_SQL}, 4) AS value FROM gf")
def grid_predict_linear(spark: SparkSession, sf: str) -> DataFrame:
    cells, meta = _single(spark, sf)
    out = prediction_map(spark, v.area_of(spark, sf), cells, meta, _LINE)
    return out.withColumn("value", F.round("value", 4))


@query(
    "masked_map",
    f"WITH {_GRID_FEATURES_SQL}, {v.MASK_SQL} SELECT row, col, x, y,"
    f" CASE WHEN coalesce(m.value, 0) = 0 THEN -9999.0 ELSE round({_LINE_SQL}, 4) END AS value FROM gf LEFT JOIN mask m USING (row, col)",
)
def masked_map(spark: SparkSession, sf: str) -> DataFrame:
    """Written by blocks of grid rows and read back."""
    cells, meta = _single(spark, sf)
    mask = v.mask_cells(spark, sf)
    surface = prediction_map(spark, v.area_of(spark, sf), cells, meta, _LINE, mask, nodata=0.0)
    path = f"{shared_folder(spark)}/map"
    sinks.write_map(surface, path)
    return spark.read.parquet(path).select("row", "col", "x", "y", F.round("value", 4).alias("value"))


@query(
    "tiled_prediction_map",
    f"WITH {_GRID_FEATURES_SQL}, {v.MASK_SQL} SELECT row, col, x, y,"
    f" CASE WHEN coalesce(m.value, 0) = 0 THEN -9999.0 ELSE round({_LINE_SQL}, 4) END AS value FROM gf LEFT JOIN mask m USING (row, col)",
)
def tiled_map(spark: SparkSession, sf: str) -> DataFrame:
    """`masked_map` made and written tile by tile: no cell is shuffled."""
    cells, meta = _single(spark, sf)
    mask = raster.tiles(v.mask_cells(spark, sf).withColumn("covariate", F.lit("mask")))
    area = v.area_of(spark, sf)
    made = tiled_prediction_map(spark, area, raster.tiles(cells), meta, _LINE, mask, nodata=0.0)
    path = f"{shared_folder(spark)}/map"
    sinks.write_tiles(made, path)
    return map_cells(spark.read.parquet(path), area).withColumn("value", F.round("value", 4))


@query(
    "mosaic_first_wins",
    "WITH strips AS (SELECT l_orderkey % 60 AS row, l_partkey % 50 AS col, concat_ws('-', l_shipdate::DATE, l_orderkey, l_linenumber,"
    " l_partkey, l_suppkey) AS strip, l_extendedprice AS value FROM lineitem)"
    " SELECT CAST(row AS INTEGER) AS row, CAST(col AS INTEGER) AS col, arg_min(value, strip) AS value FROM strips GROUP BY row, col",
)
def mosaic_first_wins(spark: SparkSession, sf: str) -> DataFrame:
    items = v.table(spark, sf, "lineitem")
    strip = F.concat_ws("-", F.col("l_shipdate").cast("date").cast("string"), *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
    strips = items.select(
        (F.col("l_orderkey") % 60).cast("int").alias("row"), (F.col("l_partkey") % 50).cast("int").alias("col"),
        strip.alias("strip"), F.col("l_extendedprice").alias("value"),
    )
    return raster.mosaic(strips)


@query("tile_round_trip", f"WITH {v.CELLS_SQL} SELECT covariate, row, col, CAST(value AS DOUBLE) AS value FROM cells")
def tile_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    cells, _ = _single(spark, sf)
    back = raster.untile(raster.tiles(cells))
    return back.withColumn("value", F.col("value").cast("double"))


@query(
    "random_points_in_mask",
    f"""WITH {v.MASK_SQL}, ids AS (SELECT i FROM (SELECT count(*) AS n, max(p_partkey) // 50 + 1 AS h FROM part) s, range(0, 20000000) t(i)
      WHERE i < n * 4),
    h AS (SELECT max(p_partkey) // 50 + 1 AS height, CAST(floor(count(*) * 1.1) AS BIGINT) AS need FROM part),
    drawn AS (SELECT i AS point_id, {v.X0} + {v.sql_uniform('7:x', 'i')} * ({v.STEP} * {v.GRID_WIDTH}) AS x,
      ({v.Y0} - {v.STEP} * height) + {v.sql_uniform('7:y', 'i')} * ({v.STEP} * height) AS y, need FROM ids, h),
    hit AS (SELECT point_id, x, y, need, row_number() OVER (ORDER BY point_id) AS r FROM drawn JOIN mask
      ON row = floor(({v.Y0} - y) / {v.STEP}) AND col = floor((x - {v.X0}) / {v.STEP}) WHERE value <> 0)
    SELECT point_id, x, y FROM hit WHERE r <= need""",
)
def random_points_in_mask(spark: SparkSession, sf: str) -> DataFrame:
    need = int(v.table(spark, sf, "part").count() * 1.1)
    return random_points(spark, v.area_of(spark, sf), v.mask_cells(spark, sf), need, seed=7)


# ---- projections ---------------------------------------------------------------------------

_LON, _LAT = "(115.0 + o_custkey % 380 / 10.0)", "(-43.0 + o_orderkey % 320 / 10.0)"


# Fixed values, worked out apart from the code under test: GRS80 (6378137, 1/298.257222101) and the cone of
# EPSG:3577 (parallels 18 and 36 south, meridian 132 east).
_ECC, _ECC2 = 0.08181919104281579, 0.006694380022900787
_CONE, _CONST, _RHO0 = -0.44847899716830203, 1.1805242276692356, -15452159.644039396
_AXIS, _MERIDIAN = 6378137.0, 132.0


def _q_sql(s: str) -> str:
    return f"({1 - _ECC2!r} * ({s} / (1.0 - {_ECC2!r} * {s} * {s}) - ln((1.0 - {_ECC!r} * {s}) / (1.0 + {_ECC!r} * {s})) / {2 * _ECC!r}))"


_RHO = f"({_AXIS / _CONE!r} * sqrt({_CONST!r} - {_CONE!r} * {_q_sql('s')}))"
_THETA = f"(radians(lon - {_MERIDIAN!r}) * {_CONE!r})"


@query(
    "albers_forward",
    f"WITH p AS (SELECT o_orderkey, CAST({_LON} AS DOUBLE) AS lon, CAST({_LAT} AS DOUBLE) AS lat, sin(radians({_LAT})) AS s FROM orders)"
    f" SELECT o_orderkey, round({_RHO} * sin({_THETA}), 3) AS x, round({_RHO0!r} - {_RHO} * cos({_THETA}), 3) AS y FROM p",
)
def albers_forward(spark: SparkSession, sf: str) -> DataFrame:
    lonlat = _lonlat(spark, sf)
    out = point_ops.project_points(lonlat)
    return out.select("o_orderkey", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))


def _lonlat(spark: SparkSession, sf: str) -> DataFrame:
    return v.table(spark, sf, "orders").select(
        "o_orderkey",
        (F.lit(115.0) + F.col("o_custkey") % 380 / 10.0).alias("x"),
        (F.lit(-43.0) + F.col("o_orderkey") % 320 / 10.0).alias("y"),
    )


@query(
    "albers_round_trip",
    f"SELECT o_orderkey, round({_LON}, 7) AS lon, round({_LAT}, 7) AS lat FROM orders",
)
def albers_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    xy = point_ops.project_points(_lonlat(spark, sf))
    lon, lat = projection.albers_inverse(F.col("x"), F.col("y"))
    return xy.select("o_orderkey", F.round(lon, 7).alias("lon"), F.round(lat, 7).alias("lat"))


def _refine_sql(lat: str) -> str:
    """One step of the inverse latitude."""
    s = f"sin({lat})"
    one = f"(1.0 - {_ECC2!r} * {s} * {s})"
    tail = f"ln((1.0 - {_ECC!r} * {s}) / (1.0 + {_ECC!r} * {s})) / {2 * _ECC!r}"
    return f"{lat} + {one} * {one} / (2.0 * cos({lat})) * (q / {1 - _ECC2!r} - {s} / {one} + {tail})"


_HEIGHT = f"(SELECT CAST(max(p_partkey) // {v.GRID_WIDTH} + 1 AS INTEGER) FROM part)"
_REPROJECT_SQL = f"""{v.CELLS_SQL},
  out AS (SELECT CAST(i // 60 AS INTEGER) AS r, CAST(i % 60 AS INTEGER) AS c FROM (SELECT unnest(range(60 * ({_HEIGHT} + 10))) AS i) t),
  xy AS (SELECT r, c, -(300000.0 + (c + 0.5) * 5000.0) AS dx, -({_RHO0!r} - (-2300000.0 - (r + 0.5) * 5000.0)) AS dy FROM out),
  qs AS (SELECT *, ({_CONST!r} - (dx * dx + dy * dy) * {(_CONE / _AXIS) ** 2!r}) / {_CONE!r} AS q FROM xy),
  l0 AS (SELECT *, asin(q / 2.0) AS l FROM qs), l1 AS (SELECT * REPLACE ({_refine_sql('l')} AS l) FROM l0),
  l2 AS (SELECT * REPLACE ({_refine_sql('l')} AS l) FROM l1), l3 AS (SELECT * REPLACE ({_refine_sql('l')} AS l) FROM l2),
  src AS (SELECT r, c, CAST(floor((-22.0 - degrees(l)) / 0.05) AS INTEGER) AS row,
    CAST(floor((132.0 + degrees(atan2(dx, dy) / {_CONE!r}) - 135.0) / 0.05) AS INTEGER) AS col FROM l3)"""


@query(
    "raster_reproject",
    f"WITH {_REPROJECT_SQL} SELECT r AS row, c AS col, CAST(coalesce(value, -9999) AS DOUBLE) AS value FROM src"
    " LEFT JOIN (SELECT row, col, value FROM cells WHERE covariate = 'price') p USING (row, col)",
)
def raster_reproject(spark: SparkSession, sf: str) -> DataFrame:
    """A geographic raster of part prices onto a projected grid, nearest cell."""
    height = v.area_of(spark, sf)["height"]
    source = {"x0": 135.0, "y0": -22.0, "dx": 0.05, "dy": 0.05, "width": v.GRID_WIDTH, "height": height, "nodata": -9999.0}
    target = {"x0": 300000.0, "y0": -2300000.0, "dx": 5000.0, "dy": 5000.0, "width": 60, "height": height + 10}
    cells, _ = _single(spark, sf)
    prices = cells.filter("covariate = 'price'").select("row", "col", "value")
    out = raster.reproject(prices, source, target, spark)
    return out.withColumn("value", F.col("value").cast("double"))


@query(
    "tiled_reproject",
    f"WITH {_REPROJECT_SQL} SELECT r AS row, c AS col, CAST(coalesce(value, -9999) AS DOUBLE) AS value FROM src"
    " LEFT JOIN (SELECT row, col, value FROM cells WHERE covariate = 'price') p USING (row, col)",
)
def tiled_reproject(spark: SparkSession, sf: str) -> DataFrame:
    """`raster_reproject` from tiles to tiles."""
    height = v.area_of(spark, sf)["height"]
    source = {"x0": 135.0, "y0": -22.0, "dx": 0.05, "dy": 0.05, "width": v.GRID_WIDTH, "height": height, "nodata": -9999.0}
    target = {"x0": 300000.0, "y0": -2300000.0, "dx": 5000.0, "dy": 5000.0, "width": 60, "height": height + 10}
    cells, _ = _single(spark, sf)
    tiled = raster.tiles(cells.filter("covariate = 'price'"))
    out = raster.untile(reproject_tiles(spark, tiled, ["price"], source, target))
    return out.select("row", "col", F.col("value").cast("double").alias("value"))


_MGA = projection.zone_of("EPSG:28355")
# Fixed values, worked out apart from the code under test: radius of the rectifying sphere times 0.9996, and the series
# of the third flattening of GRS80.
_RADIUS = 6364902.166112739
_SERIES = (0.0008377318247285514, 7.608527848149475e-07, 1.1976455209422673e-09, 2.429170654841013e-12, 5.711757817902033e-15)
_ZONE_SUM = [" + ".join(f"{a!r} * {f}({2 * j} * xi) * {g}({2 * j} * eta)" for j, a in enumerate(_SERIES, 1)) for f, g in (("cos", "sinh"), ("sin", "cosh"))]


@query(
    "zone_forward",
    f"""WITH p AS (SELECT o_orderkey, 144.5 + o_custkey % 50 / 10.0 AS lon, CAST({_LAT} AS DOUBLE) AS lat FROM orders),
    t AS (SELECT *, sinh(atanh(sin(radians(lat))) - {_ECC!r} * atanh({_ECC!r} * sin(radians(lat)))) AS t, radians(lon - 147.0) AS l FROM p),
    s AS (SELECT *, atan2(t, cos(l)) AS xi, asinh(sin(l) / sqrt(t * t + cos(l) * cos(l))) AS eta FROM t)
    SELECT o_orderkey, round(500000.0 + {_RADIUS!r} * (eta + {_ZONE_SUM[0]}), 2) AS x,
      round(10000000.0 + {_RADIUS!r} * (xi + {_ZONE_SUM[1]}), 2) AS y FROM s""",
)
def zone_forward(spark: SparkSession, sf: str) -> DataFrame:
    """Degrees to the transverse Mercator zone of meridian 147 east."""
    lon, lat = _zone_lonlat()
    x, y = _MGA.forward(lon, lat)
    return v.table(spark, sf, "orders").select("o_orderkey", F.round(x, 2).alias("x"), F.round(y, 2).alias("y"))


def _zone_lonlat():
    return F.lit(144.5) + F.col("o_custkey") % 50 / 10.0, F.lit(-43.0) + F.col("o_orderkey") % 320 / 10.0


@query(
    "zone_to_albers",
    f"WITH p AS (SELECT o_orderkey, 144.5 + o_custkey % 50 / 10.0 AS lon, CAST({_LAT} AS DOUBLE) AS lat, sin(radians({_LAT})) AS s FROM orders)"
    f" SELECT o_orderkey, round({_RHO} * sin({_THETA}), 3) AS x, round({_RHO0!r} - {_RHO} * cos({_THETA}), 3) AS y FROM p",
)
def zone_to_albers(spark: SparkSession, sf: str) -> DataFrame:
    """Points in a zone, made from degrees, reach the place that the degrees have in the projection."""
    x, y = _MGA.forward(*_zone_lonlat())
    zoned = v.table(spark, sf, "orders").select("o_orderkey", x.alias("x"), y.alias("y"))
    out = point_ops.project_points(zoned, crs="EPSG:28355")
    return out.select("o_orderkey", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))


_PREPARED_SQL = f"""WITH {_REPROJECT_SQL},
  h AS (SELECT {_HEIGHT} + 10 AS rows),
  p AS (SELECT o_orderkey AS key, o_totalprice AS target, 300000.0 + {v.sql_uniform('gx', 'o_orderkey')} * 300000.0 AS x,
    -2300000.0 - {v.sql_uniform('gy', 'o_orderkey')} * (5000.0 * rows) AS y FROM orders, h),
  placed AS (SELECT *, CAST(floor((-2300000.0 - y) / 5000.0) AS INTEGER) AS r, CAST(floor((x - 300000.0) / 5000.0) AS INTEGER) AS c FROM p)
SELECT key, CAST(CAST(target AS FLOAT) AS DOUBLE) AS target, CAST(a.value AS DOUBLE) AS parts_1, CAST(b.value AS DOUBLE) AS parts_2
FROM placed JOIN src USING (r, c) JOIN (SELECT * FROM cells WHERE covariate = 'parts_1') a ON a.row = src.row AND a.col = src.col
  JOIN (SELECT * FROM cells WHERE covariate = 'parts_2') b ON b.row = src.row AND b.col = src.col"""


@query("prepared_training", _PREPARED_SQL)
def prepared_training(spark: SparkSession, sf: str) -> DataFrame:
    """The data-preparation stage on a two-band raster in degrees, with a repeated and an absent covariate."""
    from ..functions.geojson import point_feature
    from ..functions.hashing import unit_uniform
    from .config import TargetConfig, WorkflowConfig
    from .workflow import Inputs, prepare

    height = v.area_of(spark, sf)["height"]
    place = {"x0": F.lit(135.0), "y0": F.lit(-22.0), "dx": F.lit(0.05), "dy": F.lit(0.05), "crs": F.lit("EPSG:4326")}
    meta = v.raster_meta(spark, sf).filter("raster = 'parts'").withColumns(place)
    points = v.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("price"),
        (F.lit(300000.0) + unit_uniform("gx", "o_orderkey") * F.lit(300000.0)).alias("x"),
        (F.lit(-2300000.0) - unit_uniform("gy", "o_orderkey") * F.lit(5000.0 * (height + 10))).alias("y"),
    )
    text = points.select("key", point_feature(F.col("x"), F.col("y"), [F.col("price")]).alias("value"))
    inputs = Inputs(
        features=point_ops.parse_features(text), cells=raster.split_bands(v.raster_cells(spark, sf), meta), meta=raster.band_meta(meta),
        grid={"x0": 300000.0, "y0": -2300000.0, "dx": 5000.0, "dy": 5000.0, "width": 60, "height": height + 10},
    )
    conf = WorkflowConfig(covariates=["parts_1", "parts_2", "parts_1", "nowhere"], target=TargetConfig(property="price"))
    made = prepare(inputs, conf)
    return made.training.select("key", *[F.col(c).cast("double").alias(c) for c in ("target", "parts_1", "parts_2")])
