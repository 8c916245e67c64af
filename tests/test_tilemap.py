"""Maps made from tiles, and the coordinate systems behind them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from covaria.functions import projection
from covaria.models.linear import FittedLinear
from covaria.models.registry import regressor
from covaria.operators import raster, tilemap
from covaria.operators.gram import LinearFit
from covaria.operators.points import project_points
from covaria.operators.predict import prediction_map

AREA = {"x0": 1000.4, "y0": 900.2, "dx": 10.0, "dy": 10.0, "width": 23, "height": 17, "nodata": None}


def inputs(spark):
    """Two covariates on the area's grid, one on a shifted finer one, with gaps and NaN; a mask with gaps."""
    wide = spark.range(23 * 17).select((F.col("id") / 23).cast("int").alias("row"), (F.col("id") % 23).cast("int").alias("col"))
    fine = spark.range(60 * 40).select((F.col("id") / 60).cast("int").alias("row"), (F.col("id") % 60).cast("int").alias("col"))
    value = (F.col("row") * 31 + F.col("col") * 7) % 101
    a = wide.select(F.lit("a").alias("covariate"), "row", "col", value.cast("float").alias("value")).filter("(row + col) % 11 != 0")
    b = wide.select(F.lit("b").alias("covariate"), "row", "col", F.when(F.col("col") == 5, float("nan")).when(F.col("col") == 6, None).otherwise(value / 3).cast("float").alias("value"))
    c = fine.select(F.lit("c").alias("covariate"), "row", "col", (value * 2).cast("float").alias("value"))
    cells = a.unionByName(b).unionByName(c)
    place = {k: AREA[k] for k in ("x0", "y0", "dx", "dy", "width", "height")}
    shifted = {"x0": 1020.0, "y0": 880.0, "dx": 3.0, "dy": 4.0, "width": 60, "height": 40}
    meta = spark.createDataFrame(
        [("a", -9999.0, *place.values()), ("b", None, *place.values()), ("c", -1.0, *shifted.values())],
        "covariate string, nodata double, x0 double, y0 double, dx double, dy double, width int, height int",
    )
    mask = wide.select("row", "col", F.when(F.col("col") == 9, None).otherwise((F.col("row") * F.col("col")) % 3).cast("float").alias("value")).filter("row != 4")
    return cells, meta, mask


def rows(df):
    return sorted(tuple(r) for r in df.select("row", "col", "x", "y", F.round("value", 6)).collect())


@pytest.mark.parametrize("size", [4, 7, 256])
def test_tiled_map_equals_the_map_of_cells(spark, size):
    cells, meta, mask = inputs(spark)
    model = FittedLinear(["a", "c", "b"], LinearFit(np.array([0.5, -2.0, 3.0]), 10.0))
    tiled = raster.tiles(cells, size)
    want = rows(prediction_map(spark, AREA, cells, meta, model))
    assert rows(tilemap.map_cells(tilemap.tiled_prediction_map(spark, AREA, tiled, meta, model, size=size), AREA, size)) == want
    masked = raster.tiles(mask.withColumn("covariate", F.lit("m")), size)
    for nodata, zero in ((0.0, False), (None, True), (2.0, False)):
        made = tilemap.tiled_prediction_map(spark, AREA, tiled, meta, model, masked, nodata, zero, size)
        if zero:
            want = rows(raster.apply_mask(prediction_map(spark, AREA, cells, meta, model), mask, "value", nodata, zero_outside=True))
        else:
            want = rows(prediction_map(spark, AREA, cells, meta, model, mask, nodata))
        assert rows(tilemap.map_cells(made, AREA, size)) == want


def test_models_without_array_form_are_packed(spark):
    cells, meta, _ = inputs(spark)
    training = spark.range(200).select(*[F.rand(i).alias(n) for i, n in enumerate("abc")]).withColumn("target", F.col("a") * 90 - F.col("c"))
    model = regressor("RandomForestRegressor", {"n_estimators": 3, "max_depth": 3}).fit(training, ["a", "b", "c"])
    made = tilemap.tiled_prediction_map(spark, AREA, raster.tiles(cells, 5), meta, model, size=5)
    assert rows(tilemap.map_cells(made, AREA, 5)) == rows(prediction_map(spark, AREA, cells, meta, model))


def test_no_cell_is_shuffled(spark, tmp_path):
    cells, meta, mask = inputs(spark)
    tiled = raster.tiles(cells)
    path = str(tmp_path / "tiles")
    tiled.write.parquet(path)
    model = FittedLinear(["a", "c"], LinearFit(np.array([0.5, -2.0]), 10.0))
    made = tilemap.tiled_prediction_map(spark, AREA, spark.read.parquet(path), meta, model)
    plan = made._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    # Beside the broadcast of the few tiles, one exchange, by map tile.
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffles) == 1 and "out_row" in shuffles[0] and "out_col" in shuffles[0]


@pytest.mark.parametrize("crs, source", [
    ("EPSG:4326", {"x0": 135.0, "y0": -22.0, "dx": 0.05, "dy": 0.05}),
    ("EPSG:28354", {"x0": 300000.0, "y0": 7500000.0, "dx": 4000.0, "dy": 5000.0}),
])
def test_reprojection_by_tiles_equals_that_by_cells(spark, crs, source):
    source = {**source, "width": 50, "height": 41, "nodata": None, "crs": crs}
    lon, lat = (135.0, -22.0) if crs == "EPSG:4326" else projection.zone_of(crs).inverse(np.array([300000.0]), np.array([7500000.0]))
    corner = spark.range(1).select(*[c.alias(n) for c, n in zip(projection.albers_forward(F.lit(float(np.ravel(lon)[0])), F.lit(float(np.ravel(lat)[0]))), "xy")]).first()
    target = {"x0": corner.x - 20000.0, "y0": corner.y + 20000.0, "dx": 5000.0, "dy": 5000.0, "width": 61, "height": 50}
    cells = spark.range(50 * 41).select((F.col("id") / 50).cast("int").alias("row"), (F.col("id") % 50).cast("int").alias("col"), F.col("id").cast("float").alias("value"))
    want = {(r.row, r.col): r.value for r in raster.reproject(cells, source, target, spark).filter("value IS NOT NULL").collect()}
    tiled = raster.tiles(cells.withColumn("covariate", F.lit("a")), 16)
    made = raster.untile(tilemap.reproject_tiles(spark, tiled, ["a"], source, target, 16), 16)
    assert {(r.row, r.col): r.value for r in made.collect()} == want and len(want) > 1000


# Published control points of the Australian datum manual: degrees, minutes, seconds and zone 55 coordinates.
POINTS = [((37, 57, 3.72030), (144, 25, 29.52440), 273741.297, 5796489.777), ((37, 39, 10.15610), (143, 55, 35.38390), 228854.052, 5828259.038)]


def test_published_control_points(spark):
    zone = projection.zone_of("EPSG:28355")
    for south, east, e, n in POINTS:
        lat, lon = -(south[0] + south[1] / 60 + south[2] / 3600), east[0] + east[1] / 60 + east[2] / 3600
        x, y = zone.forward(np.array([lon]), np.array([lat]))
        assert abs(x[0] - e) < 0.001 and abs(y[0] - n) < 0.001
        back = zone.inverse(x, y)
        assert abs(back[0][0] - lon) < 1e-10 and abs(back[1][0] - lat) < 1e-10
        columns = spark.range(1).select(*zone.forward(F.lit(lon), F.lit(lat)), *zone.inverse(F.lit(float(x[0])), F.lit(float(y[0])))).first()
        assert np.allclose(columns, [x[0], y[0], lon, lat], rtol=0, atol=1e-6)


def test_codes():
    assert projection.zone_of("EPSG:32633") == projection.Zone(15.0, False) and projection.zone_of("EPSG:7855").meridian == 147.0
    assert projection.check_crs(None) == "EPSG:3577"
    for bad in ("EPSG:3857", "EPSG:32661", "WGS84", "EPSG:28347", ""):
        with pytest.raises(ValueError, match="unknown coordinate system"):
            projection.check_crs(bad)


def test_unknown_systems_are_refused_and_zones_projected(spark):
    cells, meta, _ = inputs(spark)
    with pytest.raises(ValueError, match="unknown coordinate system"):
        raster.to_projection(spark, cells, meta.withColumn("crs", F.lit("EPSG:3857")))
    with pytest.raises(ValueError, match="unknown coordinate system"):
        project_points(spark.createDataFrame([(1.0, 2.0)], "x double, y double"), crs="EPSG:27700")
    zoned = meta.filter("covariate = 'a'").withColumns({"x0": F.lit(300000.0), "y0": F.lit(7500000.0), "dx": F.lit(4000.0), "dy": F.lit(4000.0), "crs": F.lit("EPSG:28354")})
    out, moved = raster.to_projection(spark, cells.filter("covariate = 'a'"), zoned)
    found = moved.first()
    assert found.crs == "EPSG:3577" and abs(found.dx - 4000.0) < 120 and out.filter("value >= 0").count() > 200
