import pytest
from pyspark.sql import functions as F

from covaria.operators import points as pts, raster
from covaria.operators.drift import points_needed, random_points

META = "covariate string, width int, height int, x0 double, y0 double, dx double, dy double, nodata double"


def _cells(spark, name, width, height, value):
    return spark.range(width * height).select(
        F.lit(name).alias("covariate"),
        F.floor(F.col("id") / width).cast("int").alias("row"),
        (F.col("id") % width).cast("int").alias("col"),
        value(F.col("id")).cast("float").alias("value"),
    )


@pytest.fixture(scope="module")
def rasters(spark):
    meta = spark.createDataFrame(
        [("a", 4, 3, 100.0, 60.0, 10.0, 20.0, -9999.0), ("b", 4, 3, 100.0, 60.0, 10.0, 20.0, None), ("c", 2, 2, 90.0, 70.0, 30.0, 40.0, None)],
        META,
    )
    cells = _cells(spark, "a", 4, 3, lambda i: i).union(_cells(spark, "b", 4, 3, lambda i: i * 10)).union(_cells(spark, "c", 2, 2, lambda i: i + 500))
    return cells, meta


def test_cells_are_half_open_and_outside_reads_nodata(spark, rasters):
    cells, meta = rasters
    points = spark.createDataFrame(
        [
            (0, 100.0, 60.0),  # upper left corner belongs to the first cell
            (1, 110.0, 40.0),  # inner corner belongs to the cell right and below
            (2, 139.999, 0.001),  # last cell
            (3, 140.0, 10.0),  # on the right edge: outside
            (4, 105.0, 0.0),  # on the lower edge: outside
            (5, 99.0, 50.0),  # left of a and b, but inside c
        ],
        "point_id int, x double, y double",
    )
    rows = raster.sample_at_points(points, cells, meta, ["a", "b", "c"]).orderBy("point_id").collect()
    assert [(r["a"], r["b"], r["c"]) for r in rows] == [
        (0, 0, 500), (5, 50, 500), (11, 110, 503), (-9999, 0, 503), (-9999, 0, 502), (-9999, 0, 500),
    ]
    nulls = raster.sample_at_points(points, cells, meta, ["a"], outside="null").orderBy("point_id").collect()
    assert [r["a"] for r in nulls] == [0, 5, 11, None, None, None]
    with pytest.raises(ValueError, match="no such covariate"):
        raster.sample_at_points(points, cells, meta, ["zz"])


def test_crowded_cell_gives_the_same_result(spark, rasters, monkeypatch):
    from covaria.operators import joins

    cells, meta = rasters
    points = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, 101.0).otherwise(100 + F.col("id") % 40).cast("double").alias("x"),
        (1 + F.col("id") % 59).cast("double").alias("y"),
    )
    want = sorted(map(tuple, raster.sample_at_points(points, cells, meta, ["a", "c"]).collect()))
    original = joins.lookup_join
    monkeypatch.setattr(raster, "lookup_join", lambda *a, **k: original(*a, **{**k, "small_rows": 1, "bound": None}))
    assert sorted(map(tuple, raster.sample_at_points(points, cells, meta, ["a", "c"]).collect())) == want


def test_bands_get_names(spark):
    cells = spark.createDataFrame([("m", 1, 0, 0, 1.0), ("m", 2, 0, 0, 2.0), ("s", 1, 0, 0, 3.0)], "raster string, band int, row int, col int, value float")
    meta = spark.createDataFrame([("m", 2), ("s", 1)], "raster string, n_bands int")
    out = {r["covariate"]: r["value"] for r in raster.split_bands(cells, meta).collect()}
    assert out == {"m_1": 1.0, "m_2": 2.0, "s": 3.0}
    assert {r["covariate"] for r in raster.band_meta(meta).collect()} == set(out)


def test_grid_axes_round_half_even():
    axes = raster.grid_axes({"x0": 0.5, "y0": 10.5, "dx": 2.5, "dy": 0.2, "width": 4, "height": 20})
    # round(0.5) = 0, round(10.5) = 10, round(2.5) = 2, round(0.2) -> at least 1
    assert (axes.x_lo, axes.x_hi, axes.x_step) == (1, 10, 2)
    assert (axes.y_lo, axes.y_hi, axes.y_step) == (round(6.5) + 1, 10, 1)
    assert axes.nx == len(range(1, 10, 2)) and axes.ny == len(range(7, 10))


def test_grid_covers_every_pair(spark):
    axes = raster.GridAxes(1, 10, 3, -5, 2, 2)
    rows = {(r["x"], r["y"]) for r in raster.prediction_grid(spark, axes).collect()}
    assert rows == {(x, y) for x in range(1, 10, 3) for y in range(-5, 2, 2)}
    assert raster.prediction_grid(spark, raster.GridAxes(5, 5, 1, 0, 3, 1)).count() == 0


def test_mask_blanks_outside_cells(spark):
    grid = spark.range(9).select((F.col("id") / 3).cast("int").alias("row"), (F.col("id") % 3).cast("int").alias("col"), F.lit(5.0).alias("value"))
    mask = spark.createDataFrame([(0, 0, 1.0), (0, 1, 0.0), (1, 1, -9999.0), (2, 2, float("nan")), (2, 0, None)], "row int, col int, value double")
    keep = {(r["row"], r["col"]) for r in raster.apply_mask(grid, mask).filter("value <> -9999").collect()}
    assert keep == {(0, 0), (0, 1)}
    zero = {(r["row"], r["col"]) for r in raster.apply_mask(grid, mask, zero_outside=True).filter("value <> -9999").collect()}
    assert zero == {(0, 0)}


def test_mosaic_first_strip_wins_within_bounds(spark):
    strips = spark.createDataFrame(
        [(0, 0, 2, 20.0, 1.0, 1.0), (0, 0, 1, 10.0, 1.0, 1.0), (0, 0, 0, None, 1.0, 1.0), (0, 1, 5, 50.0, 9.0, 1.0)],
        "row int, col int, strip int, value double, x double, y double",
    )
    assert {(r["row"], r["col"]): r["value"] for r in raster.mosaic(strips).collect()} == {(0, 0): 10.0, (0, 1): 50.0}
    assert raster.mosaic(strips, bounds=(0.0, 0.0, 5.0, 5.0)).count() == 1


def test_tiles_round_trip(spark):
    cells = _cells(spark, "a", 37, 23, lambda i: i)
    back = raster.untile(raster.tiles(cells, 8), 8)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, cells.collect()))


def test_reproject_takes_the_cell_under_each_centre(spark):
    source = {"x0": 130.0, "y0": -20.0, "dx": 0.5, "dy": 0.5, "width": 20, "height": 20, "nodata": None}
    target = {"x0": -100000.0, "y0": -2300000.0, "dx": 50000.0, "dy": 50000.0, "width": 10, "height": 10}
    cells = _cells(spark, "a", 20, 20, lambda i: i).drop("covariate")
    out = {(r["row"], r["col"]): r["value"] for r in raster.reproject(cells, source, target, spark).collect()}
    assert len(out) == 100
    # The same cells, looked up the other way round through the forward map.
    pts_df = spark.createDataFrame([(130.25 + 0.5 * c, -20.25 - 0.5 * r, r * 20 + c) for r in range(20) for c in range(20)], "x double, y double, v int")
    hits = 0
    for p in pts.project_points(pts_df).collect():
        row, col = int((target["y0"] - p["y"]) // 50000), int((p["x"] - target["x0"]) // 50000)
        if (row, col) in out and out[(row, col)] is not None:
            value = int(out[(row, col)])
            hits += 1
            assert abs(value // 20 - p["v"] // 20) <= 1 and abs(value % 20 - p["v"] % 20) <= 1
    assert hits > 50


def test_suggested_grid_holds_the_whole_source(spark):
    source = {"x0": 130.0, "y0": -20.0, "dx": 0.5, "dy": 0.5, "width": 20, "height": 30, "nodata": -1.0}
    grid = raster.suggested_grid(spark, source)
    assert grid["dx"] == grid["dy"] and 45_000 < grid["dx"] < 60_000 and grid["nodata"] == -1.0
    cells = _cells(spark, "a", 20, 30, lambda i: i).drop("covariate")
    out = raster.reproject(cells, source, grid, spark)
    assert out.count() == grid["width"] * grid["height"]
    seen = out.filter("value >= 0").agg(F.count_distinct("value")).first()[0]
    assert seen > 0.8 * 600


FEATURES = [
    ('{"type":"Feature","properties":{"t":1.5,"w":2},"geometry":{"type":"Point","coordinates":[1,2]}}', (1.5, 1.0, 2.0)),
    ('{"type":"Feature","properties":{"t":2},"geometry":{"type":"Point","coordinates":[1.5, -2e1, 7]}}', (2.0, 1.5, -20.0)),
    ('{"type":"Feature","properties":{"t":3},"geometry":{"type":"MultiPoint","coordinates":[[3,4],[5,6]]}}', (3.0, 3.0, 4.0)),
    ('{"type":"Feature","properties":{"t":null},"geometry":{"type":"Point","coordinates":[1,2]}}', (None, 1.0, 2.0)),
    ('{"type":"Feature","properties":{"t":3},"geometry":{"type":"Point","coordinates":[3]}}', None),
    ('{"type":"Feature","properties":{"t":3},"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,1],[1,0]]]}}', None),
    ('{"type":"Feature","properties":{"other":3},"geometry":{"type":"Point","coordinates":[3,4]}}', None),
    ('{"type":"Feature","properties":{"t":3},"geometry":null}', None),
    ("not json", None),
]


def test_geometry_kinds(spark):
    df = spark.createDataFrame([(i, f[0]) for i, f in enumerate(FEATURES)], "id int, value string")
    good, bad = pts.normalise_points(pts.parse_features(df), "t")
    got = {r["id"]: (r["target"], r["x"], r["y"]) for r in good.collect()}
    assert got == {i: f[1] for i, f in enumerate(FEATURES) if f[1] is not None}
    assert {r["id"] for r in bad.collect()} == {i for i, f in enumerate(FEATURES) if f[1] is None}
    no_target, _ = pts.normalise_points(pts.parse_features(df.limit(1)), None)
    assert no_target.first()["target"] == 0.0


def test_collection_text_explodes(spark):
    text = '{"type":"FeatureCollection","features":[%s]}' % ",".join(f[0] for f in FEATURES[:3])
    df = spark.createDataFrame([(text,)], "value string")
    assert pts.parse_features(df).count() == 3


def test_random_points_are_the_first_accepted_draws(spark):
    area = {"x0": 0.0, "y0": 30.0, "dx": 10.0, "dy": 10.0, "width": 3, "height": 3, "nodata": None}
    mask = _cells(spark, "m", 3, 3, lambda i: F.when(i == 4, 1).otherwise(0)).drop("covariate")
    out = random_points(spark, area, mask, points_needed(50), seed=1)
    rows = out.collect()
    assert len(rows) == 55
    assert all(10 <= r["x"] < 20 and 10 < r["y"] <= 20 for r in rows)
    fewer = {r["point_id"] for r in random_points(spark, area, mask, 20, seed=1).collect()}
    assert fewer == set(sorted(r["point_id"] for r in rows)[:20])
    with pytest.raises(ValueError, match="no usable cell"):
        random_points(spark, area, mask.withColumn("value", F.lit(0.0).cast("float")), 5)
