"""The physical plans that matter at scale."""

import pytest
from pyspark.sql import functions as F

from covaria.operators import clean as c, gram, raster, split


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, training, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "training")
    training.write.parquet(path)
    return spark.read.parquet(path)


def test_clean_filter_reaches_the_scan(stored):
    text = plan(c.clean_selected(stored, ["quantity"]))
    assert "Exchange" not in text
    assert "ReadSchema: struct<target:float,quantity:float>" in text
    for pushed in ("IsNotNull(quantity)", "Not(EqualTo(quantity,-9999.0))", "LessThan(quantity,Infinity)"):
        assert pushed in text, pushed


def test_splits_do_not_move_rows(stored):
    train, oos = split.holdout(stored, "key", 10)
    assert "Exchange" not in plan(train) and "Exchange" not in plan(oos)
    folds = split.assign_folds(stored, "key", 5)
    assert "Exchange" not in plan(folds)
    assert plan(folds).count("md5") == 1
    assert "Exchange" not in plan(split.subsample(stored, "key", 0.5))


def test_group_folds_travel_by_broadcast_when_small(stored):
    text = plan(split.assign_group_folds(stored, "groupcv", 5))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_grid_is_a_range(spark):
    text = plan(raster.prediction_grid(spark, raster.GridAxes(0, 1000, 1, 0, 1000, 1)))
    assert "Range" in text and "Exchange" not in text and "Cartesian" not in text and "NestedLoop" not in text


def test_small_raster_does_not_shuffle_points(spark):
    meta = spark.createDataFrame([("a", 4, 4, 0.0, 4.0, 1.0, 1.0, None)], "covariate string, width int, height int, x0 double, y0 double, dx double, dy double, nodata double")
    cells = spark.range(16).select(F.lit("a").alias("covariate"), (F.col("id") / 4).cast("int").alias("row"), (F.col("id") % 4).cast("int").alias("col"), F.col("id").cast("float").alias("value"))
    points = spark.range(100).select("id", (F.col("id") % 4).cast("double").alias("x"), (F.col("id") % 3).cast("double").alias("y"))
    text = plan(raster.sample_at_points(points, cells, meta, ["a"]))
    # The only exchanges belong to the stacked cells and their broadcast.
    assert "BroadcastHashJoin" in text and text.count("Exchange hashpartitioning") == 1


def _four_grids(spark, folder):
    names = ["a", "b", "c", "d"]
    meta = spark.createDataFrame(
        [(n, 600, 600, 0.0, 600.0 + i, 1.0, 1.0, None) for i, n in enumerate(names)],
        "covariate string, width int, height int, x0 double, y0 double, dx double, dy double, nodata double",
    )
    cells = spark.range(4 * 3600).select(
        F.element_at(F.array(*map(F.lit, names)), (F.col("id") % 4 + 1).cast("int")).alias("covariate"),
        (F.col("id") / 4 / 60).cast("int").alias("row"), ((F.col("id") / 4).cast("int") % 60).alias("col"), F.col("id").cast("float").alias("value"),
    )
    # Half of the points are in one cell.
    points = spark.range(6000).select(
        "id", F.when(F.col("id") % 2 == 0, 5.5).otherwise(F.col("id") % 60 + 0.5).alias("x"),
        F.when(F.col("id") % 2 == 0, 580.5).otherwise(600.5 - F.col("id") % 47).alias("y"),
    )
    cells.write.parquet(f"{folder}/cells")
    points.write.parquet(f"{folder}/points")
    return spark.read.parquet(f"{folder}/points"), spark.read.parquet(f"{folder}/cells"), meta, names


def test_sampling_many_grids_reads_the_points_once(spark, tmp_path, monkeypatch):
    from covaria.operators import joins

    points, cells, meta, names = _four_grids(spark, tmp_path)
    want = sorted(map(str, raster.sample_at_points(points, cells, meta, names).collect()))
    # As if nothing were small enough for a broadcast.
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        _check_four_grids(spark, joins, points, cells, meta, names, want)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _check_four_grids(spark, joins, points, cells, meta, names, want):
    assert joins.hot_keys(points, ["x", "y"]) == [(5.5, 580.5)]
    df = raster.sample_at_points(points, cells, meta, names)
    text = plan(df)
    assert text.count("SortMergeJoin") == 4 and "BroadcastHashJoin" not in text
    # Only the final plan's part that runs: one scan of the points, one of the cells for each grid.
    assert text.count("ReadSchema: struct<id:bigint,x:double,y:double>") == 1
    assert text.count("ReadSchema: struct<covariate:string,row:int,col:int,value:float>") == 4
    assert sorted(map(str, df.collect())) == want


def test_wide_lookup_rows_are_not_broadcast_and_seldom_copied(spark, monkeypatch):
    from covaria.operators import joins

    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    dealt = []
    monkeypatch.setattr(joins, "_by_places", lambda *a, f=joins._by_places: dealt.append(f(*a)) or dealt[-1])
    # Each of 400 tiles is asked for twice: all are over 1/1000 of the rows, none is worth a copy.
    left = spark.range(800).select((F.col("id") % 400).alias("k"), "id")
    right = spark.range(400).select(F.col("id").alias("k"), F.array_repeat(F.col("id"), 100).alias("values"))
    df = joins.lookup_join(left, right, ["k"])
    assert "BroadcastHashJoin" not in plan(df) and sorted(dealt[-1]) == [1]
    assert {(r["k"], r["id"], r["values"][99]) for r in df.collect()} == {(i % 400, i, i % 400) for i in range(800)}
    # One tile with half of the rows is dealt out.
    crowded = left.withColumn("k", F.when(F.col("id") < 400, F.lit(7)).otherwise(F.col("k")))
    assert joins.lookup_join(crowded, right, ["k"]).count() == 800 and max(dealt[-1]) == joins.PLACES


def test_chosen_bands_reach_the_scan(spark, tmp_path):
    spark.range(40).select(
        F.concat(F.lit("r"), (F.col("id") % 10).cast("string")).alias("raster"), (F.col("id") % 2 + 1).cast("int").alias("band"),
        F.lit(0).alias("row"), F.col("id").cast("int").alias("col"), F.lit(1.0).cast("float").alias("value"),
    ).write.parquet(f"{tmp_path}/cells")
    meta = spark.createDataFrame([(f"r{i}", 2) for i in range(10)], "raster string, n_bands int")
    text = plan(raster.split_bands(spark.read.parquet(f"{tmp_path}/cells"), meta, ["r3_2"]))
    assert "EqualTo(raster,r3)" in text and "EqualTo(band,2)" in text


def test_full_size_tile(spark):
    cells = spark.range(256 * 256).filter("id % 7 != 3").select(
        F.lit("a").alias("covariate"), (F.col("id") / 256).cast("int").alias("row"), (F.col("id") % 256).cast("int").alias("col"), F.col("id").cast("float").alias("value")
    )
    values = raster.tiles(cells).first()["values"]
    assert len(values) == 256 * 256 and all(v == (None if i % 7 == 3 else i) for i, v in enumerate(values))


def test_mosaic_merges_before_the_shuffle(spark):
    strips = spark.range(10).select((F.col("id") % 2).alias("row"), F.lit(0).alias("col"), F.col("id").alias("strip"), F.col("id").cast("double").alias("value"))
    text = plan(raster.mosaic(strips))
    assert "partial_min_by" in text and text.count("Exchange") == 1


def test_moments_have_one_entry_per_fold(stored):
    folds = split.assign_folds(stored, "key", 5)
    m = gram.moments(folds, ["quantity", "tax"], by="fold")
    assert sorted(m) == [0, 1, 2, 3, 4]
