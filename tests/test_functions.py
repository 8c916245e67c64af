import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from covaria.functions import distributions as d, metrics, naming, objectives, projection
from covaria.functions.hashing import order_value, unit_uniform
from covaria.models.registry import REGRESSORS, default_space
from covaria.operators.search import draw_trials, grid_table


def test_metrics_match_numpy(spark):
    rng = np.random.default_rng(0)
    y = rng.normal(1e6, 2, 200)
    p = y + rng.normal(0, 0.5, 200)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "target double, prediction double")
    row = metrics.score(df, list(metrics.SCORERS), 3).first()
    e = y - p
    r2 = 1 - (e**2).sum() / ((y - y.mean()) ** 2).sum()
    assert row["mean_squared_error_scorer"] == pytest.approx(-(e**2).mean())
    assert row["mean_absolute_error_scorer"] == pytest.approx(-np.abs(e).mean())
    assert row["rmse_scorer"] == pytest.approx(-math.sqrt((e**2).mean()))
    assert row["r2_scorer"] == pytest.approx(r2, rel=1e-6)
    assert row["adjusted_r2_scorer"] == pytest.approx(1 - (1 - r2) * 199 / 196, rel=1e-6)


@pytest.mark.parametrize(
    ("rows", "n_cov", "r2", "adjusted"),
    [
        ([(1.0, 1.0), (1.0, 1.0), (1.0, 1.0)], 1, 1.0, 1.0),  # constant target, exact
        ([(1.0, 2.0), (1.0, 1.0), (1.0, 1.0)], 1, 0.0, 0.0),  # constant target, wrong
        ([(1.0, 3.0), (2.0, 1.0), (3.0, 0.0)], 1, -6.0, 0.0),  # 1 - 14 / 2, floored
        ([(1.0, 1.5), (2.0, 2.0)], 1, 0.5, None),  # n = p + 1
    ],
)
def test_metric_edges(spark, rows, n_cov, r2, adjusted):
    df = spark.createDataFrame(rows, "target double, prediction double")
    row = metrics.score(df, ["r2_scorer", "adjusted_r2_scorer"], n_cov).first()
    assert row["r2_scorer"] == pytest.approx(r2)
    assert row["adjusted_r2_scorer"] == (None if adjusted is None else pytest.approx(adjusted))


def test_unknown_scorer_is_an_error():
    with pytest.raises(ValueError, match="unknown scorer"):
        metrics.scorer("nope")


def test_squared_log_is_the_derivative(spark):
    df = spark.createDataFrame([(0.5, 0.2), (3.0, 1.0), (-5.0, 0.1)], "p double, y double")
    rows = df.select(objectives.squared_log(F.col("p"), F.col("y")).alias("s"), "p", "y").collect()

    def loss(p, y):
        return 0.5 * (math.log1p(p) - math.log1p(y)) ** 2

    for r in rows[:2]:
        h = 1e-5
        assert r["s"]["grad"] == pytest.approx((loss(r["p"] + h, r["y"]) - loss(r["p"] - h, r["y"])) / (2 * h), rel=1e-4)
    assert math.isfinite(rows[2]["s"]["grad"])


def test_albers_known_point_and_round_trip(spark):
    df = spark.createDataFrame([(149.13, -35.28), (115.0, -43.0), (153.0, -10.0)], "lon double, lat double")
    x, y = projection.albers_forward(F.col("lon"), F.col("lat"))
    xy = df.withColumns({"x": x, "y": y})
    first = xy.first()
    assert first["x"] == pytest.approx(1550570.6, abs=0.1)
    assert first["y"] == pytest.approx(-3957368.6, abs=0.1)
    lon, lat = projection.albers_inverse(F.col("x"), F.col("y"))
    for r in xy.select("lon", "lat", lon.alias("lon2"), lat.alias("lat2")).collect():
        assert r["lon2"] == pytest.approx(r["lon"], abs=1e-9)
        assert r["lat2"] == pytest.approx(r["lat"], abs=1e-9)


def test_hashes_are_uniform_and_repeatable(spark):
    df = spark.range(20_000).select(
        unit_uniform(1, "id").alias("u"), unit_uniform(1, "id").alias("w"), unit_uniform(2, "id").alias("other"), order_value(1, "id").alias("o")
    )
    row = df.agg(
        F.avg("u"), F.var_pop("u"), F.corr("u", "other"), F.min("o"), F.max("o"), F.sum((F.col("u") != F.col("w")).cast("int"))
    ).first()
    assert row[0] == pytest.approx(0.5, abs=0.01)
    assert row[1] == pytest.approx(1 / 12, abs=0.005)
    assert abs(row[2]) < 0.03
    assert 0 <= row[3] and row[4] < 2**60
    assert row[5] == 0


def test_names(spark):
    df = spark.createDataFrame([("/a.b/c.tif", 2, 3), ("plain", 1, 1)], "p string, band int, n int")
    rows = df.select(
        naming.file_stem(F.col("p")).alias("stem"),
        naming.band_name(naming.file_stem(F.col("p")), F.col("band"), F.col("n")).alias("band"),
        naming.with_suffix(F.col("p"), "_fixed").alias("fixed"),
    ).collect()
    assert [tuple(r) for r in rows] == [("c", "c_2", "/a.b/c_fixed.tif"), ("plain", "plain", "plain")]


def test_distributions_stay_inside_their_bounds(spark):
    space = {
        "a": d.uniform(-1, 2), "b": d.quniform(0, 1, 0.25), "c": d.loguniform(0.01, 10), "e": d.choice(["p", "q"]),
        "f": d.randint(3, 6), "g": d.qrandint(0, 20, 5), "h": d.lograndint(1, 50), "n": d.randn(5, 2), "s": d.function(lambda u: u + 1),
    }
    assert set(d.DISTRIBUTIONS) >= {"uniform", "qloguniform", "sample_from", "function", "qrandn"}
    ids = spark.range(4000).withColumnRenamed("id", "trial_id")
    t = draw_trials(ids, space, 9).cache()
    r = t.agg(
        F.min("a"), F.max("a"), F.collect_set("b"), F.min("c"), F.max("c"), F.collect_set("e"), F.collect_set("f"),
        F.collect_set("g"), F.min("h"), F.max("h"), F.avg("n"), F.stddev("n"), F.min("s"), F.max("s"),
    ).first()
    assert -1 <= r[0] and r[1] < 2
    assert set(r[2]) == {0.0, 0.25, 0.5, 0.75, 1.0}
    assert 0.01 <= r[3] and r[4] < 10
    assert set(r[5]) == {"p", "q"} and set(r[6]) == {3, 4, 5} and set(r[7]) == {0, 5, 10, 15, 20}
    assert 1 <= r[8] and r[9] < 50
    assert r[10] == pytest.approx(5, abs=0.2) and r[11] == pytest.approx(2, abs=0.15)
    assert 1 <= r[12] and r[13] < 2


def test_grid_is_the_full_product(spark):
    rows = {(r["a"], r["b"], r["c"]) for r in grid_table(spark, {"a": [1, 2], "b": ["x", "y", "z"], "c": [0.5]}).collect()}
    assert rows == {(a, b, 0.5) for a in (1, 2) for b in "xyz"}


def test_default_spaces(spark):
    assert set(default_space("XGBRegressor")) >= {"max_depth", "gamma", "base_score"}
    assert default_space("CatBoostRegressor")["grow_policy"].options == ("SymmetricTree", "Depthwise", "Lossguide")
    assert all(isinstance(default_space(n), dict) for n in REGRESSORS)
