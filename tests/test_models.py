import numpy as np
import pytest
from pyspark.sql import functions as F

from covaria.models.ensembles import BootstrappedRegressor, QuantileIntervalRegressor, SuperLearner, interval_columns, voting_members
from covaria.models.linear import GramRegressor
from covaria.models.neighbours import NeighbourRegressor
from covaria.models.registry import CLASSIFIERS, REGRESSORS, classifier, load, regressor
from covaria.models.trees import boosted_trees, decision_tree
from covaria.operators import gram, neighbours
from covaria.operators.bayes import class_probability, fit_gaussian
from covaria.operators.standardise import standardise
from covaria.plans.views import FEATURES
from covaria.session import held

QUICK = {"num_boost_round": 4, "max_depth": 3, "learning_rate": 0.4, "gamma": 0, "colsample_bylevel": 1.0, "subsample": 1.0}


def _design(df, features=FEATURES):
    pdf = df.select(*features, "target").toPandas().astype(float)
    return np.column_stack([np.ones(len(pdf)), pdf[features].to_numpy()]), pdf["target"].to_numpy()


def test_linear_fit_equals_direct_least_squares(training):
    x, y = _design(training)
    want = np.linalg.lstsq(x, y, rcond=None)[0]
    for method in ("builtin", "batched"):
        fit = gram.fit_moments(gram.moments(training, FEATURES, method=method)[0])
        assert fit.intercept == pytest.approx(want[0], rel=1e-6)
        assert fit.weights == pytest.approx(want[1:], rel=1e-6)


def test_moment_methods_agree_per_fold(training):
    df = training.withColumn("fold", F.pmod(F.xxhash64("key"), F.lit(3)).cast("int"))
    a, b = (gram.moments(df, FEATURES, by="fold", method=m) for m in ("builtin", "batched"))
    assert a.keys() == b.keys() == {0, 1, 2}
    for f in a:
        assert a[f].n == b[f].n
        assert a[f].mean == pytest.approx(b[f].mean, rel=1e-9)
        assert a[f].cross == pytest.approx(b[f].cross, rel=1e-6, abs=1e-3)


def test_many_columns_take_the_batched_way(training):
    wide = training.select("target", *FEATURES, *[(F.col("quantity") * i + F.col("tax") ** 2).alias(f"w{i}") for i in range(2, 12)])
    names = [c for c in wide.columns if c != "target"]
    assert len(names) > gram.BUILTIN_WIDTH
    x, y = _design(wide, names)
    fit = gram.fit_moments(gram.moments(wide, names)[0])
    guess = fit.intercept + x[:, 1:] @ fit.weights
    best = x @ np.linalg.lstsq(x, y, rcond=None)[0]
    assert np.abs(guess - best).max() < 1e-3 * y.std()


def test_weights_repeat_rows(spark):
    rows = [(1.0, 2.0, 1.0), (2.0, 3.0, 3.0), (4.0, 9.0, 2.0), (5.0, 8.0, 1.0)]
    df = spark.createDataFrame(rows, "a double, target double, weight double")
    repeated = df.withColumn("n", F.explode(F.sequence(F.lit(1), F.col("weight").cast("int"))))
    weighted = GramRegressor().fit(df, ["a"], weight="weight").fit
    plain = GramRegressor().fit(repeated, ["a"]).fit
    assert weighted.weights == pytest.approx(plain.weights)
    assert weighted.intercept == pytest.approx(plain.intercept)


def test_constant_and_collinear_columns(spark):
    df = spark.range(50).select(F.col("id").cast("double").alias("a"), (F.col("id") * 2.0).alias("b"), F.lit(7.0).alias("c"), (F.col("id") * 3.0 + 1).alias("target"))
    out = GramRegressor().fit(df, ["a", "b", "c"]).transform(df)
    assert out.agg(F.max(F.abs(F.col("prediction") - F.col("target")))).first()[0] < 1e-6
    constant = GramRegressor().fit(df.withColumn("target", F.lit(4.0)), ["a"]).transform(df)
    assert constant.agg(F.max(F.abs(F.col("prediction") - 4))).first()[0] < 1e-9


@pytest.mark.parametrize(
    ("name", "param"),
    [
        ("XGBRegressor", QUICK),
        ("CatBoostRegressor", {"iterations": 3, "depth": 3, "learning_rate": 0.4}),
        ("LightGBMRegressor", {"n_estimators": 3, "num_leaves": 7, "learning_rate": 0.4}),
        ("RandomForestRegressor", {"n_estimators": 3, "max_depth": 4}),
        ("DecisionTreeRegressor", {"max_depth": 4}),
        ("SVMRegressor", {"components": 8, "max_iter": 5}),
        ("BootstrappedXGBRegressor", {**QUICK, "bootstrapped_number_of_models": 2}),
        ("GramRegressor", None),
    ],
)
def test_models_fit_save_load(spark, training, tmp_path, name, param):
    fitted = regressor(name, param).fit(training, FEATURES)
    path = str(tmp_path / name)
    fitted.save(path)
    again = load(spark, name, path)
    assert list(again.features) == FEATURES
    a = fitted.transform(training).select("key", "prediction")
    b = again.transform(training).select("key", F.col("prediction").alias("other"))
    assert a.count() == training.count()
    assert a.join(b, "key").filter(F.abs(F.col("prediction") - F.col("other")) > 1e-6).count() == 0
    if name not in ("SVMRegressor", "BootstrappedXGBRegressor"):
        importance = fitted.importance(spark)
        assert {r["feature"] for r in importance.collect()} == set(FEATURES)
        scores = [r["score"] for r in importance.collect()]
        assert scores == sorted(scores, reverse=True)
    if name in ("XGBRegressor", "RandomForestRegressor", "DecisionTreeRegressor"):
        assert fitted.importance(spark).first()["feature"] == "quantity"


def test_parameters_out_of_range_or_unknown_are_refused(training):
    for wrong in ({"learning_rate": 10}, {"subsample": 0}, {"max_depth": 31}, {"colsample_bytree": 0}):
        with pytest.raises(ValueError, match=next(iter(wrong))):
            boosted_trees({**QUICK, "num_boost_round": 1, **wrong}).fit(training.limit(200), ["quantity"])
    for name in ("XGBRegressor", "CatBoostRegressor", "RandomForestRegressor", "SVMRegressor", "BootstrappedSVMRegressor", "KNeighborsRegressor",
                 "GramRegressor", "QuantileGradientBoosting", "LightGBMRegressor", "BootstrappedXGBRegressor"):
        with pytest.raises(ValueError, match="unknown parameters"):
            built = regressor(name, {"nonsense": 1})
            built.member(0)
    assert list(boosted_trees({"lambda": 1, "max_depth": 3, "alpha": 0}).unused) == ["alpha", "lambda"]
    assert regressor("SuperLearnerRegressor", {"max_depth": 3, "num_boost_round": 100}).unused == ["max_depth", "num_boost_round"]
    with pytest.raises(ValueError, match="weight"):
        NeighbourRegressor().fit(training, ["quantity"], weight="tax")
    with pytest.raises(ValueError, match="weight"):
        SuperLearner([decision_tree()]).fit(training, ["quantity"], weight="tax")


def test_whole_and_fractional_parameters():
    built = boosted_trees({"max_depth": 4.9, "num_boost_round": 3.7}).build()
    assert (built.getMaxDepth(), built.getMaxIter()) == (4, 3)


def test_both_moment_ways_keep_all_folds(spark):
    rows = [(float(i % 4) / 2 if i % 4 else None, float(i), float(i * i % 7)) for i in range(40)]
    for kind, table in (("double", rows), ("string", [(None if f is None else f"f{f}", a, b) for f, a, b in rows])):
        df = spark.createDataFrame(table, f"fold {kind}, a double, target double")
        one, two = (gram.moments(df, ["a"], by="fold", method=m) for m in ("builtin", "batched"))
        assert set(one) == set(two) and len(one) == 4 and None in one
        for fold in one:
            assert one[fold].n == two[fold].n == 10 and np.allclose(one[fold].mean, two[fold].mean) and np.allclose(one[fold].cross, two[fold].cross)
    folds = spark.createDataFrame([(0.5, 1.0), (1.5, 1.0), (None, 1.0)], "fold double, a double")
    fits = {0.5: gram.LinearFit(np.array([2.0]), 0.0), 1.5: gram.LinearFit(np.array([3.0]), 0.0)}
    assert [r[0] for r in folds.select(gram.fold_prediction(fits, ["a"])).collect()] == [2.0, 3.0, None]


def test_registry_rejects_unknown_names():
    assert len(REGRESSORS) >= 10 and len(CLASSIFIERS) == 6
    with pytest.raises(ValueError, match="unknown model"):
        regressor("Nope")
    with pytest.raises(ValueError, match="no class probability"):
        classifier("LinearSVC")


def test_ensemble_mean_and_members(training):
    model = BootstrappedRegressor(lambda i: decision_tree({"max_depth": 2 + i}), n_models=2, fraction=0.5, seed=3)
    out = model.fit(training, FEATURES).transform_all(training)
    assert out.filter(F.abs((F.col("prediction_0") + F.col("prediction_1")) / 2 - F.col("prediction")) > 1e-6).count() == 0
    bagged = BootstrappedRegressor(lambda i: GramRegressor(), n_models=2, fraction=1.0, replace=True, resample_each=True)
    fits = bagged.fit(training, FEATURES).members
    assert not np.allclose(fits[0].fit.weights, fits[1].fit.weights)


def test_super_learner_members(training, spark, tmp_path):
    assert len(voting_members()) == 10
    few = training.limit(300).cache()
    fitted = SuperLearner([GramRegressor(), decision_tree({"max_depth": 3}), NeighbourRegressor(3)]).fit(few, ["quantity", "size"])
    out = fitted.transform(few)
    assert out.count() == 300 and out.filter("prediction IS NULL").count() == 0
    fitted.save(str(tmp_path / "vote"))
    again = load(spark, "SuperLearnerRegressor", str(tmp_path / "vote"))
    assert len(again.members) == 3 and again.transform(few).count() == 300


def test_quantile_interval(training):
    fitted = QuantileIntervalRegressor(n_estimators=2).fit(training, FEATURES)
    # The 5 % and 95 % bounds per leaf hold nine tenths of the rows.
    placed = fitted.tree.raw(training).join(fitted.leaves, "_leaf")
    held = placed.agg(F.avg(F.col("target").between(F.col("_low"), F.col("_high")).cast("int")), F.count(F.lit(1))).first()
    assert 0.88 < held[0] < 0.93 and held[1] == training.count()
    out = fitted.predict_dist(training)
    row = out.agg(
        F.min("variance"), F.min(F.col("upper") - F.col("lower")), F.max(F.abs(F.col("upper") + F.col("lower") - 2 * F.col("mean"))), F.count("lower")
    ).first()
    assert row[0] >= 0 and row[1] >= 0 and row[2] < 1e-6 and row[3] == training.count()


def test_interval_arithmetic(spark):
    df = spark.createDataFrame([(10.0, 5.0, 15.0)], "m double, l double, h double")
    cols = interval_columns(F.col("m"), F.col("l"), F.col("h"))
    row = df.select(*[c.alias(n) for n, c in cols.items()]).first()
    deviation = 10 / (2 * 1.6448536269514722)
    assert row["variance"] == pytest.approx(deviation**2)
    assert row["upper"] - 10 == pytest.approx(1.959963984540054 * deviation)


# ---- neighbours ----------------------------------------------------------------------


def _brute(q, r, k, skip_self):
    out = {}
    for qk, qv in q:
        near = sorted((float(((qv - rv) ** 2).sum()), rk) for rk, rv in r if not (skip_self and rk == qk))[:k]
        out[qk] = [rk for _, rk in near]
    return out


@pytest.mark.parametrize("skip_self", [False, True])
@pytest.mark.parametrize("small", [True, False])
def test_nearest_is_exact(spark, skip_self, small):
    """Clustered points with a third of them equal: ties and one crowded cell."""
    rng = np.random.default_rng(1)
    pts = np.vstack([np.full((80, 3), 0.25), rng.normal(0, 1, (100, 3)), rng.normal(8, 0.2, (60, 3))])
    rows = [(i, *map(float, p)) for i, p in enumerate(pts)]
    df = spark.createDataFrame(rows, "key long, a double, b double, c double")
    extra = {} if small else {"shipped_values": 0, "pivots": 7, "block_rows": 25}
    got = neighbours.nearest(df, df, ["a", "b", "c"], 4, skip_self=skip_self, **extra)
    found = {}
    for r in got.orderBy("query", "position").collect():
        found.setdefault(r["query"], []).append(r["neighbour"])
    pairs = [(i, p) for i, p in enumerate(pts)]
    assert found == _brute(pairs, pairs, 4, skip_self)


def test_fewer_references_than_neighbours(spark):
    df = spark.createDataFrame([(0, 0.0), (1, 1.0), (2, 5.0)], "key long, a double")
    for extra in ({}, {"shipped_values": 0, "pivots": 2}):
        got = neighbours.nearest(df, df, ["a"], 5, skip_self=True, **extra)
        assert sorted((r["query"], r["neighbour"]) for r in got.collect()) == [(0, 1), (0, 2), (1, 0), (1, 2), (2, 0), (2, 1)]


def test_vote_and_mean(spark):
    df = spark.createDataFrame([(0, 0.0, 1), (1, 0.1, 1), (2, 0.2, 2), (3, 9.0, 2)], "key long, a double, label int")
    pairs = neighbours.nearest(df, df, ["a"], 3)
    votes = {r["query"]: (r["prediction"], r["share"]) for r in neighbours.neighbour_vote(pairs, df, "key", "label").collect()}
    assert votes[0] == (1, pytest.approx(2 / 3))
    means = {r["query"]: r["prediction"] for r in neighbours.neighbour_mean(pairs, df, "key", "label").collect()}
    assert means[0] == pytest.approx(4 / 3)


# ---- classes --------------------------------------------------------------------------


def test_gaussian_bayes_matches_formula(spark):
    rng = np.random.default_rng(2)
    rows = [(float(v), 1) for v in rng.normal(0, 1, 60)] + [(float(v), 2) for v in rng.normal(2, 0.5, 40)]
    df = spark.createDataFrame(rows, "a double, class int")
    classes = fit_gaussian(df, ["a"])
    got = [r["p"] for r in df.select(class_probability(classes, ["a"], 1).alias("p")).collect()]
    x = np.array([r[0] for r in rows])
    y = np.array([r[1] for r in rows])
    eps = 1e-9 * x.var()

    def joint(c):
        s = x[y == c]
        v = s.var() + eps
        return (len(s) / len(x)) * np.exp(-((x - s.mean()) ** 2) / (2 * v)) / np.sqrt(2 * np.pi * v)

    assert got == pytest.approx(list(joint(1) / (joint(1) + joint(2))))


def test_far_away_rows_do_not_overflow(spark):
    df = spark.createDataFrame([(0.0, 1), (1.0, 1), (100.0, 2), (101.0, 2), (1e6, 2)], "a double, class int")
    p = class_probability(fit_gaussian(df.filter("a < 1000"), ["a"]), ["a"], 1)
    assert all(0 <= r["p"] <= 1 for r in df.select(p.alias("p")).collect())


def test_standardise_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert [tuple(r) for r in standardise(df, ["a", "b"]).collect()] == [(-1.0, 0.0), (1.0, 0.0)]


@pytest.mark.parametrize("width", [2, 20])
def test_neighbours_in_cells_are_exact(spark, width):
    """Few features and many, a crowded place, keys that repeat, rows without a place, queries that are not references."""
    rng = np.random.default_rng(3)
    pts = np.vstack([np.full((300, width), 0.5), rng.normal(0, 1, (500, width)), np.full((1, width), np.nan)])
    rows = [(i % 790, [float(x) for x in p]) for i, p in enumerate(pts)]
    names = [f"f{j}" for j in range(width)]
    df = spark.createDataFrame(rows, "key long, v array<double>").select("key", *[F.col("v")[j].alias(n) for j, n in enumerate(names)])
    asked = df.filter("key % 3 = 0")
    for skip in (False, True):
        got = neighbours.nearest(asked, df, names, 3, skip_self=skip, shipped_values=0, pivots=8, block_rows=60)
        found = {}
        for r in got.orderBy("query", "position").collect():
            found.setdefault(r["query"], []).append((r["neighbour"], r["distance2"]))
        known = [(k, np.array(p)) for k, p in rows if not np.isnan(p[0])]
        want = {}
        for k, p in known:
            if k % 3 == 0:
                # The distances of the operator, feature by feature.
                near = [(sum(((a - b) ** 2 for a, b in zip(p, o)), 0.0), j) for j, o in known if not (skip and j == k)]
                want.setdefault(k, []).extend(sorted(near)[:3])
        want = {k: [(j, d) for d, j in sorted(v)[:3]] for k, v in want.items()}
        assert {k: [j for j, _ in v] for k, v in found.items()} == {k: [j for j, _ in v] for k, v in want.items()}
        assert all(a[1] == pytest.approx(b[1], abs=1e-12) for k in want for a, b in zip(found[k], want[k]))


@pytest.mark.parametrize("width", [3, 20])
def test_search_with_far_bounds_holds_few_pairs(monkeypatch, width):
    """a bound from a sparse place lets all rows of a crowded one pass, which must not pile up in a task."""
    import tracemalloc

    monkeypatch.setattr(neighbours, "_CHUNK", 50_000)
    random = np.random.default_rng(5)
    q, r = random.normal(size=(1500, width)), random.normal(size=(4000, width))
    codes, bound = np.arange(1500), np.full(1500, 1e6)
    tracemalloc.start()
    qi, ri, d = neighbours._search(q, codes, bound, r, np.full(4000, -2), 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # All pairs take 144 MB.
    assert peak < 40e6
    whole = ((q[:, None, :] - r[None, :, :]) ** 2).sum(axis=2)
    want = np.argsort(whole, axis=1, kind="stable")[:, :3]
    assert (ri.reshape(-1, 3) == want).all() and (qi == np.repeat(codes, 3)).all() and np.allclose(d, np.sort(whole, axis=1)[:, :3].ravel())


def _odd_rows(spark):
    """Crowded places, keys that come twice at one place or at two, null keys, gaps in features and labels."""
    rows = [(f"k{i}", float(i % 5), float(i % 3), float(i)) for i in range(90)]
    rows += [("k1", 1.0, 1.0, 500.0), ("k2", 9.0, 9.0, 7.0), ("k3", None, 0.0, 900.0), (None, 2.0, 2.0, 40.0), (None, 3.0, 0.0, 50.0),
             ("gap", float("nan"), 0.0, 1.0), ("far", 40.0, 40.0, None), ("zero", -0.0, 0.0, 3.0), ("k4", 4.0, 1.0, 4.0)]
    return spark.createDataFrame(rows, "key string, a double, b double, label double")


@pytest.mark.parametrize("extra", [{}, {"shipped_values": 0, "pivots": 4, "block_rows": 10}])
def test_mean_by_places_is_the_mean_by_rows(spark, extra):
    """keys that repeat or are null keep all their neighbours and labels."""
    df = _odd_rows(spark)
    asked = df.filter("label % 3 = 0 or label is null or label >= 40 or key = 'gap'").drop("label")
    pairs = neighbours.nearest(asked, df, ["a", "b"], 4, **extra)
    means = neighbours.neighbour_mean(pairs, df, "key", "label").withColumnRenamed("query", "key")
    got = neighbours.with_nearest_mean(asked, df, ["a", "b"], 4, "key", "label", "prediction", **extra)
    want = asked.join(means, "key", "left")
    assert got.columns == want.columns

    def rows(table):
        return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in table.fillna(-1.0, ["prediction"]).fillna("none").fillna(-5.0).collect())

    assert rows(got) == rows(want)
    assert got.filter("key is null and prediction is not null").count() == 0 and got.filter("prediction is null").count() >= 3


def test_each_place_is_searched_once(spark, monkeypatch):
    """rows at one place are one query, and the fitted rows are read from files."""
    df = _odd_rows(spark)
    fitted = NeighbourRegressor(4).fit(df, ["a", "b"], "label")
    assert fitted.table.inputFiles()
    seen, best = [], neighbours._best
    monkeypatch.setattr(neighbours, "_best", lambda queries, *rest: seen.append(queries.count()) or best(queries, *rest))
    assert fitted.transform(df.drop("label")).count() == df.count()
    assert seen == [df.dropna(subset=["a", "b"]).filter("not isnan(a)").select(F.col("a") + F.lit(0.0), "b").distinct().count()]


def test_super_learner_holds_its_rows_once(spark):
    """members read the table that the caller holds, not a second copy of it."""
    seen = []

    class Member(GramRegressor):
        def fit(self, df, *rest):
            seen.append(df)
            return super().fit(df, *rest)

    rows = spark.range(20).select(F.col("id").cast("string").alias("key"), F.col("id").cast("double").alias("a"), (F.col("id") * 2.0).alias("y"))
    with held(rows) as table:
        SuperLearner([Member()]).fit(table, ["a"], "y")
        assert seen[0] is table
    SuperLearner([Member()]).fit(rows.withColumn("other", F.lit(1)), ["a"], "y")
    assert seen[1].columns == ["key", "a", "y"]
