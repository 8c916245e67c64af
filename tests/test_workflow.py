import numpy as np
import pytest
from pyspark.sql import functions as F

from covaria.functions import distributions as d, metrics
from covaria.models.classifiers import GaussianBayes
from covaria.models.linear import GramRegressor
from covaria.models.registry import classifier, regressor
from covaria.operators.points import normalise_points
from covaria.sources.tables import read_geojson
from covaria.operators import drift, explore, ranking, scoring, search, shapley, split
from covaria.plans.config import ConfigError, RankingConfig, SearchConfig, TargetConfig, WorkflowConfig
from covaria.plans.fit_queries import raster_inputs
from covaria.plans.views import FEATURES
from covaria.plans.workflow import rank_features, run_workflow

SCORERS = list(metrics.SCORERS)


# ---- scores and ranking ---------------------------------------------------------------


def test_cv_scores_match_numpy(training):
    folds = split.assign_folds(training, "key", 4).cache()
    got = {r["fold"]: r for r in scoring.fold_scores(folds, FEATURES, GramRegressor(), SCORERS).collect()}
    pdf = folds.toPandas()
    x = np.column_stack([np.ones(len(pdf)), pdf[FEATURES].to_numpy(dtype=float)])
    y, fold = pdf["target"].to_numpy(dtype=float), pdf["fold"].to_numpy()
    for f in range(4):
        w = np.linalg.lstsq(x[fold != f], y[fold != f], rcond=None)[0]
        e = y[fold == f] - x[fold == f] @ w
        assert got[f]["mean_absolute_error_scorer"] == pytest.approx(-np.abs(e).mean(), rel=1e-6)
        assert got[f]["rmse_scorer"] == pytest.approx(-np.sqrt((e**2).mean()), rel=1e-6)


def test_moment_and_pass_scores_agree(training):
    """The score from sums alone equals the score from predictions."""
    folds = split.assign_folds(training, "key", 3).cache()
    subsets = [FEATURES, ["quantity"], ["tax", "size"]]
    for name in ("r2_scorer", "rmse_scorer", "adjusted_r2_scorer"):
        a = ranking.MomentFolds(folds, FEATURES, name, "fold", 0.0).scores(subsets)
        b = ranking.LinearFolds(folds, FEATURES, name, "fold", 0.0).scores(subsets)
        c = ranking.ModelFolds(folds, GramRegressor(), name, "fold").scores(subsets)
        assert a == pytest.approx(b, rel=1e-6) and a == pytest.approx(c, rel=1e-6)


def test_group_scores_without_groups_are_null(training):
    row = scoring.group_scores(training, FEATURES, GramRegressor(), SCORERS).first()
    assert all(row[f"groupcv_{s}"] is None for s in SCORERS)


def test_elimination_order(training):
    """Known order for this target: the product of quantity, price and (1 - discount)."""
    table, chosen, log = rank_features(training, RankingConfig("FeatureRankingByEliminationCV", "r2_scorer", 5, 2), GramRegressor(), features=FEATURES)
    order = [r["feature"] for r in table.orderBy("rank").collect()]
    assert sorted(order) == sorted(FEATURES)
    assert set(order[:2]) == {"tax", "size"} and order[-1] == "quantity"
    assert chosen == order[-2:]
    assert table.orderBy("rank").collect()[-1]["score"] == 0.0
    assert log.groupBy("iteration").count().orderBy("iteration").collect()[0]["count"] == 5


def test_oos_elimination_scores_the_last_feature(training):
    train, oos = split.holdout(training, "key", 20)
    for scorer in ("r2_scorer", "mean_absolute_error_scorer"):
        log = ranking.oos_elimination(train, oos, ["tax", "quantity"], GramRegressor(), scorer)
        last = log.filter("iteration = 1").first()
        first = log.filter("iteration = 0 AND feature = 'tax'").first()
        assert last["feature"] == "quantity" and last["score"] == pytest.approx(first["score"])


def test_elimination_with_one_feature_and_ties(spark):
    class Flat(ranking.SubsetScorer):
        def scores(self, subsets):
            return [1.0] * len(subsets)

    rows = ranking.eliminate(["c", "a", "b"], Flat(), score_last=False)
    assert [r[2] for r in ranking.eliminated(ranking.log_table(spark, rows)).orderBy("rank").select("rank", "score", "feature").collect()] == ["c", "a", "b"]
    assert ranking.eliminate(["only"], Flat(), score_last=False) == [(0, 0, "only", 0.0)]
    assert ranking.eliminate([], Flat(), score_last=True) == []


def test_tree_elimination_and_group_method(training):
    grouped = split.assign_group_folds(training, "groupcv", 2)
    conf = RankingConfig("FeatureRankingByGroupCV", "rmse_scorer", 2)
    table, _, _ = rank_features(grouped, conf, regressor("DecisionTreeRegressor", {"max_depth": 3}), features=["tax", "quantity"])
    assert [r["feature"] for r in table.orderBy("rank").collect()] == ["tax", "quantity"]


def test_random_ranking_shape(spark):
    names = list("abcdef")
    rows = ranking.random_ranking(spark, names, 3, 1).collect()
    assert len(rows) == 3
    for r in rows:
        i = names.index(r["feature"])
        assert r["rank"] == 6 - i and r["score"] == i / 10
    with pytest.raises(ValueError, match="cannot choose"):
        ranking.random_ranking(spark, names, 7)


def test_ranked_report_adds_what_stayed(spark):
    gone = spark.createDataFrame([(0, "c", 0.1), (1, "a", 0.2)], "iteration int, feature string, score double")
    everyone = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c"), (3, "d")], "position int, feature string")
    rows = [(r["Rank"], r["Feature"], round(r["Score"], 6), r["Iteration"]) for r in ranking.ranked_report(gone, everyone).collect()]
    assert rows == [(-1, "d", 0.22, 1), (-1, "b", 0.21, 1), (-1, "a", 0.2, 1), (-2, "c", 0.1, 0)]


def test_sampled_shapley_adds_up_and_agrees_with_the_closed_form(training):
    few = training.limit(400).cache()
    model = GramRegressor().fit(few, ["quantity", "discount"])
    exact = shapley.importance(shapley.linear_values(model, few), model.features).collect()
    values = shapley.sampled_values(model, few, "key", permutations=8).cache()
    assert values.count() == 800
    sampled = {r["feature"]: r["phi"] for r in values.groupBy("feature").agg(F.avg(F.abs("phi")).alias("phi")).collect()}
    for r in exact:
        assert sampled[r["feature"]] == pytest.approx(r["score"], rel=0.25)
    # Gains along a walk sum to f(row) - f(background): zero on average.
    total = values.groupBy("key").agg(F.sum("phi").alias("s")).agg(F.avg("s"), F.stddev("s")).first()
    assert abs(total[0]) < total[1]


# ---- search -----------------------------------------------------------------------------


def _result(rows):
    return [(i, {"a": i}, {"m": s}) for i, s in rows]


def test_best_trial_breaks_ties_by_id(spark):
    table = search.results_table(spark, _result([(0, 1.0), (1, 3.0), (2, 3.0), (3, None)]))
    best = search.best_trial(table, "m").first()
    assert best["trial_id"] == 1 and best["params"] == {"a": "1"}


def test_shapley_ranking_takes_models_that_need_a_row_key(spark, training):
    train, oos = split.holdout(training.limit(600), "key", 10)
    # The model and parameters of a Shapley run as it is usually configured; they are the boosters', and the vote has its own.
    model = regressor("SuperLearnerRegressor", {"max_depth": 7, "num_boost_round": 100, "learning_rate": 0.3})
    model.members = [GramRegressor(), regressor("KNeighborsRegressor", {"k": 3})]
    ranked = rank_features(train, RankingConfig("FeatureRankingByShap", "r2_scorer", 5), model, oos, features=["quantity", "size"])[0]
    assert {r["feature"] for r in ranked.collect()} == {"quantity", "size"}


def test_sampled_shapley_is_exact_for_an_additive_model(spark, training):
    fitted = GramRegressor().fit(training, FEATURES)
    data = training.limit(200)
    got = shapley.sampled_values(fitted, data, "key", 3)
    # For a linear model every order gives a feature its weight times the change of its value.
    totals = got.groupBy("key").agg(F.sum("phi").alias("total"), F.count("*").alias("n"))
    assert totals.filter(f"n != {len(FEATURES)}").count() == 0 and totals.count() == data.count()
    sums = got.groupBy("feature").agg(F.avg("phi").alias("phi")).collect()
    exact = {f: abs(w) * data.agg(F.stddev(f)).first()[0] for f, w in zip(FEATURES, fitted.fit.weights)}
    assert all(abs(r["phi"]) <= exact[r["feature"]] + 1e-6 for r in sums)


def test_nan_is_never_the_best(spark):
    rows = _result([(0, float("nan")), (1, 1.0), (2, None), (3, 2.0)])
    assert search.best_trial(search.results_table(spark, rows), "m").first()["trial_id"] == 3
    assert search._top(rows, "m", 0.5)[0][0] == 3
    log = spark.createDataFrame([(0, 0, "a", float("nan")), (0, 1, "b", 1.0), (1, 0, "c", None), (1, 1, "d", float("nan"))], ranking.LOG_SCHEMA)
    assert [tuple(r) for r in ranking.eliminated(log).orderBy("rank").collect()] == [("b", 0, 1.0), ("c", 1, None)]
    assert ranking.arg_max(log).first()[0] == "b"

    class Scores(ranking.SubsetScorer):
        def scores(self, subsets):
            return [float("nan") if "b" in s else 0.5 for s in subsets]

    assert [r[2] for r in ranking.eliminate(["a", "b", "c"], Scores(), False)][:1] == ["a"]


def test_halving_keeps_every_trial(spark):
    results = search.halving_search(spark, {"x": d.uniform(0, 1)}, lambda p, budget: {"m": p["x"] + budget}, "m", 16, jobs=1)
    assert sorted(r[0] for r in results) == list(range(16))
    assert sorted((r[2]["budget"], r[2]["rung"]) for r in results) == [(1 / 16, 0.0)] * 12 + [(1 / 4, 1.0)] * 3 + [(1.0, 2.0)]
    table = search.results_table(spark, results)
    assert search.best_trial(table, "m").first()["trial_id"] == results[0][0]


def test_adaptive_search_moves_towards_the_optimum(spark):
    space = {"x": d.uniform(0, 10), "n": d.randint(1, 9), "k": d.choice(["p", "q"]), "l": d.loguniform(0.1, 10)}

    def objective(p, budget):
        assert 0 <= p["x"] <= 10 and 1 <= p["n"] < 9 and p["k"] in ("p", "q") and 0.1 <= p["l"] <= 10.0001
        return {"m": -((p["x"] - 7) ** 2)}

    results = search.sampled_search(spark, space, objective, "m", 40, seed=1, rounds=4)
    assert [r[0] for r in results] == list(range(40))
    first, last = results[:10], results[30:]
    assert np.mean([r[2]["m"] for r in last]) > np.mean([r[2]["m"] for r in first])


def test_halving_ends_on_all_rows(spark):
    budgets = []

    def objective(p, budget):
        budgets.append(budget)
        return {"m": p["x"]}

    results = search.halving_search(spark, {"x": d.uniform(0, 1)}, objective, "m", 16, jobs=1)
    assert sorted(set(budgets)) == [1 / 16, 1 / 4, 1.0] and budgets.count(1.0) == 1
    everything = search.trial_table(spark, {"x": d.uniform(0, 1)}, 16).agg(F.max("x")).first()[0]
    assert results[0][1]["x"] == everything


@pytest.mark.parametrize("method", ["GridSearch", "HyperBand"])
def test_trials_share_what_no_parameter_changes(spark, training, monkeypatch, method):
    train, oos = split.holdout(split.assign_group_folds(training, "groupcv", 2), "key", 10)
    sums, drawn = [], []
    monkeypatch.setattr(search, "moments", lambda *a, f=search.moments, **b: sums.append(1) or f(*a, **b))
    monkeypatch.setattr(search, "subsample", lambda *a, f=search.subsample: drawn.append(a[2]) or f(*a))
    space = {"ridge": [0.0, 0.1, 1.0] if method == "GridSearch" else d.loguniform(1e-6, 1.0)}
    found = search.search(
        train, oos, ["quantity", "discount"], lambda p: GramRegressor(**p), space, method, "oos_r2_scorer", ["r2_scorer"], n_iteration=5, n_splits=2
    )
    budgets = 1 if method == "GridSearch" else 2
    assert len(sums) == 3 * budgets and len(drawn) == 3 * (budgets - 1)
    # Scores are those of the plain way.
    best = found.best.first()
    model = GramRegressor(float(best["params"]["ridge"]))
    assert best["scores"]["oos_r2_scorer"] == pytest.approx(scoring.out_of_sample_scores(train, oos, ["quantity", "discount"], model, ["r2_scorer"]).first()[0])
    assert best["scores"]["groupcv_r2_scorer"] == pytest.approx(scoring.group_scores(train, ["quantity", "discount"], model, ["r2_scorer"]).first()[0])


def test_search_refits_and_saves(spark, training, tmp_path):
    train, oos = split.holdout(split.assign_group_folds(training, "groupcv", 2), "key", 20)
    found = search.search(
        train, oos, FEATURES, lambda p: GramRegressor(**p), {"ridge": [0.0, 1000.0]}, "GridSearch", "cv_r2_scorer",
        ["r2_scorer"], n_splits=2, save_to=str(tmp_path),
    )
    best = found.best.first()
    assert best["params"] == {"ridge": "0.0"}
    assert set(best["scores"]) == {"oos_r2_scorer", "cv_r2_scorer", "groupcv_r2_scorer"}
    # The model of every trial is there, and scores as its trial says.
    for r in found.models.collect():
        again = GramRegressor.load(spark, r["path"]).transform(oos)
        r2 = scoring.score(again, ["r2_scorer"], len(FEATURES)).first()["r2_scorer"]
        scores = found.trials.filter(F.col("trial_id") == r["trial_id"]).first()["scores"]
        assert r2 == pytest.approx(scores["oos_r2_scorer"])
    assert found.models.count() == 2
    assert found.model_path.startswith(str(tmp_path)) and GramRegressor.load(spark, found.model_path).features == FEATURES
    with pytest.raises(ValueError, match="unknown search method"):
        search.search(train, oos, FEATURES, GramRegressor, {}, "Nope", "m", [])
    with pytest.raises(ValueError, match="needs a list"):
        search.grid_values({"a": d.uniform(0, 1)})


# ---- exploration and drift ------------------------------------------------------------------


@pytest.mark.parametrize(("low", "high", "step"), [(0, 10, 1), (0, 99, 10), (0, 40, 5), (0, 12, 2), (0.0, 0.1, 0.01), (5, 5, 0.5), (0, 0, 0.1), (-3, 1e6, 200000.0)])
def test_nice_steps(low, high, step):
    assert explore.nice_step(low, high) == pytest.approx(step)


def test_exploration_tables_count_every_row(training):
    n = training.count()
    h = explore.histogram(training, FEATURES)
    assert {r[1] for r in h.groupBy("covariate").agg(F.sum("n")).collect()} == {n}
    dens = explore.point_density(training)
    assert dens.agg(F.sum("n")).first()[0] == n
    assert dens.filter("px < 0 OR px >= 850 OR py < 0 OR py >= 500").count() == 0
    assert explore.scatter(training, FEATURES).count() == n * len(FEATURES)
    twice = training.withColumn("double_tax", F.col("tax") * 2)
    pairs = explore.collinear(explore.correlations(twice, ["tax", "double_tax", "size"])).collect()
    assert [(r["a"], r["b"]) for r in pairs] == [("double_tax", "tax")]


def test_drift_sees_a_shift_and_only_a_shift(training):
    def mean_gap(a, b):
        stacked = drift.two_classes(a.select("key", *FEATURES), b.select("key", *FEATURES)).cache()
        out = drift.measure_drift(stacked, ["quantity", "size"], GaussianBayes(), keep=["key"]).table
        rows = {r[0]: r[1] for r in out.groupBy("actual_class").agg(F.avg("probability_class_1")).collect()}
        return rows[1] - rows[2]

    half = split.flag_holdout(training, "key", 50)
    assert abs(mean_gap(half.filter("is_oos"), half.filter("NOT is_oos"))) < 0.02
    assert mean_gap(training.filter("quantity > 25"), training) > 0.1


@pytest.mark.parametrize("name", ["LogisticRegression", "RandomForestClassifier", "DecisionTreeClassifier", "GaussianNB", "KNeighborsClassifier"])
def test_classifiers_give_probabilities(training, name):
    few = training.limit(300).select("key", "quantity", "size")
    a = few.filter("quantity > 30").withColumn("key", F.concat(F.lit("a"), "key"))
    stacked = drift.two_classes(a, few).cache()
    param = {"n_estimators": 3, "max_depth": 3} if "Forest" in name else None
    out = drift.measure_drift(stacked, ["quantity", "size"], classifier(name, param), keep=["key"]).table
    row = out.agg(F.min("probability_class_1"), F.max("probability_class_1"), F.count(F.lit(1))).first()
    assert 0 <= row[0] and row[1] <= 1 and row[2] == stacked.count()


# ---- the whole workflow ------------------------------------------------------------------------


def test_workflow_end_to_end(spark, sf, tmp_path):
    conf = WorkflowConfig(
        covariates=["price", "parts_1", "parts_2"],
        target=TargetConfig(property="price", group="customer", group_splits=3, percentage_oos=10),
        ranking=RankingConfig("FeatureRankingByGroupCV", "adjusted_r2_scorer", 3, 2),
        search=SearchConfig("GridSearch", {"ridge": [0.0, 0.1]}, 2, 2),
        drift_classifier="LogisticRegression",
        output_folder=str(tmp_path),
    )
    out = run_workflow(spark, raster_inputs(spark, sf), conf)
    for name in (
        "training", "oos", "rejects", "training_histogram", "oos_density", "feature_ranking", "elimination_log", "trials",
        "best_trial", "oos_scores", "cv_predictions", "prediction_map", "drift", "drift_map",
        "trial_models", "drift_points.geojson", "feature_importance",
    ):
        assert (tmp_path / name).exists(), name
    assert len(out.selected_features) == 2 and out.model_path
    train, oos = out.tables["training"], out.tables["oos"]
    n = train.count() + oos.count()
    assert oos.count() == int(n * 0.1)
    assert train.join(oos, "point_id").count() == 0
    assert train.groupBy("groupcv").agg(F.count_distinct("groupcv_class").alias("c")).filter("c > 1").count() == 0
    surface = out.tables["prediction_map"]
    assert surface.count() == 200 and surface.filter("value IS NULL").count() == 0
    # Drift points as a FeatureCollection, read again: every row, in its place.
    points, lost = normalise_points(read_geojson(spark, str(tmp_path / "drift_points.geojson"), one_document=True), "probability_class_1")
    assert lost.count() == 0 and points.count() == out.tables["drift"].count()
    sums = [t.agg(F.sum("x"), F.sum("y")).first() for t in (points, out.tables["drift"])]
    assert list(sums[0]) == pytest.approx(list(sums[1]))
    assert [r["feature"] for r in out.tables["feature_importance"].orderBy("feature").collect()] == sorted(out.selected_features)
    assert out.tables["trial_models"].count() == 2
    ps = out.tables["drift"].agg(F.min("probability_class_1"), F.max("probability_class_1"), F.count_distinct("actual_class")).first()
    assert 0 <= ps[0] and ps[1] <= 1 and ps[2] == 2


def test_config_is_checked():
    for bad in (
        dict(covariates=[]),
        dict(covariates=["a"], model="Nope"),
        dict(covariates=["a"], stages=["nope"]),
        dict(covariates=["a"], drift_classifier="Nope"),
        dict(covariates=["a"], search=SearchConfig(space="all")),
        dict(covariates=["a"], search=SearchConfig(space="declared")),
        dict(covariates=["a"], ranking=RankingConfig(method="Nope")),
        dict(covariates=["a"], ranking=RankingConfig(scoring_function="Nope")),
        dict(covariates=["a"], search=SearchConfig(algorithm="Nope")),
        dict(covariates=["a"], search=SearchConfig(metric="wrong_r2_scorer")),
        dict(covariates=["a"], target=TargetConfig(percentage_oos=101)),
        dict(covariates=["a"], target=TargetConfig(group="g")),
        dict(covariates=["a"], ranking=RankingConfig(method="FeatureRankingByGroupCV")),
    ):
        with pytest.raises(ConfigError):
            WorkflowConfig(**bad)
    assert WorkflowConfig(covariates=["a"]).model == "GramRegressor"


def test_a_model_with_a_declared_space_can_be_searched_by_it():
    conf = WorkflowConfig(covariates=["a"], model="XGBRegressor", search=SearchConfig(space="declared"))
    assert conf.search.space == "declared"
