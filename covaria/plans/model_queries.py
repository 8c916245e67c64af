"""Queries on metrics, linear scores, ranking, exploration, search tables and drift arithmetic."""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions import distributions as d, metrics, objectives
from ..models.classifiers import GaussianBayes
from ..models.ensembles import FittedEnsemble, interval_columns
from ..models.linear import FittedLinear, GramRegressor
from ..models.registry import regressor
from ..operators import drift, explore, hashed_neighbours, neighbours, ranking, scoring, search, shapley, split, standardise as std, tree_shapley
from ..operators.gram import LinearFit, moments
from ..session import cut_lineage, held, shared_folder
from ..sources import sinks
from ..sources.tables import read_geojson
from . import views as v
from .config import RankingConfig
from .registry import query
from .workflow import drift_properties, rank_features

PAIR = ["quantity", "discount"]
SCORERS = list(metrics.SCORERS)
# The setting of the bench: ten rounds of depth five.
_BOOSTER = {"num_boost_round": 10, "max_depth": 5, "learning_rate": 0.3, "subsample": 1.0, "colsample_bylevel": 1.0, "gamma": 0}


def _score_sql(p: str, n_cov: int) -> str:
    """All scorers, rounded to what two engines agree on."""
    mse = f"avg(({p} - target) * ({p} - target))"
    r2 = f"(1 - sum(({p} - target) * ({p} - target)) / (var_pop(target) * count(*)))"
    return (
        f"round(-{mse}, 0) AS mean_squared_error_scorer, round(-avg(abs({p} - target)), 3) AS mean_absolute_error_scorer,"
        f" round({r2}, 8) AS r2_scorer, round(-sqrt({mse}), 3) AS rmse_scorer,"
        f" round(greatest(1 - (1 - {r2}) * (count(*) - 1) / (count(*) - {n_cov} - 1), 0), 8) AS adjusted_r2_scorer"
    )


_DIGITS = dict(zip(SCORERS, (0, 3, 8, 3, 8)))


def _rounded(df: DataFrame, prefix: str = "") -> DataFrame:
    return df.withColumns({prefix + s: F.round(prefix + s, n) for s, n in _DIGITS.items()})


def _fit_sql(a: str, b: str, t: str = "target") -> str:
    """Two-feature least squares in closed form: wa, wb, w0."""
    va, vb, cab = f"var_pop({a})", f"var_pop({b})", f"covar_pop({a}, {b})"
    ca, cb = f"covar_pop({a}, {t})", f"covar_pop({b}, {t})"
    det = f"({va} * {vb} - {cab} * {cab})"
    wa, wb = f"(({ca} * {vb} - {cb} * {cab}) / {det})", f"(({cb} * {va} - {ca} * {cab}) / {det})"
    return f"{wa} AS wa, {wb} AS wb, avg({t}) - {wa} * avg({a}) - {wb} * avg({b}) AS w0"


_NUM = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in ("target", *v.FEATURES, "groupcv"))
_NUMERIC = f"num AS (SELECT key, {_NUM}, x, y FROM clean)"
_CV_SQL = f"""{v.CLEAN_SQL}, {_NUMERIC}, {v.sql_folds('num', 5)},
  fits AS (SELECT f.fold, {_fit_sql('quantity', 'discount')} FROM (SELECT DISTINCT fold FROM folds) f
    JOIN folds t ON t.fold <> f.fold GROUP BY f.fold),
  guess AS (SELECT folds.*, w0 + wa * quantity + wb * discount AS p FROM folds JOIN fits USING (fold))"""


@query("regression_metrics", f"WITH {v.CLEAN_SQL}, {_NUMERIC} SELECT {_score_sql('(quantity * 1300)', 5)} FROM num")
def regression_metrics(spark: SparkSession, sf: str) -> DataFrame:
    guess = v.clean_training(spark, sf).withColumn("prediction", F.col("quantity").cast("double") * 1300)
    return _rounded(metrics.score(guess, SCORERS, 5))


@query(
    "group_metrics",
    f"WITH {v.CLEAN_SQL}, {_NUMERIC} SELECT groupcv, {_score_sql('(quantity * 1300)', 5)} FROM num GROUP BY groupcv",
)
def group_metrics(spark: SparkSession, sf: str) -> DataFrame:
    guess = v.clean_training(spark, sf).withColumn("prediction", F.col("quantity").cast("double") * 1300)
    return _rounded(metrics.score(guess, SCORERS, 5, by=["groupcv"])).withColumn("groupcv", F.col("groupcv").cast("double"))


@query(
    "squared_log_grad_hess",
    """WITH p AS (SELECT l_orderkey, l_discount AS y, l_tax * 30 - 1.33 AS p0 FROM lineitem),
  q AS (SELECT l_orderkey, y, p0, CASE WHEN p0 < -1 THEN -1 + 1e-6 ELSE p0 END AS p FROM p)
  SELECT l_orderkey, round((ln(1 + p) - ln(1 + y)) / (p + 1) / CASE WHEN p0 < -1 THEN 1e7 ELSE 1 END, 8) AS grad,
    round((ln(1 + y) - ln(1 + p) + 1) / pow(p + 1, 2) / CASE WHEN p0 < -1 THEN 1e13 ELSE 1 END, 8) AS hess FROM q""",
)
def squared_log_grad_hess(spark: SparkSession, sf: str) -> DataFrame:
    raw = v.table(spark, sf, "lineitem").select("l_orderkey", F.col("l_discount").alias("y"), (F.col("l_tax") * 30 - 1.33).alias("p"))
    both = raw.select("l_orderkey", "p", objectives.squared_log(F.col("p"), F.col("y")).alias("s"))
    # Lifted predictions give huge values: scaled before rounding.
    low = F.col("p") < -1
    return both.select(
        "l_orderkey",
        F.round(F.col("s.grad") / F.when(low, 1e7).otherwise(1.0), 8).alias("grad"),
        F.round(F.col("s.hess") / F.when(low, 1e13).otherwise(1.0), 8).alias("hess"),
    )


@query("cv_fold_scores_linear", f"WITH {_CV_SQL} SELECT fold, {_score_sql('p', 2)} FROM guess GROUP BY fold")
def cv_fold_scores_linear(spark: SparkSession, sf: str) -> DataFrame:
    folds = split.assign_folds(v.clean_training(spark, sf), "key", 5)
    return _rounded(scoring.fold_scores(folds, PAIR, GramRegressor(), SCORERS))


@query(
    "cv_scores_linear",
    f"WITH {_CV_SQL}, s AS (SELECT fold, -avg((p - target) * (p - target)) AS mse, -avg(abs(p - target)) AS mae,"
    " 1 - sum((p - target) * (p - target)) / (var_pop(target) * count(*)) AS r2, count(*) AS n FROM guess GROUP BY fold)"
    " SELECT round(avg(mse), 0) AS cv_mean_squared_error_scorer, round(avg(mae), 3) AS cv_mean_absolute_error_scorer,"
    " round(avg(r2), 8) AS cv_r2_scorer, round(avg(-sqrt(-mse)), 3) AS cv_rmse_scorer,"
    " round(avg(greatest(1 - (1 - r2) * (n - 1) / (n - 3), 0)), 8) AS cv_adjusted_r2_scorer FROM s",
)
def cv_scores_linear(spark: SparkSession, sf: str) -> DataFrame:
    folds = split.assign_folds(v.clean_training(spark, sf), "key", 5)
    per_fold = scoring.fold_scores(folds, PAIR, GramRegressor(), SCORERS)
    return _rounded(metrics.mean_scores(per_fold, SCORERS, "cv"), "cv_")


@query("cv_predictions", f"WITH {_CV_SQL} SELECT key, target AS actual_labels, round(p, 4) AS predicted_labels FROM guess")
def cv_predictions(spark: SparkSession, sf: str) -> DataFrame:
    folds = split.assign_folds(v.clean_training(spark, sf), "key", 5)
    crossed = scoring.out_of_fold(folds, PAIR, GramRegressor())
    out = scoring.predicted_vs_real(crossed, "actual_labels", "predicted_labels", keep=["key"])
    return out.withColumn("predicted_labels", F.round("predicted_labels", 4))


_OOS_SQL = f"""{v.CLEAN_SQL}, {_NUMERIC}, {v.sql_holdout('num', 10)},
  fit AS (SELECT {_fit_sql('quantity', 'discount')} FROM held WHERE NOT is_oos),
  guess AS (SELECT held.*, w0 + wa * quantity + wb * discount AS p FROM held, fit WHERE is_oos)"""


@query(
    "oos_scores_linear",
    f"WITH {_OOS_SQL}, s AS (SELECT {_score_sql('p', 2)} FROM guess) SELECT "
    + ", ".join(f"{s} AS oos_{s}" for s in SCORERS) + " FROM s",
)
def oos_scores_linear(spark: SparkSession, sf: str) -> DataFrame:
    train, oos = split.holdout(v.clean_training(spark, sf), "key", 10)
    return _rounded(scoring.out_of_sample_scores(train, oos, PAIR, GramRegressor(), SCORERS), "oos_")


@query(
    "score_json",
    f"WITH {_OOS_SQL}, s AS (SELECT {_score_sql('p', 2)} FROM guess) "
    + " UNION ALL ".join(f"SELECT 'oos_{s}' AS score_name, {s} AS score FROM s" for s in SCORERS),
)
def score_json(spark: SparkSession, sf: str) -> DataFrame:
    """Score names and values through a JSON result file."""
    train, oos = split.holdout(v.clean_training(spark, sf), "key", 10)
    row = _rounded(scoring.out_of_sample_scores(train, oos, PAIR, GramRegressor(), SCORERS), "oos_")
    path = f"{shared_folder(spark)}/scores"
    sinks.write_table(metrics.long_scores(row), path, "json")
    return spark.read.schema("score_name string, score double").json(path)


@query("oos_predictions", f"WITH {_OOS_SQL} SELECT key, target AS label_oos, round(p, 4) AS label_pred FROM guess")
def oos_predictions(spark: SparkSession, sf: str) -> DataFrame:
    train, oos = split.holdout(v.clean_training(spark, sf), "key", 10)
    _, predicted = scoring.fit_and_predict(train, oos, PAIR, GramRegressor())
    out = scoring.predicted_vs_real(predicted, keep=["key"])
    return out.withColumn("label_pred", F.round("label_pred", 4))


_GROUP_FOLDS_SQL = f"""{v.CLEAN_SQL}, {_NUMERIC},
  gf AS (SELECT groupcv, CAST((row_number() OVER (ORDER BY {v.sql_order(0, "CAST(CAST(groupcv AS INTEGER) AS VARCHAR) || '.0'")}) - 1) % 5
    AS INTEGER) AS fold FROM (SELECT DISTINCT groupcv FROM num) g),
  folds AS (SELECT num.*, gf.fold FROM num JOIN gf USING (groupcv))"""
_GROUP_CV_SQL = f"""{_GROUP_FOLDS_SQL},
  fits AS (SELECT f.fold, {_fit_sql('quantity', 'discount')} FROM (SELECT DISTINCT fold FROM folds) f
    JOIN folds t ON t.fold <> f.fold GROUP BY f.fold),
  guess AS (SELECT folds.*, w0 + wa * quantity + wb * discount AS p FROM folds JOIN fits USING (fold))"""


@query(
    "groupcv_scores_linear",
    f"WITH {_GROUP_CV_SQL}, s AS (SELECT fold, avg(abs(p - target)) AS mae,"
    " 1 - sum((p - target) * (p - target)) / (var_pop(target) * count(*)) AS r2 FROM guess GROUP BY fold)"
    " SELECT round(-avg(mae), 3) AS groupcv_mean_absolute_error_scorer, round(avg(r2), 8) AS groupcv_r2_scorer FROM s",
)
def groupcv_scores_linear(spark: SparkSession, sf: str) -> DataFrame:
    rows = split.assign_group_folds(v.clean_training(spark, sf), "groupcv", 5)
    names = ["mean_absolute_error_scorer", "r2_scorer"]
    out = scoring.group_scores(rows, PAIR, GramRegressor(), names)
    return out.withColumns({f"groupcv_{n}": F.round(f"groupcv_{n}", _DIGITS[n]) for n in names})


@query(
    "predicted_interleaved",
    "SELECT l_orderkey AS iteration, 'y_pred' AS label, l_quantity * 1300 AS data_point FROM lineitem"
    " UNION ALL SELECT l_orderkey, 'y_oos', l_extendedprice FROM lineitem",
)
def predicted_interleaved(spark: SparkSession, sf: str) -> DataFrame:
    items = v.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("iteration"), (F.col("l_quantity") * 1300).alias("y_pred"), F.col("l_extendedprice").alias("y_oos")
    )
    return metrics.interleave(items)


@query(
    "ensemble_mean",
    "SELECT l_orderkey, l_quantity * 2.0 + 1.0 AS p_0, l_quantity * 3.0 + l_tax * 4.0 AS p_1,"
    " round(((l_quantity * 2.0 + 1.0) + (l_quantity * 3.0 + l_tax * 4.0)) / 2.0, 6) AS p FROM lineitem",
)
def ensemble_mean(spark: SparkSession, sf: str) -> DataFrame:
    names = ["l_quantity", "l_tax"]
    members = [FittedLinear(names, LinearFit(np.array(w), b)) for w, b in (([2.0, 0.0], 1.0), ([3.0, 4.0], 0.0))]
    out = FittedEnsemble(members).transform_all(v.table(spark, sf, "lineitem").select("l_orderkey", *names), "p")
    return out.select("l_orderkey", "p_0", "p_1", F.round("p", 6).alias("p"))


_GAP = NormalDist().inv_cdf(0.95) - NormalDist().inv_cdf(0.05)
_HALF = NormalDist().inv_cdf(0.975)


@query(
    "interval_arithmetic",
    f"SELECT l_orderkey, round(pow((l_quantity * l_tax + 1) / {_GAP!r}, 2), 6) AS variance,"
    f" round(l_quantity - {_HALF!r} * (l_quantity * l_tax + 1) / {_GAP!r}, 6) AS lower,"
    f" round(l_quantity + {_HALF!r} * (l_quantity * l_tax + 1) / {_GAP!r}, 6) AS upper FROM lineitem",
)
def interval_arithmetic(spark: SparkSession, sf: str) -> DataFrame:
    q, t = F.col("l_quantity"), F.col("l_tax")
    cols = interval_columns(q, q - q * t - 1, q)
    out = v.table(spark, sf, "lineitem").select("l_orderkey", *[c.alias(n) for n, c in cols.items()])
    return out.select("l_orderkey", *[F.round(c, 6).alias(c) for c in ("variance", "lower", "upper")])


# ---- exploration ------------------------------------------------------------------------------

_BIN_COLUMNS = ["quantity", "discount", "size", "retailprice"]


def _histogram_sql(c: str) -> str:
    span = f"(SELECT CASE WHEN max({c}) > min({c}) THEN max({c}) - min({c}) WHEN min({c}) <> 0 THEN abs(min({c})) ELSE 1 END FROM num)"
    step = (
        "(SELECT min(CAST(digit || 'e' || power AS DOUBLE)) FROM (SELECT unnest([1, 2, 5]) AS digit) a,"
        f" (SELECT unnest(range(-12, 16)) AS power) b WHERE {span} / CAST(digit || 'e' || power AS DOUBLE) <= 10)"
    )
    return (
        f"SELECT '{c}' AS covariate, CAST(floor({c} / s) AS BIGINT) * s AS bin_start, (CAST(floor({c} / s) AS BIGINT) + 1) * s AS bin_end,"
        f" count(*) AS n FROM num, (SELECT {step} AS s) st GROUP BY ALL"
    )


@query("histogram", f"WITH {v.CLEAN_SQL}, {_NUMERIC} " + " UNION ALL ".join(_histogram_sql(c) for c in _BIN_COLUMNS))
def histogram(spark: SparkSession, sf: str) -> DataFrame:
    return explore.histogram(v.clean_training(spark, sf), _BIN_COLUMNS)


@query(
    "point_density",
    f"""WITH {v.CLEAN_SQL}, e AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM clean),
    px AS (SELECT CAST(least(floor((x - x0) / (x1 - x0) * 850), 849) AS INTEGER) AS px,
      CAST(least(floor((y - y0) / (y1 - y0) * 500), 499) AS INTEGER) AS py FROM clean, e)
    SELECT px, py, count(*) AS n, round(ln(1 + count(*)), 8) AS shade FROM px GROUP BY px, py""",
)
def point_density(spark: SparkSession, sf: str) -> DataFrame:
    return explore.point_density(v.clean_training(spark, sf)).withColumn("shade", F.round("shade", 8))


@query(
    "target_scatter",
    f"WITH {v.CLEAN_SQL}, {_NUMERIC} "
    + " UNION ALL ".join(f"SELECT '{c}' AS covariate, {c} AS value, target, x, y FROM num" for c in v.FEATURES),
)
def target_scatter(spark: SparkSession, sf: str) -> DataFrame:
    out = explore.scatter(v.clean_training(spark, sf), v.FEATURES)
    return out.withColumn("target", F.col("target").cast("double"))


_CORR = ["target", *v.FEATURES]


@query(
    "correlation_matrix",
    f"WITH {v.CLEAN_SQL}, {_NUMERIC} "
    + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 8) AS r FROM num" for a in _CORR for b in _CORR),
)
def correlation_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return explore.correlations(v.clean_training(spark, sf), _CORR).withColumn("r", F.round("r", 8))


@query(
    "standardize",
    f"WITH {v.CLEAN_SQL}, {_NUMERIC}, s AS (SELECT avg(quantity) AS mq, stddev_pop(quantity) AS sq, avg(retailprice) AS mr,"
    " stddev_pop(retailprice) AS sr FROM num) SELECT key, round((quantity - mq) / sq, 7) AS quantity,"
    " round((retailprice - mr) / sr, 7) AS retailprice FROM num, s",
)
def standardize(spark: SparkSession, sf: str) -> DataFrame:
    out = std.standardise(v.clean_training(spark, sf), ["quantity", "retailprice"])
    return out.select("key", F.round("quantity", 7).alias("quantity"), F.round("retailprice", 7).alias("retailprice"))


# ---- ranking -------------------------------------------------------------------------------------


@query(
    "elimination_log_linear",
    f"""WITH {v.CLEAN_SQL}, {_NUMERIC}, {v.sql_folds('num', 5)},
    one AS (SELECT f.fold, regr_slope(target, quantity) AS aq, regr_intercept(target, quantity) AS bq,
      regr_slope(target, retailprice) AS ap, regr_intercept(target, retailprice) AS bp
      FROM (SELECT DISTINCT fold FROM folds) f JOIN folds t ON t.fold <> f.fold GROUP BY f.fold),
    s AS (SELECT fold, 1 - sum(pow(aq * quantity + bq - target, 2)) / (var_pop(target) * count(*)) AS only_quantity,
      1 - sum(pow(ap * retailprice + bp - target, 2)) / (var_pop(target) * count(*)) AS only_price
      FROM folds JOIN one USING (fold) GROUP BY fold),
    m AS (SELECT avg(only_quantity) AS q, avg(only_price) AS p FROM s)
    SELECT 0 AS iteration, 0 AS position, 'retailprice' AS feature, round(q, 8) AS score FROM m
    UNION ALL SELECT 0, 1, 'quantity', round(p, 8) FROM m
    UNION ALL SELECT 1, 0, CASE WHEN q >= p THEN 'quantity' ELSE 'retailprice' END, 0.0 FROM m""",
)
def elimination_log_linear(spark: SparkSession, sf: str) -> DataFrame:
    folds = split.assign_folds(v.clean_training(spark, sf), "key", 5)
    log = ranking.cv_elimination(folds, ["retailprice", "quantity"], GramRegressor(), "r2_scorer")
    return log.withColumn("score", F.round("score", 8))


@query(
    "oos_elimination_log_linear",
    f"""WITH {v.CLEAN_SQL}, {_NUMERIC}, {v.sql_holdout('num', 10)},
    fit AS (SELECT regr_slope(target, quantity) AS aq, regr_intercept(target, quantity) AS bq,
      regr_slope(target, retailprice) AS ap, regr_intercept(target, retailprice) AS bp FROM held WHERE NOT is_oos),
    m AS (SELECT -avg(abs(aq * quantity + bq - target)) AS q, -avg(abs(ap * retailprice + bp - target)) AS p FROM held, fit WHERE is_oos)
    SELECT 0 AS iteration, 0 AS position, 'retailprice' AS feature, round(q, 4) AS score FROM m
    UNION ALL SELECT 0, 1, 'quantity', round(p, 4) FROM m
    UNION ALL SELECT 1, 0, CASE WHEN q >= p THEN 'quantity' ELSE 'retailprice' END, round(greatest(q, p), 4) FROM m""",
)
def oos_elimination_log_linear(spark: SparkSession, sf: str) -> DataFrame:
    train, oos = split.holdout(v.clean_training(spark, sf), "key", 10)
    log = ranking.oos_elimination(train, oos, ["retailprice", "quantity"], GramRegressor(), "mean_absolute_error_scorer")
    return log.withColumn("score", F.round("score", 4))


_THREE = ("quantity", "discount", "retailprice")


def _elimination_sql(head: str, train: str, test: str, measure: str, digits: int, score_last: bool) -> str:
    """Elimination of three features, every step in closed form.

    `train` is the FROM clause of the fits, by f.fold; `test` that of the rows
    to score, with a fold; `measure` is a score of {p} with {k} features.
    """
    pairs = [(b, c) for a in _THREE for b, c in [[f for f in _THREE if f != a]]]
    fits, guesses, scores = [], [], []
    for i, (b, c) in enumerate(pairs):
        fit = _fit_sql(b, c)
        for name in ("wa", "wb", "w0"):
            fit = fit.replace(f" AS {name}", f" AS {name}_{i}")
        fits.append(fit)
        guesses.append(f"w0_{i} + wa_{i} * {b} + wb_{i} * {c} AS without_{i}")
    for i, f in enumerate(_THREE):
        fits.append(f"regr_slope(target, {f}) AS s_{i}, regr_intercept(target, {f}) AS i_{i}")
        guesses.append(f"i_{i} + s_{i} * {f} AS only_{i}")
    for i in range(3):
        scores += [f"{measure.format(p=f'without_{i}', k=2)} AS without_{i}", f"{measure.format(p=f'only_{i}', k=1)} AS only_{i}"]
    names = ", ".join(f"avg({kind}_{i}) AS {kind}_{i}" for kind in ("without", "only") for i in range(3))

    def rows(kind: str) -> str:
        return " UNION ALL ".join(f"SELECT {i} AS place, '{f}' AS feature, {kind}_{i} AS score FROM m" for i, f in enumerate(_THREE))

    return f"""{head}, fits AS (SELECT f.fold, {', '.join(fits)} FROM {train} GROUP BY f.fold),
    guess AS (SELECT t.fold, target, {', '.join(guesses)} FROM {test} t JOIN fits USING (fold)),
    s AS (SELECT fold, {', '.join(scores)} FROM guess GROUP BY fold), m AS (SELECT {names} FROM s),
    without AS ({rows('without')}), alone AS ({rows('only')}),
    first AS (SELECT * FROM without ORDER BY score DESC, place LIMIT 1),
    second AS (SELECT gone.place, gone.feature, kept.score, kept.feature AS kept FROM alone gone JOIN alone kept ON gone.place <> kept.place
      WHERE gone.place NOT IN (SELECT place FROM first) AND kept.place NOT IN (SELECT place FROM first) ORDER BY kept.score DESC, gone.place LIMIT 1)
    SELECT feature, 0 AS rank, round(score, {digits}) AS score FROM first
    UNION ALL SELECT feature, 1, round(score, {digits}) FROM second
    UNION ALL SELECT kept, 2, {f'round(score, {digits})' if score_last else '0.0'} FROM second"""


_R2_SQL = "(1 - sum(pow({p} - target, 2)) / (var_pop(target) * count(*)))"
_LEFT_OUT = "(SELECT DISTINCT fold FROM folds) f JOIN folds t ON t.fold <> f.fold"


@query(
    "cv_elimination_three",
    _elimination_sql(f"WITH {v.CLEAN_SQL}, {_NUMERIC}, {v.sql_folds('num', 5)}", _LEFT_OUT, "folds", "-avg(abs({p} - target))", 4, False),
)
def cv_elimination_three(spark: SparkSession, sf: str) -> DataFrame:
    """The ranking stage over folds, by a score that sums of products cannot give."""
    conf = RankingConfig("FeatureRankingByEliminationCV", "mean_absolute_error_scorer", 5)
    table = rank_features(v.clean_training(spark, sf), conf, GramRegressor(), features=_THREE)[0]
    return table.withColumn("score", F.round("score", 4))


@query(
    "group_elimination_three",
    _elimination_sql(
        f"WITH {_GROUP_FOLDS_SQL}", _LEFT_OUT, "folds",
        f"greatest(1 - (1 - {_R2_SQL}) * (count(*) - 1) / (count(*) - {{k}} - 1), 0)", 8, False,
    ),
)
def group_elimination_three(spark: SparkSession, sf: str) -> DataFrame:
    """The ranking stage over folds of groups."""
    rows = split.assign_group_folds(v.clean_training(spark, sf), "groupcv", 5)
    conf = RankingConfig("FeatureRankingByGroupCV", "adjusted_r2_scorer", 5)
    return rank_features(rows, conf, GramRegressor(), features=_THREE)[0].withColumn("score", F.round("score", 8))


@query(
    "oos_elimination_three",
    _elimination_sql(
        f"WITH {v.CLEAN_SQL}, {_NUMERIC}, {v.sql_holdout('num', 10)}, f AS (SELECT 0 AS fold, * FROM held WHERE NOT is_oos),"
        " scored AS (SELECT 0 AS fold, * FROM held WHERE is_oos)", "f", "scored", "-sqrt(avg(pow({p} - target, 2)))", 3, True,
    ),
)
def oos_elimination_three(spark: SparkSession, sf: str) -> DataFrame:
    """The ranking stage on held-out rows."""
    train, oos = split.holdout(v.clean_training(spark, sf), "key", 10)
    conf = RankingConfig("FeatureRankingByEliminationOOS", "rmse_scorer")
    return rank_features(train, conf, GramRegressor(), oos, features=_THREE)[0].withColumn("score", F.round("score", 3))


# Columns of a wide table, more than one block of cross products, as (multiplier, modulus).
_WIDE = [(k * 7919 + 11, 61 + 2 * (k % 13)) for k in range(70)]
_WIDE_PAIRS = [(i, j) for i in range(70) for j in range(i, 70, 9)]


@query(
    "wide_cross_products",
    "WITH w AS (SELECT " + ", ".join(f"CAST((l_orderkey * {m} + l_linenumber * {k}) % {d} AS DOUBLE) AS c{k}" for k, (m, d) in enumerate(_WIDE))
    + " FROM lineitem), s AS (SELECT [" + ", ".join(f"covar_pop(c{i}, c{j})" for i, j in _WIDE_PAIRS) + "] AS v FROM w)"
    + f" SELECT unnest({[i for i, _ in _WIDE_PAIRS]}) AS a, unnest({[j for _, j in _WIDE_PAIRS]}) AS b,"
    + " round(unnest(v), 4) AS covariance FROM s",
)
def wide_cross_products(spark: SparkSession, sf: str) -> DataFrame:
    """Cross products of 70 columns, merged block by block."""
    items = v.table(spark, sf, "lineitem")
    wide = items.select(*[
        ((F.col("l_orderkey") * m + F.col("l_linenumber") * k) % d).cast("double").alias(f"c{k}") for k, (m, d) in enumerate(_WIDE)
    ])
    found = moments(wide, wide.columns[:-1], wide.columns[-1])[0]
    rows = [(i, j, float(found.cross[i, j] / found.n)) for i, j in _WIDE_PAIRS]
    return spark.createDataFrame(rows, "a int, b int, covariance double").withColumn("covariance", F.round("covariance", 4))


_LOG_SQL = "SELECT c_nationkey AS iteration, c_custkey AS position, c_name AS feature, floor(c_acctbal / 500) AS score FROM customer"


def _customer_log(spark: SparkSession, sf: str) -> DataFrame:
    return v.table(spark, sf, "customer").select(
        F.col("c_nationkey").alias("iteration"), F.col("c_custkey").alias("position"), F.col("c_name").alias("feature"),
        F.floor(F.col("c_acctbal") / 500).cast("double").alias("score"),
    )


@query(
    "eliminated_features",
    f"WITH log AS ({_LOG_SQL}), r AS (SELECT *, row_number() OVER (PARTITION BY iteration ORDER BY score DESC, position) AS n FROM log)"
    " SELECT feature, iteration AS rank, CAST(score AS DOUBLE) AS score FROM r WHERE n = 1",
)
def eliminated_features(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.eliminated(_customer_log(spark, sf))


@query("best_feature", f"WITH log AS ({_LOG_SQL}) SELECT feature FROM log ORDER BY score DESC, position LIMIT 1")
def best_feature(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.arg_max(_customer_log(spark, sf))


@query(
    "selected_features",
    "WITH f AS (SELECT p_type AS feature, row_number() OVER (ORDER BY avg(p_retailprice), p_type) AS r, count(*) OVER () AS n"
    " FROM part GROUP BY p_type) SELECT feature, r > n - 2 AS last_two, r <= 2 AS first_two FROM f WHERE r > n - 2 OR r <= 2",
)
def selected_features(spark: SparkSession, sf: str) -> DataFrame:
    """Elimination keeps the last k, Shapley ranking the first k."""
    prices = v.table(spark, sf, "part").groupBy(F.col("p_type").alias("feature")).agg(F.avg("p_retailprice").alias("m"))
    table = prices.withColumn("rank", F.row_number().over(Window.orderBy("m", "feature")) - 1)
    last, first = ranking.select_features(table, "elimination", 2), ranking.select_features(table, "shap", 2)
    flags = table.select("feature", F.col("feature").isin(last).alias("last_two"), F.col("feature").isin(first).alias("first_two"))
    return flags.filter("last_two OR first_two")


@query(
    "ranked_report",
    """WITH b AS (SELECT p_brand AS feature, round(avg(p_retailprice), 4) AS score FROM part GROUP BY p_brand),
    e AS (SELECT feature, score, row_number() OVER (ORDER BY score, feature) - 1 AS iteration FROM b WHERE feature NOT IN ('Brand#1', 'Brand#2')),
    last AS (SELECT max(iteration) AS i, arg_max(score, iteration) AS s FROM e),
    k AS (SELECT feature, row_number() OVER (ORDER BY feature) AS t FROM b WHERE feature IN ('Brand#1', 'Brand#2')),
    c AS (SELECT count(*) AS c FROM k)
    SELECT CAST(iteration - c AS INTEGER) AS Rank, feature AS Feature, round(score, 6) AS Score, CAST(iteration AS INTEGER) AS Iteration FROM e, c
    UNION ALL SELECT CAST(i - c AS INTEGER), feature, round(s + t * 0.01, 6), CAST(i AS INTEGER) FROM k, last, c""",
)
def ranked_report(spark: SparkSession, sf: str) -> DataFrame:
    brands = v.table(spark, sf, "part").groupBy(F.col("p_brand").alias("feature")).agg(F.round(F.avg("p_retailprice"), 4).alias("score"))
    gone = brands.filter(~F.col("feature").isin("Brand#1", "Brand#2"))
    gone = gone.withColumn("iteration", F.row_number().over(Window.orderBy("score", "feature")) - 1)
    everyone = brands.select("feature", F.row_number().over(Window.orderBy("feature")).alias("position"))
    return ranking.ranked_report(gone, everyone).withColumn("Score", F.round("Score", 6))


@query(
    "random_ranking",
    f"WITH f AS (SELECT p_name AS feature, row_number() OVER (ORDER BY p_name) - 1 AS i, count(*) OVER () AS n"
    f" FROM (SELECT DISTINCT p_name FROM part) d), r AS (SELECT *, row_number() OVER (ORDER BY {v.sql_order(5, 'feature')}) AS o FROM f)"
    " SELECT feature, CAST(n - i AS INTEGER) AS rank, i / 10.0 AS score FROM r WHERE o <= 7",
)
def random_ranking(spark: SparkSession, sf: str) -> DataFrame:
    names = v.table(spark, sf, "part").select("p_name").distinct().orderBy("p_name")
    return ranking.random_ranking(spark, [r[0] for r in names.collect()], 7, 5)  # distinct names


@query(
    "shap_linear_importance",
    f"""WITH {_OOS_SQL}, m AS (SELECT avg(quantity) AS mq, avg(discount) AS md FROM held WHERE is_oos),
    s AS (SELECT avg(abs(wa * (quantity - mq))) AS sq, avg(abs(wb * (discount - md))) AS sd FROM held, fit, m WHERE is_oos),
    l AS (SELECT 'quantity' AS feature, sq AS score FROM s UNION ALL SELECT 'discount', sd FROM s)
    SELECT feature, CAST(row_number() OVER (ORDER BY score DESC) - 1 AS INTEGER) AS rank, round(score, 4) AS score FROM l""",
)
def shap_linear_importance(spark: SparkSession, sf: str) -> DataFrame:
    train, oos = split.holdout(v.clean_training(spark, sf), "key", 10)
    fitted = GramRegressor().fit(train, PAIR)
    return shapley.importance(shapley.linear_values(fitted, oos), PAIR).withColumn("score", F.round("score", 4))


# ---- search tables ---------------------------------------------------------------------------------

_SPACE = {
    "a": d.uniform(3, 15),
    "b": d.quniform(0.25, 0.75, 0.01),
    "c": d.loguniform(100, 10000),
    "d": d.qloguniform(1, 100, 5),
    "e": d.choice([1, 2, 3, 4, 5, 6]),
    "f": d.randint(1, 10),
    "g": d.qrandint(0, 100, 10),
    "h": d.lograndint(1, 1000),
    "i": d.qlograndint(1, 1000, 10),
    "j": d.randn(2.0, 3.0),
    "k": d.qrandn(0.0, 5.0, 0.5),
    "l": d.sample_from(lambda u: u * u),
}


def _u(name: str, second: bool = False) -> str:
    return v.sql_uniform(f"0:{name}:2" if second else f"0:{name}", "o_orderkey")


def _log_sql(name: str, low: float, high: float) -> str:
    import math

    a, b = math.log(low), math.log(high)
    return f"exp({a!r} + {b - a!r} * {_u(name)})"


def _normal_sql(name: str, mean: float, sd: float) -> str:
    return f"({mean} + {sd} * sqrt(-2.0 * ln(1.0 - {_u(name)})) * cos(2 * pi() * {_u(name, True)}))"


@query(
    "trial_space",
    f"""SELECT o_orderkey AS trial_id, 3.0 + 12.0 * {_u('a')} AS a, round(round_even((0.25 + 0.5 * {_u('b')}) / 0.01, 0) * 0.01, 6) AS b,
    round({_log_sql('c', 100, 10000)}, 6) AS c, round_even({_log_sql('d', 1, 100)} / 5, 0) * 5 AS d,
    CAST(floor({_u('e')} * 6) AS INTEGER) + 1 AS e, CAST(1 + floor({_u('f')} * 9) AS BIGINT) AS f,
    CAST(round_even(floor({_u('g')} * 101) / 10, 0) * 10 AS BIGINT) AS g, CAST(floor({_log_sql('h', 1, 1000)}) AS BIGINT) AS h,
    CAST(round_even(floor({_log_sql('i', 1, 1000)}) / 10, 0) * 10 AS BIGINT) AS i, round({_normal_sql('j', 2.0, 3.0)}, 6) AS j,
    round_even({_normal_sql('k', 0.0, 5.0)} / 0.5, 0) * 0.5 AS k, {_u('l')} * {_u('l')} AS l FROM orders""",
)
def trial_space(spark: SparkSession, sf: str) -> DataFrame:
    """One trial per order number, every distribution once."""
    ids = v.table(spark, sf, "orders").select(F.col("o_orderkey").alias("trial_id"))
    out = search.draw_trials(ids, _SPACE)
    return out.withColumns({c: F.round(c, 6) for c in ("b", "c", "j")})


_TRIAL_SQL = "trials AS (SELECT o_orderkey AS trial_id, floor(o_totalprice / 5000) AS s FROM orders)"


def _order_trials(spark: SparkSession, sf: str) -> DataFrame:
    return v.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("trial_id"),
        F.create_map(F.lit("price"), F.col("o_totalprice").cast("string")).alias("params"),
        F.create_map(
            F.lit("oos_r2_scorer"), F.floor(F.col("o_totalprice") / 5000).cast("double"),
            F.lit("time_total"), F.lit(1.0),
            F.lit("cv_rmse_scorer"), -F.col("o_totalprice"),
        ).alias("scores"),
    )


@query("best_trial", f"WITH {_TRIAL_SQL} SELECT trial_id, CAST(s AS DOUBLE) AS score FROM trials ORDER BY s DESC, trial_id LIMIT 1")
def best_trial(spark: SparkSession, sf: str) -> DataFrame:
    best = search.best_trial(_order_trials(spark, sf), "oos_r2_scorer")
    return best.select("trial_id", F.col("scores")["oos_r2_scorer"].alias("score"))


@query(
    "best_trial_with_gaps",
    f"WITH {_TRIAL_SQL} SELECT trial_id, CAST(s AS DOUBLE) AS score FROM trials WHERE trial_id % 3 <> 0 AND trial_id % 5 <> 0 ORDER BY s DESC, trial_id LIMIT 1",
)
def best_trial_with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Null and NaN scores never win."""
    value = F.col("scores")["oos_r2_scorer"]
    gaps = F.when(F.col("trial_id") % 3 == 0, F.lit(None).cast("double")).when(F.col("trial_id") % 5 == 0, F.lit(float("nan"))).otherwise(value)
    best = search.best_trial(_order_trials(spark, sf).withColumn("scores", F.create_map(F.lit("oos_r2_scorer"), gaps)), "oos_r2_scorer")
    return best.select("trial_id", F.col("scores")["oos_r2_scorer"].alias("score"))


@query(
    "trial_score_filter",
    "SELECT o_orderkey AS trial_id, 'cv_rmse_scorer' AS name, -o_totalprice AS score FROM orders UNION ALL"
    " SELECT o_orderkey, 'oos_r2_scorer', CAST(floor(o_totalprice / 5000) AS DOUBLE) FROM orders",
)
def trial_score_filter(spark: SparkSession, sf: str) -> DataFrame:
    kept = metrics.keep_known_scores(F.col("scores"), SCORERS)
    return _order_trials(spark, sf).select("trial_id", F.explode(kept).alias("name", "score"))


# Two yes-or-no features: a tree of depth two has the mean of each of the four cells as its leaves.
_CELLS_SQL = f"""{v.CLEAN_SQL}, {_NUMERIC},
    two AS (SELECT key, target, CASE WHEN quantity > 25 THEN 1 ELSE 0 END AS a, CASE WHEN discount > 0.045 THEN 1 ELSE 0 END AS b FROM num),
    cell AS (SELECT a, b, avg(target) AS f, count(*) AS n FROM two GROUP BY a, b),
    pa AS (SELECT a, sum(n) / (SELECT sum(n) FROM cell) AS p FROM cell GROUP BY a),
    pb AS (SELECT b, sum(n) / (SELECT sum(n) FROM cell) AS p FROM cell GROUP BY b),
    va AS (SELECT a, sum(p * f) AS v FROM cell JOIN pb USING (b) GROUP BY a),
    vb AS (SELECT b, sum(p * f) AS v FROM cell JOIN pa USING (a) GROUP BY b),
    none AS (SELECT sum(n * f) / sum(n) AS v FROM cell)"""


@query(
    "shap_trees",
    f"""WITH {_CELLS_SQL} SELECT key, round((va.v - none.v + f - vb.v) / 2, 3) AS large, round((vb.v - none.v + f - va.v) / 2, 3) AS cheap
    FROM two JOIN cell USING (a, b) JOIN va USING (a) JOIN vb USING (b), none""",
)
def shap_trees(spark: SparkSession, sf: str) -> DataFrame:
    """Exact values of every row for a tree of depth two, with all rows as background."""
    rows = v.clean_training(spark, sf).select(
        "key", "target", (F.col("quantity") > 25).cast("double").alias("large"), (F.col("discount") > 0.045).cast("double").alias("cheap")
    )
    model = regressor("DecisionTreeRegressor", {"max_depth": 2}).fit(rows, ["large", "cheap"])
    return tree_shapley.tree_values(model, rows).select("key", F.round("large", 3).alias("large"), F.round("cheap", 3).alias("cheap"))


@query(
    "shap_booster",
    f"WITH {v.CLEAN_SQL}, num AS (SELECT key, CAST(target AS DOUBLE) AS target FROM clean), {v.sql_holdout('num', 10)}"
    " SELECT count(*) AS n_rows, count(DISTINCT key) AS n_keys, true AS adds_up, true AS complete FROM held WHERE is_oos",
)
def shap_booster(spark: SparkSession, sf: str) -> DataFrame:
    """Boosted trees: the values of each held-out row add up to its prediction minus the mean prediction."""
    # Joined once, for the fit reads its rows several times and the values are of few of them.
    train, oos = split.stored_holdout(v.clean_training(spark, sf).select("key", *v.FEATURES, "target"), "key", 10)
    model = regressor("XGBRegressor", _BOOSTER).fit(train, v.FEATURES)
    with held(oos) as oos:
        values = tree_shapley.tree_values(model, oos)
        mean = model.transform(oos).agg(F.avg("prediction")).first()[0]
        whole = sum((F.col(f) for f in v.FEATURES), F.lit(0.0))
        both = values.select("key", whole.alias("whole")).join(model.transform(oos).select("key", "prediction"), "key")
        found = both.agg(
            F.count(F.lit(1)).alias("n_rows"), F.countDistinct("key").alias("n_keys"),
            (F.max(F.abs(F.col("prediction") - F.lit(mean) - F.col("whole"))) < 1e-4).alias("adds_up"),
            (F.count("whole") == F.count(F.lit(1))).alias("complete"),
        ).first()
    return spark.createDataFrame([found], "n_rows long, n_keys long, adds_up boolean, complete boolean")


# ---- neighbours and drift --------------------------------------------------------------------------


def _vectors(spark: SparkSession, sf: str) -> tuple[DataFrame, list[str]]:
    names = [f"e{i}" for i in range(64)]
    cols = [F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)]
    return v.table(spark, sf, "embeddings").select("vec_id", "label", *cols), names


_KNN_SQL = """pairs AS (SELECT a.vec_id AS query, b.vec_id AS neighbour, b.label, row_number() OVER (PARTITION BY a.vec_id
    ORDER BY list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), b.vec_id) AS r
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)"""


@query("knn_exact", f"WITH {_KNN_SQL} SELECT query, neighbour, CAST(r - 1 AS INTEGER) AS position FROM pairs WHERE r <= 5")
def knn_exact(spark: SparkSession, sf: str) -> DataFrame:
    rows, names = _vectors(spark, sf)
    out = neighbours.nearest(rows, rows, names, 5, "vec_id", "vec_id", skip_self=True)
    return out.select("query", "neighbour", "position")


@query(
    "knn_vote",
    f"WITH {_KNN_SQL}, c AS (SELECT query, label, count(*) AS n FROM pairs WHERE r <= 5 GROUP BY query, label)"
    " SELECT query, arg_max(label, n * 1000 - label) AS prediction, max(n) / sum(n) AS share FROM c GROUP BY query",
)
def knn_vote(spark: SparkSession, sf: str) -> DataFrame:
    rows, names = _vectors(spark, sf)
    pairs = neighbours.nearest(rows, rows, names, 5, "vec_id", "vec_id", skip_self=True)
    return neighbours.neighbour_vote(pairs, rows, "vec_id", "label")


@query(
    "knn_mean",
    f"WITH {_KNN_SQL} SELECT query, avg(label) AS prediction FROM pairs WHERE r <= 5 GROUP BY query",
)
def knn_mean(spark: SparkSession, sf: str) -> DataFrame:
    """Neighbours by the partitioned way that large references take."""
    rows, names = _vectors(spark, sf)
    pairs = neighbours.nearest(
        rows, rows, names, 5, "vec_id", "vec_id", skip_self=True, shipped_values=0, pivots=16, block_rows=200
    )
    return neighbours.neighbour_mean(pairs, rows, "vec_id", "label")


@query(
    "knn_hashed",
    """WITH pairs AS (SELECT a.vec_id AS query, row_number() OVER (PARTITION BY a.vec_id ORDER BY
        list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), b.vec_id) AS r
      FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0)
    SELECT count(*) AS n_pairs, count(DISTINCT query) AS n_queries, true AS recall_reached FROM pairs WHERE r <= 5""",
)
def knn_hashed(spark: SparkSession, sf: str) -> DataFrame:
    """Approximate neighbours of every twentieth row among all rows, with the recall against the exact ones."""
    rows, names = _vectors(spark, sf)
    asked = rows.filter("vec_id % 20 = 0")
    planes = hashed_neighbours.fit_planes(rows, names, tables=8, cell_rows=64, key="vec_id")
    visits = hashed_neighbours.visits_for(asked, rows, names, 5, planes, 0.96, "vec_id", "vec_id", skip_self=True)
    found = hashed_neighbours.nearest_hashed(asked, rows, names, 5, planes, visits, "vec_id", "vec_id", skip_self=True)
    exact = neighbours.nearest(asked, rows, names, 5, "vec_id", "vec_id", skip_self=True)
    hits = exact.select("query", "neighbour", F.lit(1).alias("hit"))
    return found.join(hits, ["query", "neighbour"], "left").agg(
        F.count(F.lit(1)).alias("n_pairs"), F.countDistinct("query").alias("n_queries"),
        (F.coalesce(F.sum("hit"), F.lit(0)) >= 0.9 * F.count(F.lit(1))).alias("recall_reached"),
    )


def shifted_classes(spark: SparkSession, sf: str) -> DataFrame:
    """Class 1: rows with large quantities.  Class 2: all rows."""
    rows = v.clean_training(spark, sf).select("key", *v.FEATURES)
    known = rows.filter("quantity > 25").withColumn("key", F.concat(F.lit("1/"), "key"))
    return drift.two_classes(known, rows.withColumn("key", F.concat(F.lit("2/"), "key")))


def _density_sql(c: str) -> str:
    return f"(ln(p{c}) - 0.5 * (ln(2 * pi() * (vq{c} + eps)) + ln(2 * pi() * (vs{c} + eps))) - pow(zq - mq{c}, 2) / (2 * (vq{c} + eps)) - pow(zs - ms{c}, 2) / (2 * (vs{c} + eps)))"


_DRIFT_SQL = f"""WITH {v.CLEAN_SQL}, {_NUMERIC},
    st AS MATERIALIZED (SELECT '1/' || key AS key, quantity, size, 1 AS c FROM num WHERE quantity > 25
      UNION ALL SELECT '2/' || key, quantity, size, 2 FROM num),
    m AS MATERIALIZED (SELECT avg(quantity) AS mq, stddev_pop(quantity) AS sq, avg(size) AS ms, stddev_pop(size) AS ss FROM st),
    z AS MATERIALIZED (SELECT key, c, (quantity - (SELECT mq FROM m)) / (SELECT sq FROM m) AS zq, (size - (SELECT ms FROM m)) / (SELECT ss FROM m) AS zs FROM st),
    g AS MATERIALIZED (SELECT count(*) FILTER (c = 1) / count(*) AS p1, count(*) FILTER (c = 2) / count(*) AS p2,
      avg(zq) FILTER (c = 1) AS mq1, avg(zq) FILTER (c = 2) AS mq2, avg(zs) FILTER (c = 1) AS ms1, avg(zs) FILTER (c = 2) AS ms2,
      var_pop(zq) FILTER (c = 1) AS vq1, var_pop(zq) FILTER (c = 2) AS vq2, var_pop(zs) FILTER (c = 1) AS vs1,
      var_pop(zs) FILTER (c = 2) AS vs2, 1e-9 * greatest(var_pop(zq), var_pop(zs)) AS eps FROM z),
    d AS (SELECT *, {", ".join(f"(SELECT {n} FROM g) AS {n}" for n in "p1 p2 mq1 mq2 ms1 ms2 vq1 vq2 vs1 vs2 eps".split())} FROM z)
    SELECT key, c AS actual_class, round(1 / (1 + exp({_density_sql('2')} - {_density_sql('1')})), 7) AS probability_class_1 FROM d"""


@query("gaussian_nb_drift", _DRIFT_SQL)
def gaussian_nb_drift(spark: SparkSession, sf: str) -> DataFrame:
    out = drift.measure_drift(shifted_classes(spark, sf), ["quantity", "size"], GaussianBayes(), keep=["key"]).table
    return out.select("key", "actual_class", F.round("probability_class_1", 7).alias("probability_class_1"))


@query(
    "drift_points",
    f"""WITH {v.CLEAN_SQL}, drift AS ({_DRIFT_SQL}) SELECT d.key, CAST(d.actual_class AS VARCHAR) AS actual_class, d.probability_class_1,
    CAST(c.x AS DOUBLE) AS x, CAST(c.y AS DOUBLE) AS y FROM drift d JOIN clean c ON c.key = substr(d.key, 3)""",
)
def drift_points(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of a drift table, written as one FeatureCollection and read again in splits."""
    # Read by every pass over the drift table, each of which needs few of the columns.
    rows = cut_lineage(v.clean_training(spark, sf).select("key", "x", "y", "quantity", "size"))
    known = rows.filter("quantity > 25").withColumn("key", F.concat(F.lit("1/"), "key"))
    stacked = drift.two_classes(known, rows.withColumn("key", F.concat(F.lit("2/"), "key")))
    names = ["quantity", "size"]
    table = drift.measure_drift(stacked, names, GaussianBayes(), keep=["key", "x", "y"]).table
    path = f"{shared_folder(spark)}/drift"
    # Text of numbers and names is about a tenth when packed.
    sinks.write_geojson_collection(table, path, drift_properties(names), "key", compression="gzip")
    # The files of the folder are one document.
    read = read_geojson(spark, path, one_document=True).select("feature.*")
    return read.select(
        F.col("properties")["key"].alias("key"), F.col("properties")["actual_class"].alias("actual_class"),
        F.round(F.col("properties")["probability_class_1"].cast("double"), 7).alias("probability_class_1"),
        F.from_json("geometry.coordinates", "array<double>")[0].alias("x"), F.from_json("geometry.coordinates", "array<double>")[1].alias("y"),
    )


_RIDGES = [0.0, 0.1, 10.0]


@query(
    "trial_models",
    f"WITH {v.CLEAN_SQL}, num AS (SELECT key, CAST(target AS DOUBLE) AS target FROM clean), {v.sql_holdout('num', 10)}"
    " SELECT i AS trial_id, (SELECT count(*) FROM held WHERE is_oos) AS n_rows, true AS same_score FROM range(3) t(i)",
)
def trial_models(spark: SparkSession, sf: str) -> DataFrame:
    """The model of every trial is saved, and scores the held-out rows as its trial did."""
    train, oos = split.holdout(v.clean_training(spark, sf), "key", 10)
    name = "mean_absolute_error_scorer"
    found = search.search(
        train, oos, v.FEATURES, lambda p: GramRegressor(**p), {"ridge": _RIDGES}, "GridSearch", f"oos_{name}", [name],
        n_splits=2, jobs=2, save_to=shared_folder(spark),
    )
    rows = []
    with held(oos) as oos:
        for one in found.models.join(found.trials, "trial_id").collect():  # one row per trial
            again = GramRegressor.load(spark, one["path"]).transform(oos)
            row = metrics.score(again, [name], len(v.FEATURES)).withColumn("n", F.lit(oos.count())).first()
            rows.append((one["trial_id"], row["n"], abs(row[name] - one["scores"][f"oos_{name}"]) < 1e-6))
    return spark.createDataFrame(rows, "trial_id long, n_rows long, same_score boolean")
