"""The stages of the workflow, each a function from tables to tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from ..functions.metrics import long_scores, mean_scores, score
from ..models.base import Fitted, Model
from ..models.linear import FittedLinear
from ..functions.projection import PROJECTED, check_crs
from ..models.registry import classifier, default_space, load, regressor
from ..operators import drift as drift_ops
from ..operators import explore, ranking, search as search_ops, shapley, tree_shapley
from ..operators.clean import cast_float, clean, clean_selected
from ..operators.points import normalise_points, project_points
from ..operators.predict import prediction_map
from ..operators.raster import reproject, sample_at_points, suggested_grid, to_projection
from ..operators.scoring import fit_and_predict, out_of_fold, predicted_vs_real
from ..operators.sets import match_exact, usable
from ..operators.split import assign_folds, assign_group_folds, holdout
from ..schema import covariates_of
from ..session import cut_lineage, held
from ..sources.sinks import write_geojson_collection
from .config import DECLARED, RankingConfig, WorkflowConfig


@dataclass
class Inputs:
    """Source tables of a run.

    `features`, `oos_features`, `shap_features` hold GeoJSON features (column
    `feature`) and the run's key column; `cells` and `meta` are the
    single-band covariates; `area` is the area of interest and `mask` its cells.
    """

    features: DataFrame
    cells: DataFrame
    meta: DataFrame
    area: Row | dict[str, Any] | None = None
    mask: DataFrame | None = None
    oos_features: DataFrame | None = None
    shap_features: DataFrame | None = None
    # Where covariates in degrees are brought to; without it a grid is worked out for each.
    grid: Row | dict[str, Any] | None = None


def projected(spark: SparkSession, inputs: Inputs) -> Inputs:
    """The inputs with all covariates, the area and its mask in the projection."""
    cells, meta = to_projection(spark, inputs.cells, inputs.meta, inputs.grid)
    area, mask = inputs.area, inputs.mask
    crs = None if area is None else (area.asDict() if isinstance(area, Row) else area).get("crs")
    if check_crs(crs) != PROJECTED:
        known = area.asDict() if isinstance(area, Row) else area
        target = {**known, **(inputs.grid or suggested_grid(spark, area)), "crs": PROJECTED}
        if mask is not None:
            mask = reproject(mask, area, target, spark)
        area = target
    return replace(inputs, cells=cells, meta=meta, area=area, mask=mask)


def build_training_table(
    features: DataFrame,
    cells: DataFrame,
    meta: DataFrame,
    covariates: Sequence[str],
    target: str | None,
    weight: str | None = None,
    group: str | None = None,
    geographic: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(table, rejects): parse, project, sample, cast, clean in one lazy plan."""
    points, rejects = normalise_points(features, target, weight, group)
    if geographic:
        points = project_points(points)
    sampled = sample_at_points(points, cells, meta, covariates)
    floats = [c for c in ("target", "weight", "groupcv") if c in sampled.columns] + list(covariates)
    table = cast_float(sampled, floats)
    order = [c for c in features.columns if c != "feature"]
    order += ["target", *covariates, "x", "y", *[c for c in ("weight", "groupcv") if c in table.columns]]
    table = table.select(*order)
    return clean(table, [*floats, "x", "y"]), rejects


@dataclass
class Prepared:
    training: DataFrame
    oos: DataFrame | None
    shap: DataFrame | None
    rejects: DataFrame
    covariates: list[str]
    left_out: DataFrame


def prepare(inputs: Inputs, conf: WorkflowConfig) -> Prepared:
    """Training, out-of-sample and Shapley tables, with group folds if asked for.

    Covariates in degrees are brought to the projection.  A covariate that is
    named twice counts once, and one that does not exist is left out; both are
    reported in `left_out`.
    """
    t = conf.target
    inputs = projected(inputs.meta.sparkSession, inputs)
    names, left_out = usable(conf.covariates, inputs.meta)
    if not names:
        raise ValueError(f"none of the covariates exists: {list(conf.covariates)}")

    def table(features: DataFrame, prop: str | None) -> tuple[DataFrame, DataFrame]:
        rows, lost = build_training_table(
            features, inputs.cells, inputs.meta, names, prop, t.weight, t.group, t.geographic
        )
        # Sampling the rasters is the costly part: splits and folds read its result.
        return cut_lineage(rows), lost

    training, rejects = table(inputs.features, t.property)
    if t.group is not None:
        training = assign_group_folds(training, "groupcv", t.group_splits, conf.seed)
    oos = shap = None
    if t.percentage_oos is not None:
        training, oos = holdout(training, conf.key, t.percentage_oos, conf.seed)
    elif inputs.oos_features is not None:
        oos, _ = table(inputs.oos_features, t.property)
    if inputs.shap_features is not None:
        shap, _ = table(inputs.shap_features, None)
    return Prepared(training, oos, shap, rejects, names, left_out)


def explore_table(df: DataFrame, prefix: str) -> dict[str, DataFrame]:
    columns = covariates_of(df)
    return {
        f"{prefix}_histogram": explore.histogram(df, columns),
        f"{prefix}_scatter": explore.scatter(df, columns),
        f"{prefix}_density": explore.point_density(df),
        f"{prefix}_correlation": explore.correlations(df, columns),
    }


def rank_features(
    training: DataFrame,
    conf: RankingConfig,
    model: Model,
    oos: DataFrame | None = None,
    shap: DataFrame | None = None,
    features: Sequence[str] | None = None,
    key: str = "key",
    seed: str | int = 0,
    jobs: int = 2,
) -> tuple[DataFrame, list[str], DataFrame | None]:
    """(ranking, selected features, elimination log or None)."""
    names = list(features) if features is not None else covariates_of(training)
    k = len(names) if conf.no_features_to_select == -1 else conf.no_features_to_select
    spark = training.sparkSession
    if conf.method == "FeatureRankingByRandomness":
        table = ranking.random_ranking(spark, names, k, seed)
        return table, [r["feature"] for r in table.collect()], None
    if conf.method == "FeatureRankingByShap":
        data = shap if shap is not None else oos
        if data is None:
            raise ValueError("Shapley ranking needs an out-of-sample table")
        fitted = model.fit(clean(training), names)
        rows = clean(data)
        if isinstance(fitted, FittedLinear):
            table = shapley.importance(shapley.linear_values(fitted, rows), names)
        elif tree_shapley.is_tree_model(fitted):
            table = tree_shapley.tree_importance(fitted, rows, key=key)
        else:
            table = shapley.sampled_importance(fitted, rows, key, conf.permutations, seed)
        return table, ranking.select_features(table, "shap", k), None
    if conf.method == "FeatureRankingByEliminationCV":
        folds = assign_folds(clean(training), key, conf.n_splits)
        log = ranking.cv_elimination(folds, names, model, conf.scoring_function, "fold", jobs=jobs)
    elif conf.method == "FeatureRankingByGroupCV":
        if "groupcv_class" not in training.columns:
            raise ValueError("grouped ranking needs group folds")
        log = ranking.cv_elimination(clean(training), names, model, conf.scoring_function, "groupcv_class", jobs=jobs)
    elif conf.method == "FeatureRankingByEliminationOOS":
        if oos is None:
            raise ValueError("out-of-sample ranking needs an out-of-sample table")
        log = ranking.oos_elimination(clean(training), clean(oos), names, model, conf.scoring_function, jobs=jobs)
    else:
        raise ValueError(f"unknown ranking method {conf.method!r}")
    table = ranking.eliminated(log)
    return table, ranking.select_features(table, "elimination", k), log


def explore_model(
    training: DataFrame,
    oos: DataFrame,
    features: Sequence[str],
    model: Model,
    scorers: Sequence[str],
    n_splits: int,
    key: str = "key",
) -> dict[str, DataFrame]:
    """Out-of-sample and cross-validated scores, predicted-versus-real tables, and the importance of features where the
    model has one."""
    fitted, predicted = fit_and_predict(training, oos, features, model)
    oos_row = mean_scores(score(predicted, scorers, len(features)), scorers, "oos")
    table = assign_folds(clean_selected(training, features, keep=[key]), key, n_splits)
    crossed = out_of_fold(table, features, model)
    per_fold = score(crossed, scorers, len(features), by=["fold"])
    try:
        weights = {"feature_importance": fitted.importance(training.sparkSession)}
    except NotImplementedError:
        weights = {}
    return {
        **weights,
        "oos_scores": long_scores(oos_row),
        "cv_fold_scores": per_fold,
        "cv_scores": long_scores(mean_scores(per_fold, scorers, "cv")),
        "oos_predictions": predicted_vs_real(predicted, keep=[key]),
        "cv_predictions": predicted_vs_real(crossed, "actual_labels", "predicted_labels", keep=[key]),
    }


def covariate_drift(
    spark: SparkSession,
    training: DataFrame,
    inputs: Inputs,
    features: Sequence[str],
    classifier_name: str,
    key: str = "key",
    seed: str | int = 0,
) -> tuple[DataFrame, DataFrame]:
    """(drift table, drift map); rows of the table keep their place in the projection."""
    area = inputs.area
    rows = clean(training, features)
    points = drift_ops.random_points(spark, area, inputs.mask, drift_ops.points_needed(rows.count()), seed)
    sampled = clean(sample_at_points(points, inputs.cells, inputs.meta, features), features)
    # Keys of the two classes must not meet.
    random_rows = sampled.withColumn("key", F.concat(F.lit("random/"), F.col("point_id").cast("string")))
    known_rows = rows.withColumn("key", F.concat(F.lit("training/"), F.col(key).cast("string")))
    stacked = drift_ops.two_classes(known_rows.select("key", "x", "y", *features), random_rows.select("key", "x", "y", *features))
    result = drift_ops.measure_drift(stacked, features, classifier(classifier_name), keep=["key", "x", "y"])
    surface = drift_ops.drift_map(
        spark, area, inputs.cells, inputs.meta, features, result, inputs.mask, area["nodata"]
    )
    return result.table, surface


def drift_properties(features: Sequence[str]) -> list[str]:
    """What a drift point carries as GeoJSON beside its place."""
    return ["key", *features, "probability_class_1", "actual_class"]


@dataclass
class WorkflowResult:
    tables: dict[str, DataFrame] = field(default_factory=dict)
    selected_features: list[str] = field(default_factory=list)
    model: Fitted | None = None
    model_path: str | None = None


def run_workflow(spark: SparkSession, inputs: Inputs, conf: WorkflowConfig) -> WorkflowResult:
    """Run the enabled stages; every result is a named table.

    With an output folder each table is also written there as Parquet, and
    later stages read the written training tables back instead of sampling
    the rasters again.
    """
    inputs = projected(spark, inputs)
    names, left_out = usable(conf.covariates, inputs.meta)
    missed = left_out.count()  # of a short list
    conf = replace(conf, covariates=names)
    out = WorkflowResult(selected_features=list(conf.selected_features or conf.covariates))

    def publish(tables: dict[str, DataFrame]) -> None:
        for name, df in tables.items():
            if conf.output_folder is not None:
                path = f"{conf.output_folder.rstrip('/')}/{name}"
                df.write.mode("overwrite").parquet(path)
                df = spark.read.parquet(path)
            out.tables[name] = df

    if "data_preparation" in conf.stages or conf.output_folder is None:
        ready = prepare(inputs, conf)
        made = {"training": ready.training, "oos": ready.oos, "shap": ready.shap}
        publish({n: t for n, t in made.items() if t is not None})
        publish({"rejects": ready.rejects.select("reject_reason")})
        if missed:
            publish({"left_out": left_out})
    else:
        out.tables.update(_earlier_tables(spark, conf.output_folder))
    training, oos, shap = (out.tables.get(n) for n in ("training", "oos", "shap"))
    # Models join on `key`, whatever the source calls it.
    training, oos, shap = (
        None if t is None else t.withColumnRenamed(conf.key, "key") for t in (training, oos, shap)
    )
    parameters = dict(conf.parameters)

    with held(training) as training:
        if "data_exploration" in conf.stages:
            publish(explore_table(training, "training"))
            if oos is not None:
                publish(explore_table(oos, "oos"))
        if "feature_extraction" in conf.stages:
            table, chosen, log = rank_features(
                training, conf.ranking, regressor(conf.model, parameters), oos, shap, conf.covariates, "key", conf.seed, conf.jobs
            )
            out.selected_features = chosen
            publish({"feature_ranking": table, **({"elimination_log": log} if log is not None else {})})
        features = out.selected_features
        space = default_space(conf.model) if conf.search.space == DECLARED else dict(conf.search.space)
        if "hyper_parameter_optimization" in conf.stages and oos is not None and space:
            found = search_ops.search(
                training, oos, features, lambda p: regressor(conf.model, p), space,
                conf.search.algorithm, conf.search.metric, conf.search.scoring_functions, conf.search.n_iteration,
                conf.search.n_splits, "key", conf.seed, conf.jobs, conf.output_folder,
                convert=lambda p: {**parameters, **p},
            )
            best = found.best.first()
            parameters.update(_typed(best["params"]))
            out.model, out.model_path = found.model, found.model_path
            publish({"trials": found.trials, "best_trial": found.best})
            if found.models is not None:
                publish({"trial_models": found.models})
        if "model_exploration" in conf.stages and oos is not None:
            publish(
                explore_model(
                    training, oos, features, regressor(conf.model, parameters), conf.exploration.scoring_functions,
                    conf.exploration.n_splits,
                )
            )
        if out.model is None and conf.trained_model is not None:
            out.model, out.model_path = load(spark, conf.model, conf.trained_model), conf.trained_model
        if out.model is None and "prediction_mapping" in conf.stages:
            out.model = regressor(conf.model, parameters).fit(clean(training), features)
        if "prediction_mapping" in conf.stages and inputs.area is not None:
            bands = _bands(inputs, out.model.features)
            surface = prediction_map(
                spark, inputs.area, bands[0], bands[1], out.model, inputs.mask, inputs.area["nodata"]
            )
            publish({"prediction_map": surface})
        if "covariate_drift" in conf.stages and inputs.area is not None and inputs.mask is not None:
            table, surface = covariate_drift(
                spark, training, inputs, features, conf.drift_classifier, "key", conf.seed
            )
            publish({"drift": table, "drift_map": surface})
            if conf.output_folder is not None:
                path = f"{conf.output_folder.rstrip('/')}/drift_points.geojson"
                write_geojson_collection(out.tables["drift"], path, drift_properties(features), "key")
    return out


def _earlier_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Tables that an earlier run left in the output folder."""
    found = {}
    for name in ("training", "oos", "shap"):
        try:
            found[name] = spark.read.parquet(f"{folder.rstrip('/')}/{name}")
        except AnalysisException:
            continue
    if "training" not in found:
        raise ValueError(f"no training table in {folder}; switch data_preparation on")
    return found


def _bands(inputs: Inputs, features: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Covariate rows of the selected features only, by exact name."""
    spark = inputs.meta.sparkSession
    wanted = spark.createDataFrame([(f,) for f in features], "feature string")
    return match_exact(wanted, inputs.cells), match_exact(wanted, inputs.meta)


def _typed(params: dict[str, str]) -> dict[str, Any]:
    """Parameter values back from text: numbers where they read as numbers."""

    def value(text: str) -> Any:
        for kind in (int, float):
            try:
                return kind(text)
            except ValueError:
                continue
        return {"True": True, "False": False}.get(text, text)

    return {k: value(v) for k, v in params.items()}
