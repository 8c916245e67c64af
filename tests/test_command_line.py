import json

import pytest
from pyspark.sql import functions as F

from covaria.__main__ import main, parse_config, parse_space
from covaria.plans import views as v
from covaria.plans.config import ConfigError
from covaria.sources import sinks


def test_command_line_run(spark, sf, tmp_path):
    """Sources on disk, a run from a file, and a second run that starts from its results."""
    sinks.write_geojson_lines(v.points(spark, sf), str(tmp_path / "targets"), ["point_id", "price", "customer"])
    v.raster_cells(spark, sf).unionByName(
        v.mask_cells(spark, sf).select(F.lit("area").alias("raster"), F.lit(1).alias("band"), "row", "col", "value")
    ).write.parquet(str(tmp_path / "cells"))
    meta = v.raster_meta(spark, sf)
    area = meta.filter("raster = 'price'").withColumns({"raster": F.lit("area"), "nodata": F.lit(0.0)})
    meta.unionByName(area).write.parquet(str(tmp_path / "meta"))
    document = {
        "inputs": {"targets": str(tmp_path / "targets"), "cells": str(tmp_path / "cells"), "meta": str(tmp_path / "meta"), "area": "area"},
        "workflow": {
            "covariates": ["price", "parts_1", "parts_2"],
            "target": {"property": "price", "percentage_oos": 10},
            "ranking": {"method": "FeatureRankingByEliminationOOS", "no_features_to_select": 2},
            "search": {"algorithm": "RandomSearch", "n_iteration": 1, "n_splits": 2, "space": {"ridge": {"distribution": "uniform", "args": [0, 1]}}},
            "stages": ["data_preparation", "feature_extraction", "hyper_parameter_optimization"],
            "output_folder": str(tmp_path / "out"),
        },
    }
    path = tmp_path / "run.json"
    path.write_text(json.dumps(document))
    assert main(["-c", str(path), "-l", "INFO"], spark) == 0
    assert (tmp_path / "out" / "trials").exists() and not (tmp_path / "out" / "prediction_map").exists()
    chosen = [r["feature"] for r in spark.read.parquet(str(tmp_path / "out" / "feature_ranking")).orderBy("rank").collect()][-2:]

    document["workflow"].update(
        stages=["prediction_mapping"], selected_features=chosen, trained_model=str(tmp_path / "out" / "0" / "model")
    )
    path.write_text(json.dumps(document))
    assert main(["-c", str(path)], spark) == 0
    surface = spark.read.parquet(str(tmp_path / "out" / "prediction_map"))
    masked = v.mask_cells(spark, sf).filter("value = 0").count()
    assert surface.filter("value = -9999").count() == masked


def test_config_text_is_not_evaluated():
    with pytest.raises(ConfigError, match="unknown distribution"):
        parse_space({"a": {"distribution": "__import__('os')", "args": []}})
    with pytest.raises(ConfigError):
        parse_config({"covariates": ["a"], "nope": 1})
    with pytest.raises(ConfigError):
        parse_config({"covariates": ["a"], "target": {"nope": 1}})
    assert parse_space({"a": [1, 2]}) == {"a": [1, 2]}
