"""Run the workflow from a JSON file: `python -m covaria -c FILE [-l LEVEL]`.

The file has two members.  `inputs` names the source tables: `targets` (GeoJSON
lines), `cells` and `meta` (raster tables), and optionally `area` (a raster
name), `oos` and `shap` (GeoJSON lines).  `workflow` holds the fields of
`WorkflowConfig`; a search parameter is a list of values or an object such as
`{"distribution": "uniform", "args": [3, 15]}`.
"""

from __future__ import annotations

import argparse
import json
import logging
import time
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from .functions.distributions import DISTRIBUTIONS
from .operators.raster import band_meta, split_bands
from .plans.config import ConfigError, ExplorationConfig, RankingConfig, SearchConfig, TargetConfig, WorkflowConfig
from .plans.workflow import Inputs, run_workflow
from .session import build_session, tune
from .sources.tables import read_geojson_lines, read_raster

log = logging.getLogger("covaria")


def parse_space(declared: dict[str, Any]) -> dict[str, Any]:
    """Search parameters by distribution name; text is never evaluated."""
    space: dict[str, Any] = {}
    for name, spec in declared.items():
        if isinstance(spec, list):
            space[name] = spec
            continue
        kind = spec.get("distribution")
        if kind not in DISTRIBUTIONS or kind in ("sample_from", "function"):
            raise ConfigError(f"unknown distribution {kind!r} for {name!r}")
        space[name] = DISTRIBUTIONS[kind](*spec.get("args", []))
    return space


def parse_config(fields: dict[str, Any]) -> WorkflowConfig:
    fields = dict(fields)
    parts = {"target": TargetConfig, "ranking": RankingConfig, "search": SearchConfig, "exploration": ExplorationConfig}
    for name, kind in parts.items():
        if name in fields:
            values = dict(fields[name])
            if name == "search" and isinstance(values.get("space"), dict):
                values["space"] = parse_space(values["space"])
            try:
                fields[name] = kind(**values)
            except TypeError as err:
                raise ConfigError(f"{name}: {err}") from None
    try:
        return WorkflowConfig(**fields)
    except TypeError as err:
        raise ConfigError(str(err)) from None


def _features(spark: SparkSession, path: str | None, key: str) -> DataFrame | None:
    if path is None:
        return None
    features = read_geojson_lines(spark, path)
    named = F.col("feature.properties")[key]
    return features.withColumn(key, named)


def open_inputs(spark: SparkSession, paths: dict[str, str], key: str) -> Inputs:
    """Source tables; every target carries its key as a property."""
    for name in ("targets", "cells", "meta"):
        if name not in paths:
            raise ConfigError(f"inputs lack {name!r}")
    cells, meta = read_raster(spark, paths["cells"], paths["meta"])
    area = mask = None
    if paths.get("area"):
        area = meta.filter(F.col("raster") == paths["area"]).first()
        if area is None:
            raise ConfigError(f"no raster named {paths['area']!r}")
        mask = cells.filter((F.col("raster") == paths["area"]) & (F.col("band") == 1)).select("row", "col", "value")
    return Inputs(
        features=_features(spark, paths["targets"], key),
        cells=split_bands(cells, meta),
        meta=band_meta(meta),
        area=area,
        mask=mask,
        oos_features=_features(spark, paths.get("oos"), key),
        shap_features=_features(spark, paths.get("shap"), key),
    )


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="covaria")
    parser.add_argument("-c", "--config", required=True, metavar="FILE")
    parser.add_argument("-l", "--log", default="WARNING", metavar="LEVEL", help="DEBUG, INFO, WARNING, ERROR")
    args = parser.parse_args(argv)
    logging.basicConfig(level=getattr(logging, args.log.upper()))
    with open(args.config, encoding="utf-8") as handle:
        document = json.load(handle)
    conf = parse_config(document["workflow"])
    if conf.output_folder is None:
        raise ConfigError("the workflow needs an output_folder")
    spark = tune(spark or build_session())
    start = time.monotonic()
    out = run_workflow(spark, open_inputs(spark, document["inputs"], conf.key), conf)
    log.info("stages %s took %.1f s", ", ".join(conf.stages), time.monotonic() - start)
    for name in sorted(out.tables):
        log.info("table %s written to %s", name, conf.output_folder)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
