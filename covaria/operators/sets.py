"""Set-style helpers on name lists and tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .joins import is_small


def drop_repeats(catalogue: DataFrame, name: str = "path", position: str | None = "position") -> DataFrame:
    """Distinct covariates; with a position column the first mention wins."""
    if position is None or position not in catalogue.columns:
        return catalogue.dropDuplicates([name])
    others = [c for c in catalogue.columns if c not in (name, position)]
    return catalogue.groupBy(name).agg(
        F.min(position).alias(position), *[F.min_by(c, position).alias(c) for c in others]
    )


def repeats(catalogue: DataFrame, name: str = "path") -> DataFrame:
    return catalogue.groupBy(name).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def existing(wanted: DataFrame, present: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(found, missing) rows of `wanted`."""
    keys = present.select(name).distinct()
    return wanted.join(keys, name, "left_semi"), wanted.join(keys, name, "left_anti")


def usable(wanted: Sequence[str], present: DataFrame, name: str = "covariate") -> tuple[list[str], DataFrame]:
    """The distinct names of a list that exist, in order, and a report (name, reason) of what was left out.

    The list is a run's configuration, so it is short.
    """
    spark = present.sparkSession
    listed = spark.createDataFrame(list(enumerate(wanted)), f"position int, {name} string")
    found, absent = existing(drop_repeats(listed, name), present, name)
    report = repeats(listed, name).select(name, F.lit("repeated").alias("reason"))
    report = report.unionByName(absent.select(name, F.lit("absent").alias("reason")))
    return [r[name] for r in found.orderBy("position").collect()], report


def match_exact(features: DataFrame, covariates: DataFrame, name: str = "covariate") -> DataFrame:
    """Covariates of the selected features, by equal name."""
    return covariates.join(features.select(F.col("feature").alias(name)).distinct(), name, "left_semi")


def match_substring(features: DataFrame, paths: DataFrame) -> DataFrame:
    """First path (lowest position) that contains each feature name.

    Paths are cut into all substrings that have the length of some feature,
    which turns "contains" into an equi-join: no pairs are formed that do
    not match.
    """
    lengths = [r["n"] for r in features.select(F.length("feature").alias("n")).distinct().collect() if r["n"]]
    if not lengths:
        return features.select("feature", F.lit(None).cast("string").alias("path")).filter("false")

    def pieces_of(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length("path") - F.lit(n - 1), F.lit(1)))
        pieces = F.transform(starts, lambda i: F.substr(F.col("path"), i, F.lit(n)))
        return F.when(F.length("path") >= n, pieces).otherwise(F.array().cast("array<string>"))

    pieces = F.array_distinct(F.flatten(F.array(*[pieces_of(n) for n in sorted(lengths)])))
    grams = paths.select("path", "position", F.explode(pieces).alias("feature"))
    wanted = features.select("feature").distinct()
    wanted = F.broadcast(wanted) if is_small(wanted) else wanted
    return (
        grams.join(wanted, "feature")
        .groupBy("feature")
        .agg(F.min_by("path", "position").alias("path"))
    )


def flatten_lists(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.flatten(column))


def first_rows(df: DataFrame, n: int, order: Sequence[Column | str]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def not_in(df: DataFrame, other: DataFrame, name: str) -> DataFrame:
    return df.join(other.select(name).distinct(), name, "left_anti")


def positions(df: DataFrame, order: Sequence[Column | str], name: str = "position") -> DataFrame:
    """Number the rows of a small name table."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)) - 1)
