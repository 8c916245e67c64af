"""Path and name helpers as columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def file_stem(path: Column) -> Column:
    """File name without its last extension; a leading dot is no extension."""
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def with_suffix(path: Column, suffix: str, extension: str = ".tif") -> Column:
    """`a/b.tif` -> `a/b<suffix>.tif`."""
    return F.replace(path, F.lit(extension), F.lit(suffix + extension))


def band_name(stem: Column, band: Column, n_bands: Column) -> Column:
    """Multi-band rasters get one name per band, single-band ones keep theirs."""
    return F.when(n_bands > 1, F.concat_ws("_", stem, band.cast("string"))).otherwise(stem)
