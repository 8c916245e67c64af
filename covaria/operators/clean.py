"""Float casts and the missing-value filter."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..schema import BOOKKEEPING, MISSING, RESERVED, numeric_columns


def cast_float(df: DataFrame, columns: Sequence[str] | None = None, lenient: bool = False) -> DataFrame:
    """Cast to float32.  Bad text is an error; `lenient` turns it into null."""
    chosen = set(columns if columns is not None else [c for c in df.columns if c not in BOOKKEEPING])
    out = []
    for c in df.columns:
        if c not in chosen:
            out.append(F.col(c))
        else:
            out.append((F.col(c).try_cast("float") if lenient else F.col(c).cast("float")).alias(c))
    return df.select(*out)


def is_present(name: str, dtype: T.DataType) -> Column:
    c = F.col(name)
    ok = c.isNotNull() & (c != F.lit(MISSING))
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        # NaN sorts above infinity, so two comparisons that a Parquet scan can
        # take over rule out NaN and both infinities.
        ok = ok & (c < F.lit(float("inf"))) & (c > F.lit(float("-inf")))
    return ok


def all_present(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """Whether no (numeric) column of a row is null, NaN, infinite or -9999."""
    names = list(columns) if columns is not None else numeric_columns(df)
    types = {f.name: f.dataType for f in df.schema.fields}
    return reduce(lambda a, b: a & b, [is_present(c, types[c]) for c in names], F.lit(True))


def clean(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows where any (numeric) column is null, NaN, infinite or -9999."""
    if not (numeric_columns(df) if columns is None else columns):
        return df
    return df.filter(all_present(df, columns))


def clean_selected(df: DataFrame, features: Sequence[str], label: str = "target", keep: Sequence[str] = ()) -> DataFrame:
    """Clean on the selected features and the label only, and keep only them."""
    used = [*features, label]
    return clean(df.select(*keep, *used), used)


def features_only(df: DataFrame) -> DataFrame:
    return df.drop(*RESERVED, *BOOKKEEPING)


def without(df: DataFrame, feature: str) -> DataFrame:
    """Leave-one-feature-out projection."""
    return df.drop(feature)


def align(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Give `df` exactly these columns; absent ones become null."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(None).cast("double").alias(c) for c in columns])


def stack_aligned(first: DataFrame, second: DataFrame) -> DataFrame:
    """Union on the columns both tables have."""
    shared = [c for c in first.columns if c in set(second.columns)]
    return first.select(*shared).unionByName(second.select(*shared))
