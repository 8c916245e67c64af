"""Hold-out, k-fold and grouped splits with exact sizes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.hashing import order_value
from ..session import cut_lineage
from .joins import lookup_join
from .ranks import exact_rank, range_of, rank_cuts, sorted_rank


# Groups and their folds are narrow: so many rows are still within the bytes that a broadcast may have.
GROUP_ROWS = 500_000


def _order(seed: str | int, key: str | Sequence[str]) -> Column:
    return order_value(seed, *([key] if isinstance(key, str) else key))


def fold_bounds(n: int, k: int) -> list[int]:
    """Row ranks where folds 1 .. k-1 begin; the first n mod k folds are one longer."""
    size, extra = divmod(n, k)
    return [i * size + min(i, extra) for i in range(1, k)]


def holdout_size(n: int, percentage: float) -> int:
    return int(n * (percentage / 100))


def flag_holdout(df: DataFrame, key: str | Sequence[str], percentage: float, seed: str | int = 0) -> DataFrame:
    """Add `is_oos`: true for exactly int(n * pct / 100) pseudo-random rows."""
    value = _order(seed, key)
    (cut,) = rank_cuts(df, value, lambda n: [holdout_size(n, percentage)])
    return df.withColumn("is_oos", value < F.lit(cut))


def holdout(df: DataFrame, key: str | Sequence[str], percentage: float, seed: str | int = 0) -> tuple[DataFrame, DataFrame]:
    """(train, oos): complementary filters on one literal, no shuffle."""
    flagged = flag_holdout(df, key, percentage, seed)
    return (
        flagged.filter(~F.col("is_oos")).drop("is_oos"),
        flagged.filter(F.col("is_oos")).drop("is_oos"),
    )


def stored_holdout(df: DataFrame, key: str | Sequence[str], percentage: float, seed: str | int = 0) -> tuple[DataFrame, DataFrame]:
    """`holdout` of rows that are read several times: they are written once, with their place in the order."""
    stored = cut_lineage(df.withColumn("_order", _order(seed, key)))
    (cut,) = rank_cuts(stored, F.col("_order"), lambda n: [holdout_size(n, percentage)])
    return stored.filter(F.col("_order") >= F.lit(cut)).drop("_order"), stored.filter(F.col("_order") < F.lit(cut)).drop("_order")


def assign_folds(
    df: DataFrame, key: str | Sequence[str], k: int, seed: str | int = 1, name: str = "fold", among: Column | None = None
) -> DataFrame:
    """Add a fold number; fold sizes differ by at most one row.  With `among` only rows for which it is true count."""
    if k < 1:
        raise ValueError("k must be at least 1")
    value = _order(seed, key)
    cuts = rank_cuts(df if among is None else df.filter(among), value, lambda n: fold_bounds(n, k))
    # Two steps, so that the hash is computed once per row.
    return df.withColumn("_v", value).withColumn(name, range_of(F.col("_v"), cuts)).drop("_v")


def group_folds(df: DataFrame, group: str, k: int, seed: str | int = 0, name: str = "groupcv_class") -> DataFrame:
    """(group, fold): groups in a seeded order, dealt out to folds in turn."""
    # One row per group, read several times below.
    groups = cut_lineage(df.select(group).distinct().filter(F.col(group).isNotNull()))
    ranked = exact_rank(groups, order_value(seed, group), "_rank")
    return ranked.select(group, (F.col("_rank") % F.lit(k)).cast("int").alias(name))


def assign_group_folds(
    df: DataFrame, group: str, k: int, seed: str | int = 0, name: str = "groupcv_class", ordered: bool = False
) -> DataFrame:
    """Give every row its group's fold; rows of one group never part."""
    out = lookup_join(df, group_folds(df, group, k, seed, name), [group], small_rows=GROUP_ROWS)
    return out.orderBy(group) if ordered else out


def train_part(df: DataFrame, fold: int, name: str = "fold") -> DataFrame:
    return df.filter(F.col(name) != F.lit(fold))


def test_part(df: DataFrame, fold: int, name: str = "fold") -> DataFrame:
    return df.filter(F.col(name) == F.lit(fold))


test_part.__test__ = False


def chunk(df: DataFrame, order: str | Sequence[str], size: int, name: str = "chunk") -> DataFrame:
    """Consecutive runs of `size` rows in the order of a unique key."""
    ranked = sorted_rank(df, [order] if isinstance(order, str) else order, "_rank")
    return ranked.withColumn(name, F.floor(F.col("_rank") / F.lit(size)).cast("long")).drop("_rank")


def subsample(df: DataFrame, key: str | Sequence[str], fraction: float, seed: str | int = 0) -> DataFrame:
    """Exactly round(fraction * n) rows, without replacement, no shuffle."""
    value = _order(seed, key)
    (cut,) = rank_cuts(df, value, lambda n: [round(fraction * n)])
    return df.filter(value < F.lit(cut))


def resample(df: DataFrame, key: str | Sequence[str], fraction: float, seed: str | int = 0, name: str = "copies") -> DataFrame:
    """Exactly round(fraction * n) draws with replacement, as a count per row.

    The draws pick row positions; rows that are never picked drop out.
    """
    n = df.count()
    ranked = exact_rank(df, _order(seed, key), "_rank", rows=n)
    draws = df.sparkSession.range(round(fraction * n)).select(
        F.pmod(order_value(f"{seed}:draw", "id"), F.lit(max(n, 1))).alias("_rank")
    )
    picked = draws.groupBy("_rank").agg(F.count(F.lit(1)).cast("int").alias(name))
    return ranked.join(picked, "_rank").drop("_rank")
