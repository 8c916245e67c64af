"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import cut_lineage

# A key is hot when it holds more than 1/HOT_SHARE of all rows: fewer than HOT_SHARE keys can be hot.
HOT_SHARE = 1000
# Rows of hot keys are dealt out to this many places.
SPREAD = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], count: str, total: Column | int, by: Sequence[str]
) -> DataFrame:
    """Left join to a table with one row per key, safe against hot keys.

    `right[count]` is the number of rows that the key has in `left`, `total`
    the number of all rows of `left`.  Keys with more than total / HOT_SHARE
    rows are fewer than HOT_SHARE, so their rows of `right` are broadcast;
    all other rows meet in one shuffle, where the rows of hot keys are dealt
    out by a hash of the columns `by`.  Rows of `left` with a null key find
    nothing and are dealt out likewise.  The columns of `right` other than the
    keys are added; their names must be free in `left`.
    """
    added = [c for c in right.columns if c not in keys]
    is_hot = F.col(count) * F.lit(HOT_SHARE) > F.lit(total)
    hot = right.filter(is_hot).select(
        *[F.col(k).alias(f"_h_{k}") for k in keys], *[F.col(c).alias(f"_h_{c}") for c in added], F.lit(True).alias("_is_hot")
    )
    # Always 0, but not for the optimizer: with a constant it would take the place out of the shuffle's key.
    zero = F.pmod(F.xxhash64(*keys), F.lit(1)).cast("int")
    cold = right.filter(~is_hot).select(
        *[F.col(k).alias(f"_c_{k}") for k in keys], *[F.col(c).alias(f"_c_{c}") for c in added], zero.alias("_c_place")
    )
    some_null = F.lit(False)
    for k in keys:
        some_null = some_null | F.col(k).isNull()
    place = F.when(
        F.col("_is_hot").isNotNull() | some_null, F.lit(1) + F.pmod(F.xxhash64(*by), F.lit(SPREAD)).cast("int")
    ).otherwise(F.lit(0))
    same_hot, same_cold = F.lit(True), F.col("_place") == F.col("_c_place")
    for k in keys:
        same_hot = same_hot & (F.col(k) == F.col(f"_h_{k}"))
        same_cold = same_cold & (F.col(k) == F.col(f"_c_{k}"))
    out = left.join(F.broadcast(hot), same_hot, "left").withColumn("_place", place).join(cold, same_cold, "left")
    return out.select(*left.columns, *[F.coalesce(f"_h_{c}", f"_c_{c}").alias(c) for c in added])


def pair_tiles(rows: DataFrame, key: str, item: str, size: int) -> DataFrame:
    """Split the rows of large keys so that every pair of rows of a key still meets, and in one place.

    Adds `tile`, `part` and `cross`.  A key with n > `size` rows has
    ceil(n / size) parts; a row goes to one tile for each part of its key.
    The pairs of a tile are those of two different parts if `cross`, else all.
    `rows` is read twice, so it should be cheap to make or written out.
    """
    sizes = cut_lineage(rows.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > size))
    if sizes.isEmpty():
        return rows.select(*rows.columns, F.col(key).alias("tile"), F.lit(0).alias("part"), F.lit(False).alias("cross"))
    counted = spread_join(rows, sizes, [key], "_rows", rows.count(), [item])
    parts = F.coalesce(F.ceil(F.col("_rows") / size), F.lit(1)).cast("int")
    part = F.pmod(F.xxhash64(item), parts).cast("int")
    each = counted.select(*rows.columns, part.alias("part"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("_other"))
    low, high = F.least("part", "_other"), F.greatest("part", "_other")
    return each.select(*rows.columns, F.xxhash64(key, low, high).alias("tile"), "part", (low != high).alias("cross"))


def plain_names(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """`df` with columns c0, c1, ... in their order, and their real names, so added columns cannot clash with them."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]), df.columns


def without(df: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """The rows of `df` whose id is not in the one column of `ids`; null counts as equal to null."""
    plain, names = plain_names(df)
    gone = ids.toDF("_gone").distinct()
    return plain.join(gone, plain[f"c{names.index(id_col)}"].eqNullSafe(gone["_gone"]), "left_anti").toDF(*names)


def _hung(left: DataFrame, key: str, low: DataFrame) -> DataFrame:
    """Rows of `left` with the smallest neighbour of `key` beside them (`low`: key, _m, _n)."""
    total = left.agg(F.count(F.lit(1))).first()[0]
    return spread_join(left, low, [key], "_n", total, ["a", "b"])


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """Connected components of an undirected graph, as (node, root), root the smallest node reached.

    `edges` has two columns of one ordered type.  Large-star and small-star
    steps hang every node below the smallest one that it knows, until nothing
    changes; the number of rounds grows with the logarithm of the longest
    path.  Each round is written to the shared folder.  Null ends and loops
    are dropped.  Nodes without an edge are not in the result.
    """
    x, y = edges.columns
    pairs = edges.filter(F.col(x).isNotNull() & F.col(y).isNotNull() & (F.col(x) != F.col(y)))
    # b < a throughout.
    now = cut_lineage(pairs.select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).distinct())
    rows, seen = now.count(), None
    for _ in range(rounds):
        # Large star: every larger neighbour of b hangs below the smallest node known to b.
        around = now.select(F.col("b").alias("node"), F.col("a").alias("other"), F.lit(1).alias("_one")).unionByName(
            now.select(F.col("a").alias("node"), F.col("b").alias("other"), F.lit(0).alias("_one"))
        )
        low = around.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("_m"), F.sum("_one").alias("_n"))
        large = cut_lineage(
            _hung(now, "b", low.filter("_n > 0").withColumnRenamed("node", "b")).select("a", F.col("_m").alias("b")).distinct(), rows
        )
        # Small star: the smaller neighbours of a hang below the smallest of them, as a does.
        low = large.groupBy("a").agg(F.min("b").alias("_m"), F.count(F.lit(1)).alias("_n"))
        hung = _hung(large, "a", low)
        now = cut_lineage(
            hung.select(F.explode(F.array(
                F.struct("a", F.col("_m").alias("b")), F.struct(F.col("b").alias("a"), F.col("_m").alias("b"))
            )).alias("e")).select("e.a", "e.b").filter("a != b").distinct(), 2 * rows
        )
        state = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == seen:
            break
        rows, seen = state[0], state
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
