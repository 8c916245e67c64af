"""Lookup joins that survive hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

# A side is broadcast only if it is proved to have at most this many rows and bytes.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 << 20
# A key is hot when it holds more than 1/HOT_SHARE of the rows; so there are
# fewer than HOT_SHARE hot keys, whatever the data.
HOT_SHARE = 1000
# Counters of the heavy-hitter sketch: its error is far below the hot share.
SKETCH = 32_768
# Rows of a hot key are dealt out to this many places.
PLACES = 64
# Lookup rows with arrays are copied as rarely as can be: a place gets up to 1/WIDE_SHARE of the rows.
WIDE_SHARE = 256


def row_bytes(df: DataFrame) -> int:
    """A generous estimate of the bytes of one row, from the types alone."""

    def size(t: T.DataType) -> int:
        if isinstance(t, T.StructType):
            return sum(size(f.dataType) for f in t.fields)
        if isinstance(t, (T.StringType, T.BinaryType)):
            return 64
        if isinstance(t, T.ArrayType):
            return 64 * size(t.elementType)
        if isinstance(t, T.MapType):
            return 64 * (size(t.keyType) + size(t.valueType))
        return 16

    return 32 + size(df.schema)


def fits(df: DataFrame, count: int, rows: int = BROADCAST_ROWS) -> bool:
    """Whether `count` rows of this table are few and small enough for a broadcast."""
    return count <= rows and count * row_bytes(df) <= BROADCAST_BYTES


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Counted in full, by partial counts: no task meets more than one number of each other task."""
    return fits(df, df.count(), rows)


def _key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def _heavy_hashes(df: DataFrame, keys: Sequence[str], share: int) -> tuple[dict[int, int], int]:
    """Key hashes that may hold more than 1/share of the rows, with their rows, and the number of all: one pass, bounded memory."""
    row = df.select(_key_hash(keys).alias("_h")).agg(
        F.expr(f"approx_top_k(_h, {2 * share}, {SKETCH})").alias("top"), F.count(F.lit(1)).alias("n")
    ).first()
    return {t["item"]: t["count"] for t in row["top"] or [] if t["count"] * share > row["n"]}, row["n"]


def hot_keys(df: DataFrame, keys: Sequence[str], share: int = HOT_SHARE) -> list[tuple]:
    """Keys that hold more than 1/share of the rows: fewer than `share` of them.

    A sketch names the candidates in one pass; only these are counted.
    """
    heavy, n = _heavy_hashes(df, keys, share)
    if not heavy:
        return []
    counts = df.filter(_key_hash(keys).isin(list(heavy))).groupBy(*keys).count().filter(F.col("count") * share > n).collect()
    return [tuple(r[k] for k in keys) for r in counts]


def _by_places(heavy: dict[int, int], n: int, wide: bool) -> dict[int, list[int]]:
    """Hot hashes by the number of places that their rows are dealt out to."""
    out: dict[int, list[int]] = {}
    for h, count in heavy.items():
        out.setdefault(min(PLACES, -(-count * WIDE_SHARE // n)) if wide else PLACES, []).append(h)
    return out


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    small_rows: int = BROADCAST_ROWS,
    bound: int | None = None,
    unique_left: bool = False,
    probe: DataFrame | None = None,
) -> DataFrame:
    """Join `left` to a table with one row per key; the join itself reads each side once.

    A lookup table of proven small size is broadcast: `bound` is a row count
    that `right` cannot exceed; without it `right` is run once more to count
    its rows, and without `unique_left` the keys of `probe` (or `left`) are run
    to look for hot ones.  Otherwise both sides are shuffled once.  Rows of hot keys are dealt out to
    PLACES places, and the fewer than HOT_SHARE lookup rows of these keys are
    copied to each; of lookup rows with arrays there are as many copies as the
    rows of their key ask for, PLACES at most.  Rows with a null key, which match nothing, are dealt out
    as well.

    `unique_left` says that no key repeats, so none is looked for.  `probe`
    is a cheaper table with the same keys in which to look for hot ones.
    """
    keys = list(keys)
    if how not in ("left", "inner"):
        raise ValueError(f"lookup_join does not support {how!r}")
    if fits(right, bound, small_rows) if bound is not None else is_small(right, small_rows):
        return left.join(F.broadcast(right), keys, how)
    # What is not proved small is not left to the engine's estimate, which knows compressed files and takes an array for one value.
    if unique_left:
        return left.join(right.hint("merge"), keys, how)

    heavy, n = _heavy_hashes(left if probe is None else probe, keys, HOT_SHARE)
    wide = any(isinstance(f.dataType, T.ArrayType) for f in right.schema.fields)
    places = F.lit(1)
    for number, hashes in _by_places(heavy, n, wide).items():
        places = F.when(_key_hash(keys).isin(hashes), F.lit(number)).otherwise(places)
    absent = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    hashed = [f.name for f in left.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    place = F.pmod(F.xxhash64(*hashed), F.when(absent, F.lit(PLACES)).otherwise(places)).cast("int")
    copies = F.sequence(F.lit(0), places - F.lit(1))
    joined = left.withColumn("_place", place).join(
        right.withColumn("_place", F.explode(copies)).hint("merge"), [*keys, "_place"], how
    )
    return joined.drop("_place")
