"""Exact order statistics without a global sort.

`rank_cuts` answers "below which value lie exactly r rows?" by refining
histograms of a 60-bit order value.  Each pass is one map-side-combined count
over the order column alone, so hold-out and k-fold splits become plain
filters on literals: the table itself is never shuffled or sorted.

`exact_rank` gives every row its position.  It needs one shuffle into many
small hash ranges, plus a table of range offsets whose size is bounded.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.hashing import HASH_BITS
from ..session import cut_lineage, held

_STEP_BITS = 15
_COLLECT_VALUES = 50_000
_ROWS_PER_RANGE = 200_000
_MAX_RANGE_BITS = 20


class TiedOrderError(ValueError):
    """Rows share one order value at a cut, so an exact split is undefined."""


def rank_cuts(
    df: DataFrame, value: Column, ranks: Callable[[int], Sequence[int]], bits: int = HASH_BITS
) -> list[int]:
    """For each wanted rank r: a value T such that exactly r rows have value < T.

    `ranks` gets the row count, which the first pass yields for free.  Values
    must lie in [0, 2**bits).  Per pass, at most 2**15 counts (or a bounded
    number of values) per pending cut reach the driver, however many rows
    there are.
    """
    # Eight bytes per row are kept, so that later passes skip the input's plan.
    with held(df.select(value.alias("v"))) as values:
        return _cuts(values, ranks, bits)


def _cuts(values: DataFrame, ranks: Callable[[int], Sequence[int]], bits: int) -> list[int]:
    shift = max(bits - _STEP_BITS, 0)
    first = values.groupBy(F.shiftright("v", shift).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()
    histogram = sorted((r["b"], r["n"]) for r in first)
    wanted = list(ranks(sum(n for _, n in histogram)))

    found: dict[int, int] = {}
    # rank -> (range that holds the cut, rows before that range)
    pending: dict[int, tuple[int, int]] = {}

    def locate(r: int, before: int, counts: Sequence[tuple[int, int]], end: int) -> None:
        for bucket, n in counts:
            if before >= r:
                found[r] = bucket << shift
                return
            if before + n > r:
                if shift == 0:
                    raise TiedOrderError(
                        f"{n} rows tie at rank {r}; the key must identify a row (see operators.ranks.with_row_key)"
                    )
                pending[r] = (bucket, before)
                return
            before += n
        found[r] = end

    for r in set(wanted):
        if r <= 0:
            found[r] = 0
        else:
            locate(r, 0, histogram, 1 << bits)
    size = dict(histogram)
    while pending:
        outer = shift
        open_ranges = {bucket for bucket, _ in pending.values()}
        scope = values.filter(F.shiftright("v", outer).isin(sorted(open_ranges)))
        if sum(size[b] for b in open_ranges) <= _COLLECT_VALUES:
            shift = 0
            counted: dict[int, int] = {}
            for row in scope.collect():
                counted[row["v"]] = counted.get(row["v"], 0) + 1
        else:
            shift = max(outer - _STEP_BITS, 0)
            grouped = scope.groupBy(F.shiftright("v", shift).alias("b")).agg(F.count(F.lit(1)).alias("n"))
            counted = {row["b"]: row["n"] for row in grouped.collect()}
        inside: dict[int, list[tuple[int, int]]] = {}
        for bucket in sorted(counted):
            inside.setdefault(bucket >> (outer - shift), []).append((bucket, counted[bucket]))
        size = counted
        todo, pending = pending, {}
        for r, (bucket, before) in todo.items():
            locate(r, before, inside.get(bucket, []), (bucket + 1) << outer)
    return [found[r] for r in wanted]


def range_of(value: Column, cuts: Sequence[int]) -> Column:
    """Number of cuts at or below the value: 0 .. len(cuts)."""
    expr = F.lit(len(cuts))
    for i in reversed(range(len(cuts))):
        expr = F.when(value < F.lit(cuts[i]), F.lit(i)).otherwise(expr)
    return expr


def exact_rank(df: DataFrame, value: Column, name: str = "rank", bits: int = HASH_BITS, rows: int | None = None) -> DataFrame:
    """Add the 0-based position of each row in the order of `value`, then of the columns.

    A hash of many rows has equal values; with the columns behind it a task
    that runs again gives the same positions.
    """
    ties = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    n = df.count() if rows is None else rows
    range_bits = min(_MAX_RANGE_BITS, max(6, (max(n, 1) // _ROWS_PER_RANGE).bit_length()))
    marked = df.withColumn("_v", value).withColumn("_b", F.shiftright("_v", bits - range_bits))
    # At most 2**20 ranges: the offset table is bounded whatever the row count.
    counts = marked.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_b", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_b").orderBy("_v", *ties))
    return (
        marked.withColumn("_r", inside)
        .join(F.broadcast(offsets), "_b")
        .withColumn(name, F.col("_before") + F.col("_r") - F.lit(1))
        .drop("_v", "_b", "_r", "_before")
    )


def sorted_rank(df: DataFrame, order: Sequence[str], name: str = "rank") -> DataFrame:
    """Add the 0-based position in the order of real columns (unique together).

    Range partitions are sorted on their own; positions inside a partition
    plus the sizes of the partitions before it give the global position.  The
    ids are written out once, so both readings of them agree.
    """
    placed = cut_lineage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    # Fixed by the documented layout of the id: partition above bit 33, row below.
    marked = placed.withColumn("_b", F.shiftright("_id", 33))
    counts = marked.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_b", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_before"))
    inside = F.col("_id").bitwiseAND(F.lit(2**33 - 1))
    # One offset per partition: bounded by the partition count.
    return (
        marked.join(F.broadcast(offsets), "_b")
        .withColumn(name, F.col("_before") + inside)
        .drop("_id", "_b", "_before")
    )


def with_row_key(df: DataFrame, name: str = "key") -> DataFrame:
    """Give rows without a natural key a number, fixed by writing the table out."""
    return cut_lineage(df.withColumn(name, F.monotonically_increasing_id()))
