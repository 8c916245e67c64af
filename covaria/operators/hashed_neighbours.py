"""Approximate k nearest neighbours by random projections; chosen by name, never by size.

Each of several hash tables cuts space by hyperplanes through the medians of a
sample, so a row's code is one bit for each plane and cells are about equally
full.  A query visits its own cell and those across the planes it is nearest
to, in order of the squared distance to the planes crossed.  Reference rows are
shuffled once for each table, queries once for each visit; rows of a cell meet
in pieces of at most about `block_rows`, whatever a cell holds, and no candidate
is left out.  Distances are exact; only rows in no visited cell are missed.

`visits_for` measures on sample queries how many cells must be visited for a
wanted recall.  In data without any structure that is most of them, and then
the exact search is the better choice.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.hashing import order_value
from . import neighbours
from .joins import lookup_join
from .shapley import quoted

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows that place the planes, and queries that measure recall: bounded samples, by hash of the key.
SAMPLE_ROWS = 4096
SAMPLE_QUERIES = 128
# Planes that a visit may cross are the nearest so many; so there are at most 2^NEAR_PLANES visits.
NEAR_PLANES = 10
MAX_PLANES = 40
# Rows whose visits a task works out at a time, and values of the rows that it sends on at a time.
VISIT_ROWS = 1024
SENT_VALUES = 500_000


@dataclass(frozen=True)
class Planes:
    """directions (tables, planes, features) of length one, and offsets (tables, planes)."""

    directions: np.ndarray
    offsets: np.ndarray

    @property
    def tables(self) -> int:
        return len(self.directions)

    def sides(self, values: np.ndarray, table: int) -> np.ndarray:
        """Signed distances to the planes of a table."""
        return values @ self.directions[table].T - self.offsets[table]


def _codes(sides: np.ndarray) -> np.ndarray:
    return (sides > 0).astype(np.int64) @ (1 << np.arange(sides.shape[1], dtype=np.int64))


def _visited(sides: np.ndarray, visits: int) -> np.ndarray:
    """(row, visit): codes of the cells to visit, own cell first; the cost of a cell is the sum of the squared
    distances to the planes between."""
    rows, planes = sides.shape
    near = min(planes, NEAR_PLANES)
    order = np.argsort(np.abs(sides), axis=1, kind="stable")[:, :near]
    cost, flips = np.zeros((rows, 1)), np.zeros((rows, 1), np.int64)
    for j in range(near):
        plane = order[:, j, None]
        step = np.take_along_axis(sides, plane, axis=1) ** 2
        cost, flips = np.hstack([cost, cost + step]), np.hstack([flips, flips | (np.int64(1) << plane)])
    first = np.argsort(cost, axis=1, kind="stable")[:, :visits]
    return _codes(sides)[:, None] ^ np.take_along_axis(flips, first, axis=1)


def _vectors(df: DataFrame, key: str, features: Sequence[str], name: str) -> DataFrame:
    """(name, values); rows with a missing or endless value have no neighbours and are nobody's."""
    values = F.array(*[F.col(quoted(f)).cast("double") for f in features])
    rows = df.select(F.col(key).alias(name), values.alias("values"))
    bad = F.exists("values", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter(~bad)


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    return np.array(column.tolist(), dtype=float).reshape(-1, width)


def fit_planes(
    reference: DataFrame, features: Sequence[str], tables: int = 8, cell_rows: int = 512, key: str = "key", seed: int = 0
) -> Planes:
    """Planes for cells of about `cell_rows`: their number from the count of all rows, their places from a sample."""
    width = len(features)
    rows = _vectors(reference, key, features, "neighbour")
    n = rows.count()
    planes = int(np.clip(np.round(np.log2(max(n, 1) / cell_rows)), 0, MAX_PLANES))
    sample = rows.withColumn("_o", order_value(f"{seed}:planes", "neighbour")).orderBy("_o").limit(SAMPLE_ROWS).select("values").toPandas()
    values = _matrix(sample["values"], width)
    draw = np.random.default_rng(seed)
    directions = draw.normal(size=(tables, planes, width))
    for t in range(tables):
        # Planes at right angles tell more than planes alike.
        for start in range(0, planes, width):
            part = directions[t, start : start + width]
            directions[t, start : start + width] = np.linalg.qr(part.T)[0].T
    offsets = np.zeros((tables, planes)) if not len(values) else np.median(np.einsum("nf,tpf->tpn", values, directions), axis=2)
    return Planes(directions, offsets)


def _placed(rows: DataFrame, name: str, sent, width: int, visits: int | None) -> DataFrame:
    """Rows with (cell_table, code): one cell in each table, or the `visits` cells that a query visits."""
    kind = rows.schema[name].dataType.simpleString()

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        planes = Planes(*sent.value)
        # A batch with all its visits would be a thousand times as large as the batch.
        for batch in (b.iloc[i : i + VISIT_ROWS] for b in batches for i in range(0, len(b), VISIT_ROWS)):
            values = _matrix(batch["values"], width)
            for t in range(planes.tables):
                sides = planes.sides(values, t)
                codes = _codes(sides)[:, None] if visits is None else _visited(sides, visits)
                at, codes = np.repeat(np.arange(len(batch)), codes.shape[1]), codes.ravel()
                step = max(1, SENT_VALUES // max(width, 1))
                for start in range(0, len(at), step):
                    some = slice(start, start + step)
                    yield batch.iloc[at[some]].assign(cell_table=np.int32(t), code=codes[some])

    return rows.mapInPandas(place, f"`{name}` {kind}, `values` array<double>, cell_table int, code long")


CELL = ["cell_table", "code"]


def _crowded(placed: DataFrame, block_rows: int, name: str) -> DataFrame:
    """Cells with more than block_rows rows and how many pieces they are cut into; counts merge before the shuffle."""
    counts = placed.groupBy(*CELL).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block_rows)
    return counts.select(*CELL, F.ceil(F.col("n") / block_rows).cast("int").alias(name))


def nearest_hashed(
    queries: DataFrame,
    reference: DataFrame,
    features: Sequence[str],
    k: int,
    planes: Planes,
    visits: int,
    query_key: str = "key",
    reference_key: str = "key",
    skip_self: bool = False,
    block_rows: int = neighbours.BLOCK_ROWS,
) -> DataFrame:
    """(query, neighbour, distance2, position): the k nearest among all rows of the visited cells, ties by key."""
    if visits < 1:
        raise ValueError("a query must visit one cell at least")
    width = len(features)
    sent = queries.sparkSession.sparkContext.broadcast((planes.directions, planes.offsets))
    # At most a thousand visits are kept; all cells are visited where there are fewer planes than that.
    asked = _placed(_vectors(queries, query_key, features, "query"), "query", sent, width, visits)
    known = _placed(_vectors(reference, reference_key, features, "neighbour"), "neighbour", sent, width, None)
    blocks, lanes = _crowded(known, block_rows, "blocks"), _crowded(asked, block_rows, "lanes")
    pieces = blocks.join(lanes, CELL, "full").select(
        *CELL, F.coalesce("blocks", F.lit(1)).alias("blocks"), F.coalesce("lanes", F.lit(1)).alias("lanes")
    )

    def cut(rows: DataFrame, name: str, own: str, other: str, own_count: str, other_count: str) -> DataFrame:
        both = lookup_join(rows, pieces, CELL).withColumns({c: F.coalesce(c, F.lit(1)) for c in ("blocks", "lanes")})
        return both.withColumns({
            own: F.pmod(F.xxhash64(name), F.col(own_count)).cast("int"),
            other: F.explode(F.sequence(F.lit(0), F.col(other_count) - 1)),
        }).drop("blocks", "lanes")

    left = cut(asked, "query", "lane", "block", "lanes", "blocks")
    right = cut(known, "neighbour", "block", "lane", "blocks", "lanes")
    schema = neighbours._pairs_schema(left.schema["query"].dataType, right.schema["neighbour"].dataType)

    def meet(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        r = r.sort_values("neighbour", kind="stable")
        q_key, r_key = q["query"].to_numpy(), r["neighbour"].to_numpy()
        found = neighbours._nearest(_matrix(q["values"], width), q_key, _matrix(r["values"], width), r_key, k, skip_self)
        return neighbours._emit(q_key, r_key, found)

    keys = [*CELL, "block", "lane"]
    pairs = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(meet, schema)
    # A pair that several tables found has one rank.  Each task sends on what has the first k ranks there, so no query's
    # candidates of all visits and tables are held at once.
    order = Window.partitionBy("query").orderBy("distance2", "neighbour")
    first = pairs.withColumn("_r", F.dense_rank().over(order)).filter(F.col("_r") <= k)
    return first.groupBy("query", "neighbour", "distance2").agg((F.min("_r") - 1).cast("int").alias("position"))


def visits_for(
    queries: DataFrame,
    reference: DataFrame,
    features: Sequence[str],
    k: int,
    planes: Planes,
    recall: float = 0.95,
    query_key: str = "key",
    reference_key: str = "key",
    skip_self: bool = False,
    seed: int = 0,
) -> int:
    """How many cells of each table a query must visit to find the share `recall` of its true neighbours.

    Measured on SAMPLE_QUERIES queries against all reference rows: a neighbour
    is found by that visit of any table that first reaches its cell.
    """
    width = len(features)
    some = queries.withColumn("_o", order_value(f"{seed}:queries", query_key)).orderBy("_o").limit(SAMPLE_QUERIES).drop("_o")
    true = neighbours.nearest(some, reference, features, k, query_key, reference_key, skip_self).select("query", "neighbour")
    # SAMPLE_QUERIES times k rows at most.
    pairs = (
        _vectors(reference, reference_key, features, "neighbour").withColumnRenamed("values", "there")
        .join(F.broadcast(true), "neighbour")
        .join(F.broadcast(_vectors(some, query_key, features, "query")), "query")
        .select("values", "there").toPandas()
    )
    if pairs.empty:
        return 1
    here, there = _matrix(pairs["values"], width), _matrix(pairs["there"], width)
    reached = np.full(len(pairs), np.iinfo(np.int64).max)
    for t in range(planes.tables):
        order = _visited(planes.sides(here, t), 1 << NEAR_PLANES)
        hit = order == _codes(planes.sides(there, t))[:, None]
        reached = np.where(hit.any(axis=1), np.minimum(reached, hit.argmax(axis=1) + 1), reached)
    need = np.sort(reached)[max(0, int(np.ceil(recall * len(reached))) - 1)]
    if need > 1 << NEAR_PLANES:
        raise ValueError(f"a recall of {recall} is out of reach of {planes.tables} tables; take more tables or larger cells")
    return int(need)
