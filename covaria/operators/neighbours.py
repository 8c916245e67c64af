"""Exact k nearest neighbours.

Of reference rows at one place only the first k keys can be neighbours, so the
others are left out first.  A reference table of proven small size is shipped
to the tasks once.  A larger one is cut into cells by planes through the
medians of a sample, and big cells into blocks.  A query is first compared with
a block of its own cell, which bounds its k-th distance; then with those cells
only whose box is not farther than that.  Inside a task few features are
searched by a tree of medians, many by matrix products whose hits are measured
again exactly.  Both ways are exact, and neither forms all pairs as rows.
Queries and references with a missing or endless value have no neighbours.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import cut_lineage
from .joins import fits, is_small, lookup_join
from .ranks import with_row_key

# Tasks get this module's helpers with the closure, whether or not the package
# is installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Values (rows x features) of a reference that may be shipped to every task.
SHIPPED_VALUES = 500_000
# At least so many cells of a large reference, where it has the rows for them.
PIVOTS = 16
# A block of a cell has about so many rows, or more where a table would be cut into over PIECES blocks, but then not over
# MOST_ROWS and BLOCK_VALUES values.
BLOCK_ROWS = 20_000
MOST_ROWS = 32_768
BLOCK_VALUES = 2_000_000
PIECES = 64
# The sample that places the planes: rows, values, and rows for each cell.
SAMPLE_ROWS = 131_072
SAMPLE_VALUES = 1_000_000
SAMPLE_CELL = 16
# Partitions of a round of comparisons.
_MOST_TASKS = 2048
# Up to so many features a tree inside a task tells rows apart.
TREE_WIDTH = 12
_LEAF = 64
# Distances that a task holds at a time, and values of the rows that it sends on at a time.
_CHUNK = 1_000_000
_SENT_VALUES = 500_000


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Pairwise squared distances, feature by feature: exact zeros for equal rows."""
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        gap = a[:, j, None] - b[None, :, j]
        out += gap * gap
    return out


def _paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of `a` to the same rows of `b`, with the sums of `_squared`."""
    out = np.zeros(len(a))
    for j in range(a.shape[1]):
        gap = a[:, j] - b[:, j]
        out += gap * gap
    return out


def _to_boxes(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances of points to boxes, never above that of any row in the box."""
    out = np.zeros((len(a), len(low)))
    for j in range(a.shape[1]):
        gap = np.maximum(np.maximum(low[None, :, j] - a[:, j, None], a[:, j, None] - high[None, :, j]), 0.0)
        out += gap * gap
    return out


def _kth(d: np.ndarray, k: int) -> np.ndarray:
    """The k-th smallest of each row, infinite where there are fewer."""
    return np.partition(d, k - 1, axis=1)[:, k - 1] if d.shape[1] >= k else np.full(len(d), np.inf)


def _first(qi: np.ndarray, ri: np.ndarray, d: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k first pairs of each query by distance, then place of the reference."""
    fine = np.isfinite(d)
    qi, ri, d = qi[fine], ri[fine], d[fine]
    order = np.lexsort((ri, d, qi))
    qi, ri, d = qi[order], ri[order], d[order]
    starts = np.flatnonzero(np.r_[True, qi[1:] != qi[:-1]]) if len(qi) else np.zeros(0, np.int64)
    rank = np.arange(len(qi)) - np.repeat(starts, np.diff(np.r_[starts, len(qi)]))
    keep = rank < k
    return qi[keep], ri[keep], d[keep]


def _measured(q: np.ndarray, r: np.ndarray, qi: np.ndarray, ri: np.ndarray) -> np.ndarray:
    """Squared distances of pairs given by place; the rows of few pairs are copied at a time."""
    step = max(1, _CHUNK // max(q.shape[1], 1))
    parts = [_paired(q[qi[i : i + step]], r[ri[i : i + step]]) for i in range(0, len(qi), step)]
    return np.concatenate(parts) if parts else np.zeros(0)


def _by_products(q: np.ndarray, qc: np.ndarray, bound: np.ndarray, r: np.ndarray, rc: np.ndarray, k: int):
    """Candidates by matrix products: all pairs not farther than the bound or the k-th, with a slack for rounding."""
    middle = r.mean(axis=0)
    qm, rm = q - middle, r - middle
    rr = (rm * rm).sum(axis=1)
    step = max(1, _CHUNK // len(r))
    for start in range(0, len(q), step):
        part = qm[start : start + step]
        qq = (part * part).sum(axis=1)
        d = part @ rm.T
        d *= -2.0
        d += qq[:, None]
        d += rr[None, :]
        d[qc[start : start + step, None] == rc[None, :]] = np.inf
        limit = bound[start : start + step]
        if np.isinf(limit).any():
            limit = np.minimum(limit, _kth(d, k))
        slack = (qq + rr.max()) * (4.0 * (q.shape[1] + 8) * np.finfo(float).eps)
        near = d <= (limit * (1 + 1e-12) + 2 * slack)[:, None]
        # A far bound would let most of a crowded block pass.
        if np.count_nonzero(near) > 8 * k * len(d):
            near &= d <= (np.minimum(limit, _kth(d, k)) * (1 + 1e-12) + 2 * slack)[:, None]
        at, ri = np.nonzero(near)
        qi = at + start
        yield qi, ri, _measured(q, r, qi, ri)


def _leaves(r: np.ndarray, depth: int) -> tuple[list[tuple[int, float]], np.ndarray]:
    """A complete tree of medians: (feature, value) of each inner node, and the leaf of each row."""
    nodes: list[tuple[int, float]] = []
    rows = [np.arange(len(r))]
    for _ in range(depth):
        below = []
        for part in rows:
            v = r[part]
            feature = int(np.argmax(v.max(axis=0) - v.min(axis=0))) if len(part) else 0
            value = float(np.median(v[:, feature])) if len(part) else 0.0
            left = v[:, feature] < value
            # Where the median is also the least value, the other side gets what is above.
            if len(part) and not left.any():
                above = v[:, feature][v[:, feature] > value]
                value = float(above.min()) if len(above) else value
                left = v[:, feature] < value
            nodes.append((feature, value))
            below += [part[left], part[~left]]
        rows = below
    leaf = np.zeros(len(r), np.int64)
    for i, part in enumerate(rows):
        leaf[part] = i
    return nodes, leaf


def _descend(q: np.ndarray, nodes: Sequence[tuple[int, float]]) -> np.ndarray:
    """The leaf of each row."""
    at = np.zeros(len(q), np.int64)
    if not len(nodes):
        return at
    feature, value = np.array([f for f, _ in nodes], np.int64), np.array([v for _, v in nodes])
    for level in range(int(np.log2(len(nodes) + 1))):
        node = at + ((1 << level) - 1)
        at = 2 * at + (q[np.arange(len(q)), feature[node]] >= value[node])
    return at


def _runs(of: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(value, places) for each value of an array of whole numbers."""
    order = np.argsort(of, kind="stable")
    ends = np.flatnonzero(np.diff(of[order])) + 1
    for part in np.split(order, ends) if len(order) else []:
        yield int(of[part[0]]), part


def _by_tree(q: np.ndarray, qc: np.ndarray, bound: np.ndarray, r: np.ndarray, rc: np.ndarray, k: int):
    """Candidates by a tree of medians: a query's own leaf bounds its k-th distance, then all leaves that near are read."""
    nodes, leaf = _leaves(r, max(0, int(np.ceil(np.log2(len(r) / max(_LEAF, 2 * k))))))
    rows = dict(_runs(leaf))
    ids = np.array(sorted(rows))
    low, high = np.array([r[rows[i]].min(axis=0) for i in ids]), np.array([r[rows[i]].max(axis=0) for i in ids])

    def measured(queries: np.ndarray, there: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        step = max(1, _CHUNK // len(there))
        for start in range(0, len(queries), step):
            some = queries[start : start + step]
            d = _squared(q[some], r[there])
            d[qc[some, None] == rc[None, there]] = np.inf
            yield some, d

    limit = bound.copy()
    open_ends = np.flatnonzero(np.isinf(bound))
    for i, places in _runs(_descend(q[open_ends], nodes)):
        if i in rows:
            for some, d in measured(open_ends[places], rows[i]):
                limit[some] = np.minimum(limit[some], _kth(d, k))
    step = max(1, _CHUNK // len(ids))
    for begin in range(0, len(q), step):
        near = _to_boxes(q[begin : begin + step], low, high) <= limit[begin : begin + step, None]
        at, met = np.nonzero(near)
        for i, places in _runs(met):
            for some, d in measured(at[places] + begin, rows[int(ids[i])]):
                qi, ri = np.nonzero(d <= limit[some, None])
                yield some[qi], rows[int(ids[i])][ri], d[qi, ri]


def _search(q: np.ndarray, qc: np.ndarray, bound: np.ndarray, r: np.ndarray, rc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query place, reference place, squared distance) of the k nearest not farther than `bound`, by query and distance,
    ties by place.  Pairs whose codes are equal are none."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    if not len(q) or not len(r):
        return none
    found, held, most = [], 0, 2 * _CHUNK
    for part in (_by_tree if q.shape[1] <= TREE_WIDTH else _by_products)(q, qc, bound, r, rc, k):
        found.append(part)
        held += len(part[0])
        # What a far bound lets pass does not pile up: k pairs of a query are enough.
        if held > most:
            found = [_first(*[np.concatenate(c) for c in zip(*found)], k)]
            held = len(found[0][0])
            most = held + 2 * _CHUNK
    return _first(*[np.concatenate(c) for c in zip(*found)], k) if found else none


def _codes(q_key: pa.Array, r_key: pa.Array, skip_self: bool) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers that are equal where keys are; none are where rows may be their own neighbours, or for null keys."""
    if not skip_self:
        return np.full(len(q_key), -1, np.int64), np.full(len(r_key), -2, np.int64)
    codes = pa.concat_arrays([q_key, r_key.cast(q_key.type)]).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    q, r = codes[: len(q_key)].copy(), codes[len(q_key) :].copy()
    q[q < 0], r[r < 0] = -1, -2
    return q, r


def _nearest(
    q: np.ndarray, q_key: np.ndarray, r: np.ndarray, r_key: np.ndarray, k: int, skip_self: bool
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query position, reference positions, squared distances), ties by key order.

    `r` must be sorted by key, so that ties by place are ties by key.
    """
    qc, rc = _codes(pa.array(q_key, from_pandas=True), pa.array(r_key, from_pandas=True), skip_self)
    qi, ri, d = _search(q, qc, np.full(len(q), np.inf), r, rc, k)
    for i, places in _runs(qi):
        yield i, ri[places], d[places]


def _is_finite() -> Column:
    return ~F.exists("values", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def _finite(df: DataFrame) -> DataFrame:
    return df.filter(_is_finite())


def _place(features: Sequence[str]) -> Column:
    # Minus zero and zero are one place.
    return F.array(*[F.col(f).cast("double") + F.lit(0.0) for f in features])


def _narrow(df: DataFrame, key: str, features: Sequence[str], key_name: str, *more: Column) -> DataFrame:
    return _finite(df.select(F.col(key).alias(key_name), _place(features).alias("values"), *more))


def _foremost(reference: DataFrame, k: int, skip_self: bool) -> DataFrame:
    """The rows that can be neighbours: of those at one place the k first by key, or all of the first k + 1 keys.

    Spark keeps so many of each task's rows only, so that a crowded place is no large group.
    """
    # The hash in front spares the sort most comparisons of lists.
    over = Window.partitionBy(F.xxhash64("values"), "values").orderBy(F.col("neighbour").asc_nulls_last())
    rank, most = (F.dense_rank(), k + 1) if skip_self else (F.row_number(), k)
    return reference.withColumn("_r", rank.over(over)).filter(F.col("_r") <= most).drop("_r")


def _pairs_schema(q_type: T.DataType, r_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("query", q_type),
            T.StructField("neighbour", r_type),
            T.StructField("distance2", T.DoubleType()),
        ]
    )


def _emit(q_key, r_key, found) -> pd.DataFrame:
    qs, rs, ds = [], [], []
    for i, near, dist in found:
        qs.append(np.repeat(q_key[i : i + 1], len(near)))
        rs.append(r_key[near])
        ds.append(dist)
    if not qs:
        return pd.DataFrame({"query": q_key[:0], "neighbour": r_key[:0], "distance2": np.zeros(0)})
    return pd.DataFrame(
        {"query": np.concatenate(qs), "neighbour": np.concatenate(rs), "distance2": np.concatenate(ds)}
    )


def _column(table: pa.Table | pa.RecordBatch, name: str) -> pa.Array:
    found = table.column(name)
    if isinstance(found, pa.ChunkedArray):
        found = found.chunk(0) if found.num_chunks == 1 else pa.concat_arrays(found.chunks) if found.num_chunks else pa.array([], found.type)
    return found


def _values(table: pa.Table | pa.RecordBatch, width: int) -> np.ndarray:
    return _column(table, "values").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _by_key(table: pa.Table) -> pa.Table:
    return table.sort_by([("neighbour", "ascending")])


def _lists(n: int, qi: np.ndarray, near: pa.Array, d: np.ndarray) -> list[pa.Array]:
    """The neighbours and distances of each of `n` queries as two columns of lists; `qi` ascends."""
    ends = pa.array(np.searchsorted(qi, np.arange(n + 1)).astype(np.int32))
    return [pa.ListArray.from_arrays(ends, near), pa.ListArray.from_arrays(ends, pa.array(d))]


def _found_schema(q_field: T.StructField, r_field: T.StructField, *more: T.StructField) -> T.StructType:
    return T.StructType([
        T.StructField("query", q_field.dataType), *more,
        T.StructField("near", T.ArrayType(r_field.dataType)), T.StructField("dist", T.ArrayType(T.DoubleType())),
    ])


def _shipped(queries: DataFrame, reference: DataFrame, width: int, k: int, skip_self: bool) -> DataFrame:
    local = _by_key(reference.toArrow().combine_chunks())  # size checked by the caller
    sent = queries.sparkSession.sparkContext.broadcast((_column(local, "neighbour"), _values(local, width)))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r_key, r = sent.value
        for batch in batches:
            q = _values(batch, width)
            qc, rc = _codes(batch.column("query"), r_key, skip_self)
            qi, ri, d = _search(q, qc, np.full(len(q), np.inf), r, rc, k)
            yield pa.RecordBatch.from_arrays([batch.column("query"), *_lists(len(q), qi, r_key.take(pa.array(ri)), d)], ["query", "near", "dist"])

    return queries.mapInArrow(search, _found_schema(queries.schema["query"], reference.schema["neighbour"]))


class _Cells:
    """Cells of the reference as arrays by cell: rows, box, blocks; and the planes between them."""

    def __init__(self, nodes: Sequence[tuple[int, float]], width: int):
        self.nodes, self.count, self.width = list(nodes), len(nodes) + 1, width
        self.feature, self.value = np.array([f for f, _ in nodes], np.int64), np.array([v for _, v in nodes])

    def of(self, values: np.ndarray) -> np.ndarray:
        return _descend(values, self.nodes)

    def fill(self, rows: Sequence, size: int) -> None:
        """From (cell, n, low, high), with blocks of about `size` rows."""
        self.rows = np.zeros(self.count, np.int64)
        self.low, self.high = np.full((self.count, self.width), np.inf), np.full((self.count, self.width), -np.inf)
        for cell, n, low, high in rows:
            self.rows[cell], self.low[cell], self.high[cell] = n, low, high
        self.blocks = np.maximum(1, -(-2 * self.rows // (3 * size)))

    def _reach(self, q: np.ndarray, need: int) -> np.ndarray:
        """A distance within which the farthest corners of enough cells lie to hold `need` rows; endless if there are too few."""
        there = np.flatnonzero(self.rows)
        out = np.full(len(q), np.inf)
        step = max(1, _CHUNK // max(len(there), 1))
        for start in range(0, len(q), step):
            part = q[start : start + step]
            far = np.zeros((len(part), len(there)))
            for j in range(self.width):
                gap = np.maximum(np.abs(part[:, j, None] - self.low[there][None, :, j]), np.abs(part[:, j, None] - self.high[there][None, :, j]))
                far += gap * gap
            order = np.argsort(far, axis=1)
            held = np.cumsum(self.rows[there][order], axis=1) >= need
            some = held.any(axis=1)
            place = np.take_along_axis(order, held.argmax(axis=1)[:, None], axis=1)
            out[start : start + step][some] = np.take_along_axis(far, place, axis=1)[some, 0]
        return out

    def visited(self, q: np.ndarray, bound: np.ndarray, need: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query place, cell) for the cells that may hold a row not farther than the bound."""
        if not self.rows.any():
            return
        limit = bound.copy()
        endless = np.flatnonzero(np.isinf(limit))
        if len(endless):
            limit[endless] = self._reach(q[endless], need)
        # A hair of slack keeps rounding from cutting off a tie.
        limit = limit * (1 + 1e-9) + 1e-300
        step = max(1, _CHUNK // self.count)
        for start in range(0, len(q), step):
            at = np.arange(start, min(start + step, len(q)))
            node = np.zeros(len(at), np.int64)
            for level in range(int(np.log2(self.count))):
                inner = node + ((1 << level) - 1)
                gap = q[at, self.feature[inner]] - self.value[inner]
                right = (gap >= 0).astype(np.int64)
                across = gap * gap <= limit[at]
                node = np.concatenate([2 * node + right, (2 * node + 1 - right)[across]])
                at = np.concatenate([at, at[across]])
            some = self.rows[node] > 0
            at, node = at[some], node[some]
            near = np.zeros(len(at))
            for j in range(self.width):
                v = q[at, j]
                gap = np.maximum(np.maximum(self.low[node, j] - v, v - self.high[node, j]), 0.0)
                near += gap * gap
            some = near <= limit[at]
            yield at[some], node[some]


def _planes(reference: DataFrame, n: int, width: int, cells: int) -> _Cells:
    """Planes through the medians of a bounded sample, which only steers the partitioning."""
    most = min(SAMPLE_ROWS, max(SAMPLE_VALUES // width, SAMPLE_CELL))
    share = F.pmod(F.xxhash64("neighbour", "values"), F.lit(1 << 20)) < F.lit(-(-most * (1 << 20) // max(n, 1)))
    sample = _values(reference.filter(share).select("values").toArrow(), width)
    depth = int(np.ceil(np.log2(max(min(cells, len(sample) // SAMPLE_CELL if n > most else cells), 1))))
    return _Cells(_leaves(sample, depth)[0], width)


PIECE = ["cell", "block", "lane"]


def _by_cells(
    queries: DataFrame, reference: DataFrame, n: int, width: int, k: int, skip_self: bool, pivots: int, block_rows: int
) -> DataFrame:
    spark = queries.sparkSession
    size = max(block_rows, min(MOST_ROWS, max(1, BLOCK_VALUES // width), n // PIECES))
    cells = _planes(reference, n, width, max(pivots, n // size))
    q_field, r_field = T.StructField("query", queries.schema["query"].dataType), T.StructField("neighbour", reference.schema["neighbour"].dataType)
    numbers = [T.StructField(c, T.IntegerType()) for c in PIECE]
    values = T.StructField("values", T.ArrayType(T.DoubleType()))
    bound = T.StructField("bound", T.DoubleType())

    def sides(sent, name: str):
        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.append_column(name, pa.array(sent.of(_values(batch, width)).astype(np.int32)))

        return place

    placed = reference.mapInArrow(sides(cells, "cell"), T.StructType([*reference.schema.fields, numbers[0]]))
    corners = [f(F.col("values")[j]) for f in (F.min, F.max) for j in range(width)]
    # One row per cell.
    told = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *[c.alias(f"_{i}") for i, c in enumerate(corners)]).collect()
    cells.fill([(r[0], r[1], list(r)[2 : 2 + width], list(r)[2 + width :]) for r in told], size)
    sent = spark.sparkContext.broadcast(cells)
    need = k + (1 if skip_self else 0)

    def rounds(counted: DataFrame) -> tuple[np.ndarray, int]:
        """Lanes of each cell for this traffic, at most one count per cell; and how many pieces meet."""
        lanes = np.zeros(cells.count, np.int64)
        for r in counted.groupBy("cell").agg(F.sum("n").alias("n")).collect():
            lanes[r["cell"]] = -(-r["n"] // size)
        return lanes, int((lanes * cells.blocks).sum())

    def counts(asked: DataFrame, visits) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(sent.value.count, np.int64)
            for batch in batches:
                for _, cell in visits(batch):
                    total += np.bincount(cell, minlength=len(total))
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["cell", "n"])

        return asked.mapInArrow(run, "cell int, n long")

    def meeting(asked: DataFrame, names: Sequence[str], visits, lanes: np.ndarray, pieces: int, first: bool, meet, schema: T.StructType) -> DataFrame:
        """Queries and reference blocks by piece: each query in its lane of every block that it visits, each block in all lanes."""
        hashed = F.pmod(F.xxhash64("query", "values"), F.lit(1 << 30)).cast("int").alias("hash")

        def sent_on(batch: pa.RecordBatch, columns: Sequence[str], at: np.ndarray, where: Sequence[pa.Array]) -> Iterator[pa.RecordBatch]:
            # A row goes to many pieces: the copies of a whole batch at once would grow with the number of cells.
            rows, step = batch.select(columns), max(1, _SENT_VALUES // max(width, 1))
            for i in range(0, len(at), step):
                some = rows.take(pa.array(at[i : i + step]))
                yield pa.RecordBatch.from_arrays([*some.columns, *[w.slice(i, step) for w in where]], [*columns, *PIECE])

        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                mixed = _column(batch, "hash").to_numpy()
                home = None if first else _column(batch, "home").to_numpy()
                for at, cell in visits(batch):
                    blocks = np.ones(len(at), np.int64) if first else sent.value.blocks[cell]
                    block = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
                    at, cell = np.repeat(at, blocks), np.repeat(cell, blocks)
                    if not first:
                        new = (block > 0) | (home[at] != cell)
                        at, cell, block = at[new], cell[new], block[new]
                    where = [pa.array(x.astype(np.int32)) for x in (cell, block, mixed[at] % lanes[cell])]
                    yield from sent_on(batch, names, at, where)

        def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                cell = sent.value.of(_values(batch, width))
                block = _column(batch, "hash").to_numpy() % sent.value.blocks[cell]
                copies = np.where(block == 0, lanes[cell], 0) if first else lanes[cell]
                at = np.repeat(np.arange(len(cell)), copies)
                lane = np.arange(len(at)) - np.repeat(np.cumsum(copies) - copies, copies)
                where = [pa.array(x.astype(np.int32)) for x in (cell[at], block[at], lane)]
                yield from sent_on(batch, ["neighbour", "values"], at, where)

        tasks = min(_MOST_TASKS, max(1, 2 * pieces))
        kept = [asked.schema[c] for c in names]
        left = asked.select("*", hashed).mapInArrow(ask, T.StructType([*kept, *numbers])).repartition(tasks, *PIECE)
        known = reference.select("*", F.pmod(F.xxhash64("neighbour", "values"), F.lit(1 << 30)).cast("int").alias("hash"))
        right = known.mapInArrow(answer, T.StructType([r_field, values, *numbers])).repartition(tasks, *PIECE)
        return left.groupBy(*PIECE).cogroup(right.groupBy(*PIECE)).applyInArrow(meet, schema)

    def met(q: pa.Table, r: pa.Table, limit: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        r = _by_key(r)
        r_key = _column(r, "neighbour")
        qc, rc = _codes(_column(q, "query"), r_key, skip_self)
        qi, ri, d = _search(_values(q, width), qc, limit, _values(r, width), rc, k)
        return qi, r_key.take(pa.array(ri)), d

    def meet_home(q: pa.Table, r: pa.Table) -> pa.Table:
        qi, near, d = met(q, r, np.full(q.num_rows, np.inf))
        lists = _lists(q.num_rows, qi, near, d)
        last = np.full(q.num_rows, np.inf)
        held, place = np.bincount(qi, minlength=q.num_rows), np.searchsorted(qi, np.arange(q.num_rows))
        full = held == k
        last[full] = d[place[full] + k - 1]
        return pa.Table.from_arrays(
            [_column(q, "query"), _column(q, "values"), _column(q, "cell"), pa.array(last), *lists], ["query", "values", "home", "bound", "near", "dist"]
        )

    def meet_other(q: pa.Table, r: pa.Table) -> pa.Table:
        qi, near, d = met(q, r, _column(q, "bound").to_numpy())
        found = pa.Table.from_arrays([_column(q, "query"), *_lists(q.num_rows, qi, near, d)], ["query", "near", "dist"])
        return found.filter(pa.array(np.bincount(qi, minlength=q.num_rows) > 0))

    def at_home(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        cell = sent.value.of(_values(batch, width))
        yield np.arange(len(cell)), cell

    def elsewhere(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        return sent.value.visited(_values(batch, width), _column(batch, "bound").to_numpy(), need)

    lanes, pieces = rounds(counts(queries, at_home))
    home = T.StructField("home", T.IntegerType())
    # Read for the traffic and for the second round.
    begun = cut_lineage(meeting(
        queries, ["query", "values"], at_home, lanes, pieces, True, meet_home, _found_schema(q_field, r_field, values, home, bound)
    ))
    asked = begun.select("query", "values", "home", "bound")
    lanes2, pieces2 = rounds(counts(asked, elsewhere))
    others = meeting(
        asked, ["query", "values", "bound"], elsewhere, lanes2, pieces2, False, meet_other, _found_schema(q_field, r_field)
    )
    return begun.select("query", "near", "dist").unionByName(others)


def _best(
    queries: DataFrame, reference: DataFrame, width: int, k: int, skip_self: bool, shipped_values: int, pivots: int, block_rows: int
) -> DataFrame:
    """(query, _best): the k first (distance2, neighbour) of each query.  Both tables are narrow and the reference is stored."""
    n = reference.count()
    if n <= max(1, shipped_values // max(width, 1)):
        found = _shipped(queries, reference, width, k, skip_self)
    else:
        found = _by_cells(cut_lineage(queries), reference, n, width, k, skip_self, pivots, block_rows)
    return _merged(found.select("query", F.explode(F.arrays_zip("dist", "near")).alias("_one")).select(
        "query", F.struct(F.col("_one.dist").alias("distance2"), F.col("_one.near").alias("neighbour")).alias("_one")
    ), k)


def _merged(ones: DataFrame, k: int) -> DataFrame:
    return ones.groupBy("query").agg(F.slice(F.array_sort(F.collect_list("_one")), 1, k).alias("_best"))


def _exploded(best: DataFrame) -> DataFrame:
    return best.select("query", F.posexplode("_best").alias("position", "_one")).select(
        "query", F.col("_one.neighbour").alias("neighbour"), F.col("_one.distance2").alias("distance2"), "position"
    )


def nearest(
    queries: DataFrame,
    reference: DataFrame,
    features: Sequence[str],
    k: int,
    query_key: str = "key",
    reference_key: str = "key",
    skip_self: bool = False,
    shipped_values: int = SHIPPED_VALUES,
    pivots: int = PIVOTS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(query, neighbour, distance2, position): the k nearest, ties by key."""
    q = _narrow(queries, query_key, features, "query")
    # Read for the count, the sample, the boxes and two rounds.
    r = cut_lineage(_foremost(_narrow(reference, reference_key, features, "neighbour"), k, skip_self))
    return _exploded(_best(q, r, len(features), k, skip_self, shipped_values, pivots, block_rows))


def _repeated(df: DataFrame, key: str) -> DataFrame:
    """(_h): hashes of the keys that more than one row has; by chance also of others.  Partial counts meet, not rows."""
    counted = df.groupBy(F.xxhash64(key).alias("_h")).agg(F.count(F.lit(1)).alias("_n"))
    return cut_lineage(counted.filter("_n > 1").select("_h"))


def _with_hash(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn("_h", F.xxhash64(key))


def with_nearest_mean(
    df: DataFrame,
    reference: DataFrame,
    features: Sequence[str],
    k: int,
    key: str,
    label: str,
    output: str,
    shipped_values: int = SHIPPED_VALUES,
    pivots: int = PIVOTS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """`df` with the mean label of each row's k nearest.

    The same as `nearest` and `neighbour_mean` by key, but each place is
    searched once, and labels are looked up among the rows that can be
    neighbours.  A key of several rows has all their neighbours and all their
    labels: only these keys are looked up in the whole tables.
    """
    width = len(features)
    value = F.col(label).cast("double").alias("_label")
    r = cut_lineage(_foremost(_narrow(reference, key, features, "neighbour", value), k, False))
    rows = cut_lineage(df.select(F.col(key).alias("query"), _place(features).alias("values")))
    placed = rows.withColumn("values", F.when(_is_finite(), F.col("values")))
    places = with_row_key(placed.select("values").filter("values IS NOT NULL").distinct(), "query")
    best = cut_lineage(_best(places, r.select("neighbour", "values"), width, k, False, shipped_values, pivots, block_rows))

    labels = r.select("neighbour", "_label")
    often = _repeated(reference, key)
    count = r.count()
    if not often.isEmpty():
        whole = _with_hash(reference.select(F.col(key).alias("neighbour"), value), "neighbour")
        theirs = cut_lineage(whole.join(often, "_h", "left_semi").drop("_h"))
        labels = _with_hash(labels, "neighbour").join(often, "_h", "left_anti").drop("_h").unionByName(theirs)
        count += theirs.count()

    def means(found: DataFrame) -> DataFrame:
        return with_labels(_exploded(found), labels, count).groupBy("query").agg(F.avg("_label").alias(output))

    known = cut_lineage(places.join(means(best), "query").select(F.col("values").alias("_values"), output))
    asked = df.withColumn("values", _place(features)).withColumn("_values", F.when(_is_finite(), F.col("values"))).drop("values")
    probe = placed.select(F.col("values").alias("_values"))
    out = lookup_join(asked, known, ["_values"], bound=known.count(), probe=probe).drop("_values")
    out = out.withColumn(output, F.when(F.col(key).isNotNull(), F.col(output)))
    several = _repeated(rows, "query")
    if not several.isEmpty():
        some = cut_lineage(_with_hash(placed.filter("query IS NOT NULL"), "query").join(several, "_h", "left_semi").drop("_h"))
        at = places.withColumnRenamed("query", "_place").join(some, "values").select("query", "_place")
        ones = at.join(best.withColumnRenamed("query", "_place"), "_place").select("query", F.explode("_best").alias("_one"))
        theirs = some.select("query").distinct().join(means(_merged(ones, k)), "query", "left")
        theirs = theirs.select(F.col("query").alias(key), F.col(output).alias("_theirs"), F.lit(True).alias("_several"))
        out = out.join(theirs, key, "left").withColumn(output, F.when(F.col("_several"), F.col("_theirs")).otherwise(F.col(output)))
    return out.select(key, *[c for c in df.columns if c != key], output)


def with_labels(pairs: DataFrame, labels: DataFrame, bound: int | None = None) -> DataFrame:
    """Labels beside the pairs.  A row near to very many queries is a hot key, so labels of a proven size are broadcast;
    others leave a hot key to the runtime's skew handling, for finding it first would search all neighbours twice.  `bound` is a
    row count that `labels` cannot exceed; without it they are counted."""
    small = is_small(labels) if bound is None else fits(labels, bound)
    return pairs.join(F.broadcast(labels) if small else labels, "neighbour")


def neighbour_mean(pairs: DataFrame, reference: DataFrame, key: str, label: str) -> DataFrame:
    """(query, prediction): mean label of the neighbours."""
    labels = reference.select(F.col(key).alias("neighbour"), F.col(label).cast("double").alias("_label"))
    return with_labels(pairs, labels).groupBy("query").agg(F.avg("_label").alias("prediction"))


def neighbour_vote(pairs: DataFrame, reference: DataFrame, key: str, label: str) -> DataFrame:
    """(query, prediction, share): most frequent label, smallest label on ties."""
    labels = reference.select(F.col(key).alias("neighbour"), F.col(label).alias("_label"))
    counts = with_labels(pairs, labels).groupBy("query", "_label").agg(F.count(F.lit(1)).alias("_n"))
    # At most k labels per query.
    return counts.groupBy("query").agg(
        F.max_by("_label", F.struct(F.col("_n"), -F.col("_label"))).alias("prediction"),
        (F.max("_n") / F.sum("_n")).alias("share"),
    )
