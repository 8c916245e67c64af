"""Near duplicates among embeddings: a pigeonhole join over blocks of rotated vectors, verified exactly."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import cut_lineage
from .common import components, pair_tiles, spread_join, table
from .registry import query

THRESHOLD = 0.98
# Blocks of a vector, and the leading coordinates of a block that make its grid.
BLOCKS = 16
GRID_DIMS = 4
SEED = 7
# Rows of one side that are compared at a time.
ROWS = 256
# A cell with more rows is not searched for promising ones, and is verified in tiles of its parts.
CELL_ROWS = 8192
TILE_ROWS = 512
# Slack of the budgets against rounding, and wider slack of the grid.
TIGHT, WIDE = 1e-6, 1e-3
_OFFSETS = np.array([o for o in itertools.product((-1, 0, 1), repeat=GRID_DIMS) if o >= (0,) * GRID_DIMS], np.int64)


@lru_cache(maxsize=8)
def plan(dim: int, threshold: float) -> tuple[np.ndarray, list[slice], np.ndarray]:
    """Rotation, blocks, and the squared-distance budget of each block.

    Unit vectors with a cosine of at least the threshold have a squared
    distance of at most 2 - 2 * threshold.  Each block's share of it follows
    its number of coordinates; a linked pair keeps within it in some block.
    """
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dim, dim)))
    n = max(1, min(BLOCKS, dim // GRID_DIMS))
    cuts = [dim * k // n for k in range(n + 1)]
    blocks = [slice(a, b) for a, b in zip(cuts, cuts[1:])]
    budgets = np.array([(2 - 2 * threshold) * (b.stop - b.start) / dim for b in blocks]) + 1e-12
    return q * np.sign(np.diag(r)), blocks, budgets


def rotated(x: np.ndarray, threshold: float) -> np.ndarray:
    return (x / np.linalg.norm(x, axis=1, keepdims=True)) @ plan(x.shape[1], threshold)[0]


def _mix(h: np.ndarray, value: np.ndarray) -> np.ndarray:
    h = (h ^ value.astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _vectors(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(positions, matrix) for each number of coordinates among the vectors of a batch."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    begins = np.concatenate(([0], np.cumsum(sizes)[:-1])) if len(sizes) else sizes
    out = []
    for dim in np.unique(sizes):
        at = np.flatnonzero(sizes == dim)
        out.append((at, flat[begins[at][:, None] + np.arange(dim)].astype(float)))
    return out


def visits(reps: DataFrame, threshold: float) -> DataFrame:
    """Grid cells of every block of every vector: its own, and those after it that a ball of the block's budget meets.

    A cell is as wide as the ball.  Two vectors within a block's budget meet
    in exactly one cell of it that is the own cell of one of them.  A row also
    has the block's leading coordinates and the lengths of all blocks, whose
    differences bound the distance from below.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, labels = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)
            for at, x in _vectors(b.column(2)):
                dim = x.shape[1]
                _, blocks, budgets = plan(dim, threshold)
                y = rotated(x, threshold)
                norms = np.zeros((len(at), BLOCKS), np.uint8)
                for k, block in enumerate(blocks):
                    norms[:, k] = np.floor(np.linalg.norm(y[:, block], axis=1) * 254)
                packed = norms.view(np.int64)
                for k, block in enumerate(blocks):
                    lead = np.zeros((len(at), GRID_DIMS))
                    part = y[:, block][:, :GRID_DIMS]
                    lead[:, : part.shape[1]] = part
                    limit = budgets[k] * (1 + WIDE)
                    width = 2 * np.sqrt(limit)
                    home = np.floor(lead / width).astype(np.int64)
                    low = lead - home * width
                    costs = np.stack((low**2, np.zeros_like(low), (width - low) ** 2), axis=2)
                    total = sum(costs[:, d, _OFFSETS[:, d] + 1] for d in range(GRID_DIMS))
                    row, which = np.nonzero(total <= limit)
                    h = _mix(_mix(np.zeros(len(row), np.uint64), np.full(len(row), dim * BLOCKS + k + 1)), labels[at][row])
                    for d in range(GRID_DIMS):
                        h = _mix(h, home[row, d] + _OFFSETS[which, d])
                    f = lead[row].astype(np.float32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h.view(np.int64)), pa.array(ids[at][row]), pa.array(labels[at][row].astype(np.int64)),
                         pa.array(np.where((_OFFSETS[which] == 0).all(axis=1), k, -1 - k).astype(np.int32)), pa.array(np.full(len(row), limit)),
                         *[pa.array(f[:, d]) for d in range(GRID_DIMS)], *[pa.array(packed[row, d]) for d in range(2)]],
                        ["cell", "id", "label", "place", "budget", *[f"y{d}" for d in range(GRID_DIMS)], "norms0", "norms1"],
                    )

    return reps.select("id", "label", "x").mapInArrow(
        run, "cell long, id long, label long, place int, budget double, y0 float, y1 float, y2 float, y3 float, norms0 long, norms1 long"
    )


def by_cell(find, most: int | None = None, passed=None):
    """Run `find` on the columns of each cell with two rows or more; batches come sorted by their first column.

    With `most`, no cell of more rows is held: what has come of it, and all
    that follows, goes on batch by batch through `passed`.
    """

    def groups(columns: list) -> Iterator:
        keys = columns[0]
        begins = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        sizes = np.diff(np.concatenate((begins, [len(keys)])))
        for at in np.flatnonzero(sizes > 1):
            yield from find(*(c[begins[at] : begins[at] + sizes[at]] for c in columns))

    def columns_of(batches: list[pa.RecordBatch]) -> list:
        whole = pa.Table.from_batches(batches).combine_chunks()
        return [c.chunk(0) if pa.types.is_list(c.type) else c.to_numpy(zero_copy_only=False) for c in whole.columns] if whole.num_rows else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        through = None  # the cell that is passed on
        for b in batches:
            if through is not None and b.num_rows:
                end = int(np.searchsorted(b.column(0).to_numpy(), through, side="right"))
                if end:
                    yield passed(b.slice(0, end))
                b = b.slice(end)
                through = None if b.num_rows else through
            if not b.num_rows:
                continue
            keys = b.column(0).to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))  # the last cell may go on in the next batch
            if cut == 0 and (not held or held[-1].column(0)[-1].as_py() == keys[0]):
                held.append(b)
                if most is not None and sum(x.num_rows for x in held) > most:
                    yield from map(passed, held)
                    held, through = [], keys[-1]
                continue
            yield from groups(columns_of([*held, b.slice(0, cut)]))
            held = [b.slice(cut)]
        if held:
            yield from groups(columns_of(held))

    return run


def _promising(threshold: float, most: int):
    """Members of a cell that may have a partner in it, by the block's leading coordinates and the lengths of all blocks.

    All members of a very large cell count as promising: they are left to the
    exact step, which splits it, and go on without being held.
    """
    bound = 2 - 2 * threshold + 1e-6

    def find(cell, ids, labels, place, budget, y0, y1, y2, y3, norms0, norms1):
        home = np.flatnonzero(place >= 0)
        if not len(home):
            return
        if len(cell) > most:
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(ids), pa.array(place)], ["cell", "id", "place"])
            return
        y = np.stack((y0, y1, y2, y3), axis=1).astype(np.float64)
        norms = np.ascontiguousarray(np.stack((norms0, norms1), axis=1)).view(np.uint8).astype(np.int16)
        block = np.where(place >= 0, place, -1 - place)
        found = np.zeros(len(cell), bool)
        for start in range(0, len(home), ROWS):
            h = home[start : start + ROWS]
            near = ((y[h, None, :] - y[None, :, :]) ** 2).sum(axis=2) <= budget[h, None]
            near &= (labels[h, None] == labels[None, :]) & (block[h, None] == block[None, :])
            near[np.arange(len(h)), h] = False
            i, j = np.nonzero(near)
            gap = np.maximum(np.abs(norms[h[i]] - norms[j]) - 1, 0) / 254.0
            good = (gap**2).sum(axis=1) <= bound
            found[h[i[good]]] = True
            found[j[good]] = True
        if found.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell[found]), pa.array(ids[found]), pa.array(place[found])], ["cell", "id", "place"]
            )

    def passed(b: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(3)], ["cell", "id", "place"])

    return by_cell(find, most, passed)


def _verified(threshold: float):
    """Exact links of a cell, or of a tile of a large cell: counts for each member, and links enough to connect what is linked.

    A pair is counted in the first block whose budget it keeps, so once over
    all cells.
    """

    def find(tile, ids, place, part, cross, weights, labels, x):
        block = np.where(place >= 0, place, -1 - place)
        for at, matrix in _vectors(x):
            _, blocks, budgets = plan(matrix.shape[1], threshold)
            budgets = budgets * (1 + TIGHT)
            unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
            y = rotated(matrix, threshold)
            home = np.flatnonzero(place[at] >= 0)
            counted = np.zeros(len(at), np.int64)
            group = np.arange(len(at))
            left, right = [], []
            for start in range(0, len(home), ROWS):
                h = home[start : start + ROWS]
                linked = unit[h] @ unit.T >= threshold
                linked &= (labels[at][h, None] == labels[at][None, :]) & (block[at][h, None] == block[at][None, :])
                linked &= ~cross[at][h, None] | (part[at][h, None] != part[at][None, :])
                linked[np.arange(len(h)), h] = False
                for i, row in zip(h, linked):
                    near = np.flatnonzero(row)
                    for root in np.unique(group[near]):
                        if root != group[i]:
                            left.append(ids[at[i]])
                            right.append(ids[at[near[group[near] == root][0]]])
                            group[group == root] = group[i]
                # The pair of two home members is seen from both; the others once.
                i, j = np.nonzero(linked)
                mine = np.ones(len(i), bool)
                own = block[at][h[i]]
                for b in range(own.max(initial=-1) + 1):
                    if not mine.any():
                        break
                    d = ((y[h[i[mine]], blocks[b]] - y[j[mine], blocks[b]]) ** 2).sum(axis=1)
                    k = own[mine]
                    mine[mine] = np.where(b < k, d > budgets[b], (b > k) | (d <= budgets[b]))
                i, j = h[i[mine]], j[mine]
                np.add.at(counted, i, weights[at][j])
                other = place[at][j] < 0
                np.add.at(counted, j[other], weights[at][i[other]])
            some = counted > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate((ids[at][some], np.array(left, np.int64)))),
                 pa.array([None] * int(some.sum()) + [int(v) for v in right], pa.int64()),
                 pa.array(np.concatenate((counted[some], np.zeros(len(left), np.int64))))],
                ["a", "b", "links"],
            )

    return by_cell(find)


def label_codes(rows: DataFrame) -> DataFrame:
    """`rows` (id, label, x) with a whole number for each distinct label: the smallest id that has it."""
    known = rows.filter(F.col("label").isNotNull() & F.col("id").isNotNull()).groupBy("label").agg(
        F.min("id").alias("code"), F.count(F.lit(1)).alias("n")
    )
    total = rows.agg(F.count(F.lit(1))).first()[0]
    coded = spread_join(rows, known, ["label"], "n", total, ["id"])
    return coded.select("id", F.col("code").alias("label"), "x")


def groups(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, n_links, component) for each row of `vectors`; ids are integers and unique.

    Vectors link if their labels are equal and not null and their cosine in
    double precision reaches the threshold.  Null vectors, zero vectors and
    those with null or non-finite components, like rows without an id or
    label, link with nothing: no links, their own id as component.  Labels of
    any type that can be grouped are compared as they are.  Equal vectors are one node with a weight, so copies never make pairs.
    """
    x = F.col(vector_col).cast("array<double>")
    sound = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("x", lambda v: v != 0)
    whole = vectors.schema[label_col].dataType.typeName() in ("byte", "short", "integer", "long")
    label = F.col(label_col).cast("long") if whole else F.col(label_col)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), label.alias("label"), x.alias("x"))
    rows = rows if whole else label_codes(rows)
    rows = rows.withColumn("sound", F.coalesce(F.col("x").isNotNull() & F.col("label").isNotNull() & F.col("id").isNotNull() & sound, F.lit(False)))
    rows = cut_lineage(rows)
    nodes = cut_lineage(rows.filter("sound").groupBy("label", "x").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n")))
    total = nodes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    reps = nodes.withColumnRenamed("rep", "id")
    met = visits(reps, threshold).repartition("cell").sortWithinPartitions("cell")
    members = met.mapInArrow(_promising(threshold, CELL_ROWS), "cell long, id long, place int")
    tiled = pair_tiles(cut_lineage(members), "cell", "id", TILE_ROWS)
    full = tiled.join(reps.select("id", "n", "label", "x"), "id").select("tile", "id", "place", "part", "cross", "n", "label", "x")
    found = full.repartition("tile").sortWithinPartitions("tile").mapInArrow(_verified(threshold), "a long, b long, links long")
    found = cut_lineage(found)
    counts = found.filter("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    stars = components(found.filter("b IS NOT NULL").select("a", "b").distinct())
    known = nodes.join(counts, "rep", "left").join(stars, F.col("rep") == F.col("node"), "left").select(
        "label", "x", "n", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "rep").alias("component")
    )
    out = spread_join(rows.filter("sound"), known, ["label", "x"], "n", total, ["id"]).select("id", "n_links", "component")
    return out.unionByName(rows.filter("NOT sound").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component")))


OP6_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR isnan(e) OR isinf(e))) = 0
    AND len(list_filter(embedding, lambda e: e <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.x, b.x) >= 0.98),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
comp AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
deg AS (SELECT a AS vec_id, count(*) AS n_links FROM link GROUP BY a)
SELECT e.vec_id, coalesce(n_links, 0)::bigint AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN comp USING (vec_id) LEFT JOIN deg USING (vec_id)
"""


@query("op6_embedding_near_dedup", OP6_SQL)
def op6(spark: SparkSession, sf: str) -> DataFrame:
    return groups(table(spark, sf, "embeddings")).select(
        F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), (F.col("id") == F.col("component")).alias("kept")
    )
