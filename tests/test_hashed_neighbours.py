import numpy as np
import pytest
from pyspark.sql import functions as F

from covaria.operators import hashed_neighbours as hashed, neighbours

NAMES = [f"f{i}" for i in range(12)]
SCHEMA = "key long, " + ", ".join(f"{n} double" for n in NAMES)


def _clustered(spark, n, seed=0, clusters=40):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(clusters, len(NAMES)))
    values = centres[draw.integers(0, clusters, n)] + 0.15 * draw.normal(size=(n, len(NAMES)))
    return spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(values)], SCHEMA), values


def _pairs(df):
    return {(r["query"], r["neighbour"]) for r in df.collect()}


def test_recall_is_reached_and_candidates_stay_few(spark):
    rows, values = _clustered(spark, 4000)
    asked = rows.filter("key % 20 = 0")
    planes = hashed.fit_planes(rows, NAMES, tables=6, cell_rows=64)
    visits = hashed.visits_for(asked, rows, NAMES, 5, planes, 0.95, skip_self=True)
    got = hashed.nearest_hashed(asked, rows, NAMES, 5, planes, visits, skip_self=True).cache()
    exact = neighbours.nearest(asked, rows, NAMES, 5, skip_self=True)
    want = _pairs(exact)
    assert len(_pairs(got) & want) >= 0.9 * len(want)
    # Distances are true, positions run from the nearest, no row is its own neighbour.
    for r in got.limit(50).collect():
        assert r["distance2"] == pytest.approx(((values[r["query"]] - values[r["neighbour"]]) ** 2).sum())
        assert r["query"] != r["neighbour"]
    assert got.groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.max("position").alias("p")).filter("n <> 5 or p <> 4").count() == 0
    # Rows that share a visited cell with a query, over all tables.
    met = [set() for _ in range(0, 4000, 20)]
    for t in range(planes.tables):
        codes = hashed._codes(planes.sides(values, t))
        seen = hashed._visited(planes.sides(values[::20], t), visits)
        for i, cells in enumerate(seen):
            met[i] |= set(np.flatnonzero(np.isin(codes, cells)).tolist())
    assert np.mean([len(m) for m in met]) < 0.25 * len(values)


def test_all_cells_visited_is_exact_with_ties_copies_and_crowded_cells(spark):
    rows, _ = _clustered(spark, 300, seed=3)
    # A third of the rows are copies of one: they share a cell, which is cut into blocks and lanes.
    copies = spark.range(1000, 1150).select(F.col("id").alias("key"), *[F.lit(0.5).alias(n) for n in NAMES])
    both = rows.unionAll(copies)
    planes = hashed.fit_planes(both, NAMES, tables=2, cell_rows=60)
    got = hashed.nearest_hashed(both, both, NAMES, 4, planes, 1 << 10, skip_self=True, block_rows=40)
    want = neighbours.nearest(both, both, NAMES, 4, skip_self=True)
    columns = ["query", "neighbour", "position"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect()))


def test_visits_come_nearest_first_and_each_cell_once():
    sides = np.array([[0.1, -0.5, 0.3], [-2.0, 1.0, 0.2]])
    order = hashed._visited(sides, 8)
    assert [sorted(r) for r in order.tolist()] == [list(range(8))] * 2
    own = hashed._codes(sides)
    assert order[:, 0].tolist() == own.tolist()
    assert order[0, 1] == own[0] ^ 1 and order[0, 2] == own[0] ^ 4 and order[1, 1] == own[1] ^ 4


def test_missing_values_and_empty_tables(spark):
    rows, _ = _clustered(spark, 50, seed=5)
    gaps = spark.createDataFrame([(900, None, *[0.0] * 11), (901, float("nan"), *[0.0] * 11)], SCHEMA)
    planes = hashed.fit_planes(rows.unionAll(gaps), NAMES, tables=2, cell_rows=10)
    got = hashed.nearest_hashed(rows.unionAll(gaps), rows.unionAll(gaps), NAMES, 3, planes, 64)
    assert got.filter("query >= 900 or neighbour >= 900").count() == 0 and got.select("query").distinct().count() == 50
    none = rows.limit(0)
    flat = hashed.fit_planes(none, NAMES)
    assert hashed.nearest_hashed(rows, none, NAMES, 3, flat, 1).count() == 0
    assert hashed.nearest_hashed(none, rows, NAMES, 3, planes, 2).count() == 0
    assert hashed.visits_for(none, rows, NAMES, 3, planes) == 1


def test_a_recall_out_of_reach_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(hashed, "NEAR_PLANES", 1)
    draw = np.random.default_rng(1).normal(size=(600, 12))
    rows = spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(draw)], SCHEMA)
    planes = hashed.fit_planes(rows, NAMES, tables=1, cell_rows=4)
    with pytest.raises(ValueError, match="out of reach"):
        hashed.visits_for(rows, rows, NAMES, 5, planes, 0.99, skip_self=True)
