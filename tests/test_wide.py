"""Wide tables: cross products in blocks, all subsets scored by one matrix product."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from covaria.operators import gram, ranking, split


@pytest.fixture(scope="module")
def wide(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((600, 40)) + 1e4
    y = x[:, :5] @ [3.0, -2.0, 1.0, 0.5, 0.2] + rng.laplace(size=600)
    columns = [f"f{i}" for i in range(40)]
    table = pd.DataFrame(x, columns=columns).assign(target=y, key=[f"k{i}" for i in range(600)])
    return split.assign_folds(spark.createDataFrame(table).repartition(5), "key", 3).cache(), columns


@pytest.mark.parametrize("block", [7, 64])
def test_blocks_give_the_whole_matrix(wide, monkeypatch, block):
    monkeypatch.setattr(gram, "BLOCK", block)
    df, columns = wide
    table = df.toPandas()
    for weight in (None, "w"):
        found = gram.moments(df.withColumn("w", F.col("fold") + 1.5), columns, by="fold", weight=weight, method="batched")
        for fold, m in found.items():
            x = table[table.fold == fold][[*columns, "target"]].to_numpy()
            w = 1.0 if weight is None else fold + 1.5
            assert m.n == pytest.approx(len(x) * w) and np.allclose(m.mean, x.mean(axis=0))
            assert np.allclose(m.cross, w * (x - x.mean(axis=0)).T @ (x - x.mean(axis=0)), atol=1e-5)
        assert sorted(found) == [0, 1, 2]


def test_no_group_holds_more_than_a_block_of_each_task(wide, monkeypatch):
    monkeypatch.setattr(gram, "BLOCK", 16)
    m = gram.Moments(3.0, np.arange(41.0), np.ones((41, 41)))
    rows = pd.DataFrame(list(gram._block_rows(0, 0, m, 16)))
    assert len(rows) == 6 and rows["cross"].map(len).max() == 256
    one = gram._merge_blocks(rows[(rows.i == 0) & (rows.j == 2)])
    assert (one["i"][0], one["j"][0], len(one["cross"][0])) == (0, 2, 16 * 9)
    df, columns = wide
    plan = df.select(*columns, "target", "fold").mapInPandas(gram._batch_moments(41, False, 16), gram._PARTIAL)
    sizes = plan.groupBy("fold", "bucket", "i", "j").agg(F.max(F.size("cross")).alias("c"), F.count(F.lit(1)).alias("n")).collect()
    assert max(r.c for r in sizes) <= 256


def test_elimination_by_absolute_error_over_forty_columns(wide, monkeypatch):
    df, columns = wide
    some = columns[:14]
    want = ranking.LinearFolds(df, some, "mean_absolute_error_scorer", "fold", 0.0)
    subsets = [[f for f in some if f != g] for g in some] + [some[:2]]
    monkeypatch.setattr(ranking, "_wide", lambda *a: False)
    plain = want.scores(subsets)
    oos = ranking.LinearHoldout(df.filter("fold > 0"), df.filter("fold = 0"), some, "mean_absolute_error_scorer", 0.0)
    plain_oos = oos.scores(subsets)
    monkeypatch.undo()
    assert np.allclose(want.scores(subsets), plain) and np.allclose(oos.scores(subsets), plain_oos)
    # One pass for all forty candidates of a step, and the noise goes before the signal.
    scorer = ranking.LinearFolds(df, columns, "mean_absolute_error_scorer", "fold", 0.0)
    calls = []
    real = ranking.absolute_errors
    monkeypatch.setattr(ranking, "absolute_errors", lambda *a: calls.append(1) or real(*a))
    scores = scorer.scores([[f for f in columns if f != g] for g in columns])
    assert len(calls) == 1 and len(scores) == 40 and int(np.argmin(scores)) == 0
    none = df.limit(0)
    assert gram.absolute_errors(none, some, "target", {0: [([0], gram.LinearFit(np.ones(1), 0.0))]}) == {0: [None]}
