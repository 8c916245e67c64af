"""What a search keeps of its rows."""

from contextlib import nullcontext

from pyspark.sql import functions as F

from covaria.models.linear import GramRegressor
from covaria.models.registry import regressor
from covaria.operators import search, split
from covaria.operators.clean import clean, clean_selected


def _rows(spark):
    rows = spark.range(400).select(
        F.format_string("%04d", "id").alias("key"), F.col("id").cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"),
        F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id")).cast("double").alias("other"),
        (F.col("id") * 2.0).alias("target"), (F.col("id") % 3).cast("int").alias("groupcv_class"),
    )
    return rows.withColumn("a", F.when(F.col("a") % 11 == 0, float("nan")).otherwise(F.col("a")))


def test_folds_and_training_rows_are_stored_once(spark, monkeypatch):
    """one table has the rows of both; a gap in a column that no trial reads leaves a row in the folds."""
    stored, kept = [], []
    monkeypatch.setattr(search, "HELD_ROWS", 10)
    monkeypatch.setattr(search, "cut_lineage", lambda df, f=search.cut_lineage: stored.append(df.columns) or f(df))
    monkeypatch.setattr(search, "held", lambda df: kept.append(df.columns) or nullcontext(df))
    seen = []
    use = search.TrialObjective.use
    monkeypatch.setattr(search.TrialObjective, "use", lambda self, rows: use(self, rows) or seen.append(self))
    rows = _rows(spark)
    found = search.search(rows, rows, ["a", "b"], lambda p: GramRegressor(**p), {"ridge": [0.0, 1.0]}, "GridSearch", "oos_r2_scorer", ["r2_scorer"], n_splits=3)
    assert found.trials.count() == 2
    assert stored == [["key", "a", "b", "target", "groupcv_class", "_folded", "_whole", "fold"]]
    assert kept == [["key", "a", "b", "target", "groupcv_class"]]
    folds = split.assign_folds(clean_selected(rows, ["a", "b"], keep=["key"]), "key", 3, 1)
    assert sorted(map(tuple, seen[-1].folds.select(folds.columns).collect())) == sorted(map(tuple, folds.collect()))
    whole = clean(rows).drop("other")
    assert sorted(map(tuple, seen[-1].clean_training.select(whole.columns).collect())) == sorted(map(tuple, whole.collect()))
    assert folds.count() > whole.count()


def test_large_fits_hold_their_rows_one_at_a_time(spark, monkeypatch):
    """on many rows no two trials fit at once, and the scores are the same."""
    inside, most = [], []
    fit = search.fold_scores

    def watched(*rest):
        inside.append(1)
        most.append(len(inside))
        out = fit(*rest)
        inside.pop()
        return out

    monkeypatch.setattr(search, "fold_scores", watched)
    rows = _rows(spark)

    def scores():
        found = search.search(
            rows, rows, ["a", "b"], lambda p: regressor("DecisionTreeRegressor", p), {"max_depth": [1, 2, 3, 4]}, "GridSearch",
            "oos_r2_scorer", ["r2_scorer"], n_splits=2, jobs=4,
        )
        return {r["trial_id"]: r["scores"]["cv_r2_scorer"] for r in found.trials.collect()}

    together = scores()
    most.clear()
    monkeypatch.setattr(search, "HELD_ROWS", 10)
    assert scores() == together and max(most) == 1
