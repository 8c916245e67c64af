import json

import pytest
from pyspark.sql import functions as F

from covaria.operators import clean as c, joins, ranks, sets, split
from covaria.session import cut_lineage, shared_folder
from covaria.sources import sinks, tables


def test_clean_drops_every_kind_of_missing(spark):
    good = (1.0, 2.0)
    bad = [(None, 1.0), (float("nan"), 1.0), (float("inf"), 1.0), (1.0, float("-inf")), (1.0, -9999.0), (-9999.0, None)]
    df = spark.createDataFrame([good, *bad], "a float, b float")
    out = c.clean(df)
    assert [tuple(r) for r in out.collect()] == [good]
    assert c.clean(out).count() == out.count()


def test_scoped_clean_ignores_other_columns(spark):
    df = spark.createDataFrame([("k", 1.0, float("nan"), 3.0)], "key string, a float, b float, target float")
    assert c.clean_selected(df, ["a"], keep=["key"]).count() == 1
    assert c.clean(df).count() == 0


def test_bad_text_is_an_error_unless_lenient(spark):
    df = spark.createDataFrame([("1.5",), ("x",)], "a string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        c.cast_float(df).collect()
    assert [r["a"] for r in c.cast_float(df, lenient=True).collect()] == [1.5, None]


def test_features_align_and_stack(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0)], "target double, p double, q double, x double")
    assert c.features_only(df).columns == ["p", "q"]
    assert c.align(df, ["q", "zz"]).first()["zz"] is None
    other = spark.createDataFrame([(9.0, 8.0)], "q double, r double")
    assert c.stack_aligned(df, other).columns == ["q"]


@pytest.mark.parametrize(("n", "k"), [(10, 3), (7, 7), (3, 5), (1, 2), (0, 3), (1000, 1)])
def test_folds_are_exact(spark, n, k):
    df = spark.range(n)
    folds = split.assign_folds(df, "id", k)
    sizes = dict(folds.groupBy("fold").count().collect())
    want = [n // k + (1 if i < n % k else 0) for i in range(k)]
    assert [sizes.get(i, 0) for i in range(k)] == want


@pytest.mark.parametrize("pct", [0, 10, 33, 100])
def test_holdout_is_exact_and_partitions(spark, pct):
    train, oos = split.holdout(spark.range(1234), "id", pct)
    assert oos.count() == int(1234 * (pct / 100))
    assert train.union(oos).distinct().count() == 1234


def test_rank_cuts_refine_without_collecting(spark, monkeypatch):
    monkeypatch.setattr(ranks, "_COLLECT_VALUES", 0)
    df = spark.range(50_000)
    # Dense small values in a wide range: every pass has to refine.
    wanted = [0, 1, 7, 16666, 50_000]
    cuts = ranks.rank_cuts(df, F.col("id"), lambda n: wanted, bits=60)
    assert [df.filter(F.col("id") < c).count() for c in cuts] == wanted


def test_ties_at_a_cut_are_reported(spark):
    df = spark.range(100).select(F.lit(5).cast("long").alias("v"))
    with pytest.raises(ranks.TiedOrderError):
        ranks.rank_cuts(df, F.col("v"), lambda n: [50])
    keyed = ranks.with_row_key(df, "key")
    assert split.flag_holdout(keyed, "key", 50).filter("is_oos").count() == 50


def test_exact_rank_is_a_permutation(spark):
    df = spark.range(3000)
    ranked = ranks.exact_rank(df, split._order(4, "id"))
    assert sorted(r["rank"] for r in ranked.collect()) == list(range(3000))
    cut = ranked.filter("rank < 100").count()
    assert cut == 100


def test_chunks_follow_the_key_order(spark):
    df = spark.range(0, 5000, 7).repartition(5)
    rows = split.chunk(df, "id", 100).orderBy("id").collect()
    assert [r["chunk"] for r in rows] == [i // 100 for i in range(len(rows))]


def test_groups_never_part(spark):
    df = spark.range(2000).select("id", F.when(F.col("id") % 3 == 0, 0.5).otherwise((F.col("id") % 17).cast("double")).alias("g"))
    out = split.assign_group_folds(df, "g", 4)
    assert out.count() == 2000
    assert out.groupBy("g").agg(F.count_distinct("groupcv_class").alias("n")).filter("n <> 1").count() == 0
    per_fold = [r[1] for r in out.groupBy("groupcv_class").agg(F.count_distinct("g")).collect()]
    assert max(per_fold) - min(per_fold) <= 1
    ordered = [r["g"] for r in split.assign_group_folds(df, "g", 4, ordered=True).collect()]
    assert ordered == sorted(ordered)


def test_samples_have_exact_sizes(spark):
    df = spark.range(1003)
    assert split.subsample(df, "id", 0.9, 1).count() == round(0.9 * 1003)
    drawn = split.resample(df, "id", 0.9, 1)
    assert drawn.agg(F.sum("copies")).first()[0] == round(0.9 * 1003)
    assert drawn.filter("copies > 1").count() > 0


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_join_paths_agree(spark, how):
    """A third of all rows on one key, null keys, and keys without a partner."""
    left = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 4000).cast("long").alias("k"), "id"
    )
    right = spark.range(3500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    want = sorted(left.join(right, "k", how).select("k", "id", "v").collect(), key=str)
    small = sorted(joins.lookup_join(left, right, ["k"], how).select("k", "id", "v").collect(), key=str)
    large = sorted(joins.lookup_join(left, right, ["k"], how, small_rows=10).select("k", "id", "v").collect(), key=str)
    assert small == want
    assert large == want


def test_hot_keys_include_null(spark):
    df = spark.range(10_000).select(
        F.when(F.col("id") % 4 == 0, 7).when(F.col("id") % 5 == 1, None).otherwise(F.col("id")).cast("long").alias("k")
    )
    assert set(joins.hot_keys(df, ["k"])) == {(7,), (None,)}
    assert joins.hot_keys(spark.range(5000), ["id"]) == []


def test_catalogue_helpers(spark):
    wanted = spark.createDataFrame([(0, "a"), (1, "b"), (2, "a"), (3, "c")], "position int, path string")
    assert {tuple(r) for r in sets.drop_repeats(wanted).select("path", "position").collect()} == {("a", 0), ("b", 1), ("c", 3)}
    assert [tuple(r) for r in sets.repeats(wanted).collect()] == [("a", 2)]
    found, missing = sets.existing(wanted, spark.createDataFrame([("a",), ("c",)], "path string"), "path")
    assert {r["path"] for r in found.collect()} == {"a", "c"} and {r["path"] for r in missing.collect()} == {"b"}
    features = spark.createDataFrame([("tpi_3",), ("dem",), ("none",)], "feature string")
    paths = spark.createDataFrame([(0, "x/tpi_300.tif"), (1, "x/tpi_3.tif"), (2, "x/dem.tif")], "position int, path string")
    assert {tuple(r) for r in sets.match_substring(features, paths).collect()} == {("tpi_3", "x/tpi_300.tif"), ("dem", "x/dem.tif")}
    names = spark.createDataFrame([("tpi_300",), ("tpi_3",)], "covariate string")
    assert [r[0] for r in sets.match_exact(features, names).collect()] == ["tpi_3"]


def test_merge_csv_keeps_every_row(spark, tmp_path):
    paths = []
    for i in range(5):
        p = tmp_path / f"part_{i}.csv"
        p.write_text(f"id,col\n{i},v{i}\n")
        paths.append(str(p))
    merged = sinks.merge_csv(spark, paths, str(tmp_path / "merged"), one_file=True)
    assert sorted(r["id"] for r in merged.collect()) == ["0", "1", "2", "3", "4"]
    assert tables.csv_columns(spark, str(tmp_path / "merged")) == ["id", "col"]


def test_csv_readers(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("target,f1,x,y\n1,2,3,4\n-9999,1,1,1\n1,,1,1\n")
    assert tables.covariates_in_csv(spark, str(p)) == ["f1"]
    assert tables.read_csv(spark, str(p), ["f1"]).columns == ["f1"]
    assert tables.read_clean_csv(spark, str(p)).count() == 1


def test_geojson_document_round_trip(spark, tmp_path):
    df = spark.range(25).select("id", F.col("id").cast("double").alias("x"), (-F.col("id")).cast("double").alias("y"))
    path = str(tmp_path / "doc")
    sinks.write_geojson_collection(df, path, ["id"], "id", one_file=True)
    text = "\n".join(p.read_text() for p in sorted((tmp_path / "doc").glob("part-*")))
    doc = json.loads(text)
    assert doc["type"] == "FeatureCollection" and len(doc["features"]) == 25
    assert doc["features"][3]["geometry"]["coordinates"] == [3.0, -3.0]
    features = tables.read_geojson(spark, path)
    assert features.count() == 25


def test_file_listing(spark, tmp_path):
    base = tmp_path / "maps"
    spark.range(3).withColumn("row", F.col("id") * 300).write.parquet(str(base / "merged_1"))
    found = tables.matching_files(spark, str(base), "part*.parquet")
    assert found.count() >= 1
    assert tables.read_matching(spark, str(base), "part*.parquet", spark.range(1).schema).count() == 3


def test_cut_lineage_keeps_rows(spark):
    df = spark.range(10).withColumn("a", F.col("id") * 2)
    assert cut_lineage(df).agg(F.sum("a")).first()[0] == 90
    assert shared_folder(spark) != shared_folder(spark)


def test_spread_bounds_the_rows_of_a_split(spark, tmp_path, monkeypatch):
    from covaria import session

    spark.range(1600).repartition(8).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    assert session.spread(df, "id").rdd.getNumPartitions() == 8
    monkeypatch.setattr(session, "SPLIT_ROWS", 100)
    monkeypatch.setattr(session, "MOST_SPLIT_ROWS", 150)
    many = session.spread(df, "id")
    assert many.rdd.getNumPartitions() == 16 and many.count() == 1600


def test_drift_points_store_their_rows_once(spark, sf, monkeypatch):
    from covaria.plans import model_queries

    stored = []
    monkeypatch.setattr(model_queries, "cut_lineage", lambda df, f=model_queries.cut_lineage: stored.append(df.columns) or f(df))
    assert model_queries.drift_points(spark, sf).count() > 0
    assert stored == [["key", "x", "y", "quantity", "size"]]


def test_stored_holdout_is_the_holdout(spark):
    """the rows are written once and split alike."""
    rows = spark.range(1000).select(F.concat(F.lit("r"), "id").alias("key"), "id")
    for one, other in zip(split.holdout(rows, "key", 10, 3), split.stored_holdout(rows, "key", 10, 3)):
        assert one.columns == other.columns and other.inputFiles()
        assert sorted(r["id"] for r in one.collect()) == sorted(r["id"] for r in other.collect())
