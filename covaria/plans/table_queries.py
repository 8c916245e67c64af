"""Queries on cleaning, splitting, sets, files and text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ..functions import naming
from ..functions.geojson import point_feature
from ..operators import clean as cleaning, points as point_ops, sets, split
from ..session import shared_folder
from ..sources import sinks, tables
from . import views as v
from .registry import query



def _doubles(df: DataFrame, *keep: str) -> DataFrame:
    """Floats as doubles, other columns as they are."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.FloatType) else F.col(f.name)
            for f in df.schema.fields
            if not keep or f.name in keep
        ]
    )


def _sql_doubles(*names: str) -> str:
    return ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in names)


@query("clean_filter", f"WITH {v.CLEAN_SQL} SELECT key, {_sql_doubles('target', *v.FEATURES, 'groupcv')} FROM clean")
def clean_filter(spark: SparkSession, sf: str) -> DataFrame:
    return _doubles(v.clean_training(spark, sf), "key", "target", *v.FEATURES, "groupcv")


@query(
    "clean_selected",
    f"WITH {v.DIRTY_SQL} SELECT key, {_sql_doubles('quantity', 'target')} FROM dirty WHERE {v.sql_clean('quantity', 'target')}",
)
def clean_selected(spark: SparkSession, sf: str) -> DataFrame:
    return _doubles(cleaning.clean_selected(v.dirty_training(spark, sf), ["quantity"], keep=["key"]))


@query(
    "float_cast",
    "SELECT l_orderkey, CAST(CAST(CAST(l_quantity AS VARCHAR) AS FLOAT) AS DOUBLE) AS quantity,"
    " CAST(CAST(CAST(l_tax AS VARCHAR) AS FLOAT) AS DOUBLE) AS tax,"
    " CAST(TRY_CAST(l_returnflag AS FLOAT) AS DOUBLE) AS flag FROM lineitem",
)
def float_cast(spark: SparkSession, sf: str) -> DataFrame:
    text = v.table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_quantity").cast("string").alias("quantity"), F.col("l_tax").cast("string").alias("tax"),
        F.col("l_returnflag").alias("flag"),
    )
    strict = cleaning.cast_float(text, ["quantity", "tax"])
    return _doubles(cleaning.cast_float(strict, ["flag"], lenient=True))


@query(
    "feature_projection",
    f"WITH {v.TRAIN_SQL} SELECT {_sql_doubles('quantity', 'discount', 'size', 'retailprice')} FROM train",
)
def feature_projection(spark: SparkSession, sf: str) -> DataFrame:
    features = cleaning.features_only(v.training(spark, sf).drop("orderkey"))
    return _doubles(cleaning.without(features, "tax"))


@query("row_count", f"WITH {v.CLEAN_SQL} SELECT count(*) AS n, CAST(floor(count(*) * 1.1) AS BIGINT) AS with_margin FROM clean")
def row_count(spark: SparkSession, sf: str) -> DataFrame:
    return v.clean_training(spark, sf).agg(
        F.count(F.lit(1)).alias("n"), F.floor(F.count(F.lit(1)) * F.lit(1.1)).alias("with_margin")
    )


@query("holdout_split", f"WITH {v.CLEAN_SQL}, {v.sql_holdout('clean', 10)} SELECT key, is_oos FROM held")
def holdout_split(spark: SparkSession, sf: str) -> DataFrame:
    return split.flag_holdout(v.clean_training(spark, sf), "key", 10).select("key", "is_oos")


@query("kfold_assign", f"WITH {v.CLEAN_SQL}, {v.sql_folds('clean', 7)} SELECT key, fold FROM folds")
def kfold_assign(spark: SparkSession, sf: str) -> DataFrame:
    return split.assign_folds(v.clean_training(spark, sf), "key", 7).select("key", "fold")


@query(
    "fold_sizes",
    f"WITH {v.CLEAN_SQL}, {v.sql_folds('clean', 7)} SELECT fold, count(*) AS test_rows,"
    " CAST(sum(count(*)) OVER () - count(*) AS BIGINT) AS train_rows FROM folds GROUP BY fold",
)
def fold_sizes(spark: SparkSession, sf: str) -> DataFrame:
    sizes = split.assign_folds(v.clean_training(spark, sf), "key", 7).groupBy("fold").agg(F.count(F.lit(1)).alias("test_rows"))
    # Seven rows.
    return sizes.withColumn("train_rows", F.sum("test_rows").over(Window.partitionBy()) - F.col("test_rows"))


@query(
    "leave_one_fold_out",
    f"WITH {v.TRAIN_SQL}, {v.sql_folds('train', 5)} SELECT 'test' AS part, key FROM folds WHERE fold = 2"
    " UNION ALL SELECT 'train', key FROM folds WHERE fold <> 2",
)
def leave_one_fold_out(spark: SparkSession, sf: str) -> DataFrame:
    folds = split.assign_folds(v.training(spark, sf), "key", 5).select("key", "fold")
    test = split.test_part(folds, 2).select(F.lit("test").alias("part"), "key")
    return test.unionByName(split.train_part(folds, 2).select(F.lit("train").alias("part"), "key"))


_GROUP_FOLD_SQL = (
    "group_fold AS (SELECT groupcv, CAST((row_number() OVER (ORDER BY "
    + v.sql_order(0, "CAST(CAST(groupcv AS INTEGER) AS VARCHAR) || '.0'")
    + ") - 1) % 5 AS INTEGER) AS groupcv_class FROM (SELECT DISTINCT groupcv FROM clean) g)"
)


@query(
    "group_fold_assign",
    f"WITH {v.CLEAN_SQL}, {_GROUP_FOLD_SQL} SELECT key, CAST(groupcv AS DOUBLE) AS groupcv, groupcv_class"
    " FROM clean JOIN group_fold USING (groupcv)",
)
def group_fold_assign(spark: SparkSession, sf: str) -> DataFrame:
    folds = split.assign_group_folds(v.clean_training(spark, sf), "groupcv", 5)
    return _doubles(folds, "key", "groupcv", "groupcv_class")


@query(
    "group_fold_rows",
    f"WITH {v.CLEAN_SQL}, {_GROUP_FOLD_SQL} SELECT groupcv_class, count(*) AS n, count(DISTINCT groupcv) AS n_groups"
    " FROM clean JOIN group_fold USING (groupcv) GROUP BY groupcv_class",
)
def group_fold_rows(spark: SparkSession, sf: str) -> DataFrame:
    folds = split.assign_group_folds(v.clean_training(spark, sf), "groupcv", 5)
    per_group = folds.groupBy("groupcv_class", "groupcv").agg(F.count(F.lit(1)).alias("n"))
    return per_group.groupBy("groupcv_class").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_groups"))


@query("distinct_groups", "SELECT DISTINCT l_suppkey AS groupcv FROM lineitem ORDER BY 1")
def distinct_groups(spark: SparkSession, sf: str) -> DataFrame:
    return v.table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("groupcv")).distinct().orderBy("groupcv")


@query(
    "first_groups",
    "SELECT l_suppkey AS groupcv, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20",
)
def first_groups(spark: SparkSession, sf: str) -> DataFrame:
    counts = v.table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("groupcv")).agg(F.count(F.lit(1)).alias("n"))
    return sets.first_rows(counts, 20, [F.desc("n"), "groupcv"])


@query(
    "bootstrap_sample",
    f"WITH {v.TRAIN_SQL}, r AS (SELECT key, row_number() OVER (ORDER BY {v.sql_order(3, 'key')}) - 1 AS r,"
    " count(*) OVER () AS n FROM train) SELECT key FROM r WHERE r < round_even(0.9 * n, 0)",
)
def bootstrap_sample(spark: SparkSession, sf: str) -> DataFrame:
    return split.subsample(v.training(spark, sf), "key", 0.9, 3).select("key")


@query(
    "bootstrap_with_replacement",
    f"""WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY {v.sql_order(3, 'o_orderkey')}) - 1 AS r,
      count(*) OVER () AS n FROM orders),
    draws AS (SELECT {v.sql_order('3:draw', 'i')} % n AS r FROM
      (SELECT count(*) AS n, CAST(round_even(0.9 * count(*), 0) AS BIGINT) AS m FROM orders) s, range(0, 10000000) t(i) WHERE i < m)
    SELECT o_orderkey, CAST(count(*) AS INTEGER) AS copies FROM r JOIN draws USING (r) GROUP BY o_orderkey""",
)
def bootstrap_with_replacement(spark: SparkSession, sf: str) -> DataFrame:
    orders = v.table(spark, sf, "orders").select("o_orderkey")
    return split.resample(orders, "o_orderkey", 0.9, 3)


@query(
    "chunked_targets",
    "SELECT o_orderkey, CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // 5000 AS BIGINT) AS chunk FROM orders",
)
def chunked_targets(spark: SparkSession, sf: str) -> DataFrame:
    return split.chunk(v.table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 5000)


@query(
    "align_columns",
    "SELECT s_suppkey AS id, CAST(NULL AS DOUBLE) AS c_acctbal, s_acctbal FROM supplier UNION ALL"
    " SELECT c_custkey, c_acctbal, NULL FROM customer",
)
def align_columns(spark: SparkSession, sf: str) -> DataFrame:
    suppliers = v.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), "s_acctbal")
    customers = v.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), "c_acctbal")
    columns = ["id", "c_acctbal", "s_acctbal"]
    return cleaning.align(suppliers, columns).unionByName(cleaning.align(customers, columns))


@query(
    "two_class_stack",
    f"WITH {v.TRAIN_SQL} SELECT key, CAST(quantity AS DOUBLE) AS quantity, CAST(tax AS DOUBLE) AS tax, 2 AS class FROM train"
    " UNION ALL SELECT key, quantity, tax, 1 FROM train WHERE quantity > 25",
)
def two_class_stack(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.drift import two_classes

    rows = v.training(spark, sf)
    return _doubles(two_classes(rows.filter("quantity > 25").select("key", "quantity", "tax", "size"), rows.select("key", "quantity", "tax")))


_WANTED = "wanted AS (SELECT 'raster_' || p_brand AS path, p_partkey AS position FROM part)"


@query("covariate_duplicates", f"WITH {_WANTED} SELECT path, count(*) AS copies FROM wanted GROUP BY path HAVING count(*) > 1")
def covariate_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return sets.repeats(_catalogue(spark, sf))


def _catalogue(spark: SparkSession, sf: str) -> DataFrame:
    return v.table(spark, sf, "part").select(
        F.concat(F.lit("raster_"), "p_brand").alias("path"), F.col("p_partkey").alias("position")
    )


@query("covariate_catalogue", f"WITH {_WANTED} SELECT path, min(position) AS position FROM wanted GROUP BY path")
def covariate_catalogue(spark: SparkSession, sf: str) -> DataFrame:
    return sets.drop_repeats(_catalogue(spark, sf))


_PRESENT = "present AS (SELECT DISTINCT 'raster_' || p_brand AS path FROM part WHERE p_size < 3)"


@query(
    "covariate_existence",
    f"WITH {_WANTED}, {_PRESENT} SELECT path, count(*) AS mentions, path IN (SELECT path FROM present) AS found FROM wanted GROUP BY path",
)
def covariate_existence(spark: SparkSession, sf: str) -> DataFrame:
    present = (
        v.table(spark, sf, "part").filter("p_size < 3")
        .select(F.concat(F.lit("raster_"), "p_brand").alias("path"))
    )
    found, missing = sets.existing(_catalogue(spark, sf), present, "path")
    both = found.select("path", F.lit(True).alias("found")).unionByName(missing.select("path", F.lit(False).alias("found")))
    return both.groupBy("path", "found").agg(F.count(F.lit(1)).alias("mentions"))


@query(
    "feature_substring_match",
    "WITH f AS (SELECT DISTINCT p_name AS feature FROM part), p AS (SELECT 'dir/' || p_name || '_' || p_brand || '.tif' AS path,"
    " p_partkey AS position FROM part) SELECT feature, arg_min(path, position) AS path FROM f JOIN p ON contains(path, feature)"
    " GROUP BY feature",
)
def feature_substring_match(spark: SparkSession, sf: str) -> DataFrame:
    parts = v.table(spark, sf, "part")
    features = parts.select(F.col("p_name").alias("feature")).distinct()
    paths = parts.select(
        F.concat(F.lit("dir/"), "p_name", F.lit("_"), "p_brand", F.lit(".tif")).alias("path"),
        F.col("p_partkey").alias("position"),
    )
    return sets.match_substring(features, paths)


@query(
    "feature_exact_match",
    "SELECT p_brand AS covariate, p_partkey FROM part WHERE p_brand IN (SELECT p_brand FROM part GROUP BY 1 HAVING max(p_size) = 50)",
)
def feature_exact_match(spark: SparkSession, sf: str) -> DataFrame:
    parts = v.table(spark, sf, "part")
    chosen = parts.groupBy("p_brand").agg(F.max("p_size").alias("m")).filter("m = 50").select(F.col("p_brand").alias("feature"))
    return sets.match_exact(chosen, parts.select(F.col("p_brand").alias("covariate"), "p_partkey"))


@query(
    "set_difference",
    "SELECT DISTINCT o_custkey AS feature FROM orders EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 450000",
)
def set_difference(spark: SparkSession, sf: str) -> DataFrame:
    orders = v.table(spark, sf, "orders").select(F.col("o_custkey").alias("feature"), "o_totalprice")
    return sets.not_in(orders.select("feature").distinct(), orders.filter("o_totalprice > 450000"), "feature")


@query(
    "flatten_lists",
    "SELECT o_custkey, CAST(unnest(list_sort(flatten(list([o_orderkey, o_orderkey + 1])))) AS BIGINT) AS item FROM orders GROUP BY o_custkey",
)
def flatten_lists(spark: SparkSession, sf: str) -> DataFrame:
    # A list column per row, and its flat items; nothing is gathered per key.
    orders = v.table(spark, sf, "orders")
    nested = orders.select("o_custkey", F.array(F.array("o_orderkey"), F.array(F.col("o_orderkey") + 1)).alias("item"))
    return sets.flatten_lists(nested, "item").withColumn("item", F.explode("item"))


@query(
    "file_stems",
    r"SELECT doc_id, regexp_replace('/data/x.y/' || source || '.v1.tif', '^.*/', '') AS name,"
    r" source || '.v1' AS stem, '/data/x.y/' || source || '.v1_fixed.tif' AS fixed FROM documents",
)
def file_stems(spark: SparkSession, sf: str) -> DataFrame:
    path = F.concat(F.lit("/data/x.y/"), "source", F.lit(".v1.tif"))
    return v.table(spark, sf, "documents").select(
        "doc_id", naming.file_name(path).alias("name"), naming.file_stem(path).alias("stem"),
        naming.with_suffix(path, "_fixed").alias("fixed"),
    )


# ---- GeoJSON ------------------------------------------------------------------------------

_GEO = """geo AS (SELECT event_id, event_id % 6 AS kind, event_id % 1000 AS gx, event_id % 777 AS gy,
  CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events)"""


def _event_features(spark: SparkSession, sf: str) -> DataFrame:
    """Event rows as GeoJSON text of six kinds, two of them unusable."""
    x, y = (F.col("event_id") % 1000).cast("string"), (F.col("event_id") % 777).cast("string")
    kind = F.col("event_id") % 6
    pair = F.concat(x, F.lit(".5, "), y, F.lit(".25"))
    place = (
        F.when(kind == 0, F.concat(F.lit('"Point","coordinates":['), pair, F.lit("]")))
        .when(kind == 1, F.concat(F.lit('"Point","coordinates":['), pair, F.lit(",7.0]")))
        .when(kind == 2, F.concat(F.lit('"MultiPoint","coordinates":[['), pair, F.lit("],[1.0,2.0]]")))
        .when(kind == 3, F.concat(F.lit('"Point","coordinates":['), x, F.lit("]")))
        .otherwise(F.concat(F.lit('"Point","coordinates":['), pair, F.lit("]")))
    )
    props = F.when(kind == 4, F.lit('{"other":1}')).when(kind == 5, F.lit('{"k":null}')).otherwise(F.col("props"))
    text = F.concat(F.lit('{"type":"Feature","properties":'), props, F.lit(',"geometry":{"type":'), place, F.lit("}}"))
    return point_ops.parse_features(v.table(spark, sf, "events").select("event_id", text.alias("value")))


@query(
    "geojson_points",
    f"WITH {_GEO} SELECT event_id, CAST(CASE WHEN kind = 5 THEN NULL ELSE k END AS DOUBLE) AS target,"
    " CAST(gx + 0.5 AS DOUBLE) AS x, CAST(gy + 0.25 AS DOUBLE) AS y FROM geo WHERE kind NOT IN (3, 4)",
)
def geojson_points(spark: SparkSession, sf: str) -> DataFrame:
    good, _ = point_ops.normalise_points(_event_features(spark, sf), "k")
    return _doubles(good)


@query(
    "geojson_rejects",
    f"WITH {_GEO} SELECT event_id, CASE kind WHEN 3 THEN 'geometry' ELSE 'property' END AS reject_reason FROM geo WHERE kind IN (3, 4)",
)
def geojson_rejects(spark: SparkSession, sf: str) -> DataFrame:
    _, bad = point_ops.normalise_points(_event_features(spark, sf), "k")
    return bad.select("event_id", "reject_reason")


@query(
    "geojson_encode",
    """SELECT s_suppkey, '{"type":"Feature","properties":{"id":' || s_suppkey || ',"name":"' || s_name
      || '"},"geometry":{"type":"Point","coordinates":[' || (s_suppkey % 90) || ',' || s_nationkey || ']}}' AS feature FROM supplier""",
)
def geojson_encode(spark: SparkSession, sf: str) -> DataFrame:
    return v.table(spark, sf, "supplier").select(
        "s_suppkey",
        point_feature(
            F.col("s_suppkey") % 90, F.col("s_nationkey").cast("long"), [F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")]
        ).alias("feature"),
    )


# ---- files --------------------------------------------------------------------------------


@query("merge_union", "SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS col FROM orders")
def merge_union(spark: SparkSession, sf: str) -> DataFrame:
    """Chunk files with a header each, merged into one table."""
    base = shared_folder(spark)
    orders = v.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("col"))
    paths = []
    for i in range(3):
        paths.append(f"{base}/chunk_{i}")
        sinks.write_table(orders.filter(F.col("id") % 3 == i), paths[-1], "csv")
    return sinks.merge_csv(spark, paths, f"{base}/merged")


@query(
    "csv_scan_clean",
    f"WITH {v.CLEAN_SQL} SELECT key, {_sql_doubles('target', *v.FEATURES)} FROM clean",
)
def csv_scan_clean(spark: SparkSession, sf: str) -> DataFrame:
    """The dirty table through a CSV file and back, cast and cleaned."""
    path = f"{shared_folder(spark)}/dirty"
    sinks.write_table(v.dirty_training(spark, sf).select("key", "target", *v.FEATURES, "groupcv"), path, "csv")
    return _doubles(tables.read_clean_csv(spark, path), "key", "target", *v.FEATURES)


@query(
    "csv_header",
    "SELECT unnest(['c_custkey', 'c_nationkey', 'c_acctbal', 'c_mktsegment']) AS name, count(*) AS n FROM customer",
)
def csv_header(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{shared_folder(spark)}/customers"
    customers = v.table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    sinks.write_table(customers, path, "csv")
    names = tables.csv_columns(spark, path)
    rows = tables.read_csv(spark, path, columns=["c_custkey"]).agg(F.count(F.lit(1)).alias("n"))
    return rows.select(F.explode(F.array(*[F.lit(n) for n in names])).alias("name"), "n")


@query("training_parquet", f"WITH {v.CLEAN_SQL} SELECT key, {_sql_doubles('target', *v.FEATURES)} FROM clean")
def training_parquet(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{shared_folder(spark)}/training"
    sinks.write_table(v.clean_training(spark, sf), path)
    return _doubles(tables.read_training(spark, path), "key", "target", *v.FEATURES)


@query("geojson_file", f"WITH {v.POINTS_SQL} SELECT point_id, x, y, CAST(CAST(price AS FLOAT) AS DOUBLE) AS target FROM points")
def geojson_file(spark: SparkSession, sf: str) -> DataFrame:
    """Points written as GeoJSON lines and scanned again."""
    path = f"{shared_folder(spark)}/points"
    sinks.write_geojson_lines(v.points(spark, sf), path, ["point_id", "price"])
    features = tables.read_geojson_lines(spark, path)
    features = features.withColumn("point_id", F.col("feature.properties")["point_id"].cast("long"))
    good, _ = point_ops.normalise_points(features, "price")
    return _doubles(good)


@query(
    "geojson_collection",
    f"WITH {v.POINTS_SQL} SELECT CASE WHEN point_id % 7 = 0 THEN 'property' ELSE 'good' END AS state, point_id, x, y,"
    " CASE WHEN point_id % 7 <> 0 THEN CAST(CAST(price AS FLOAT) AS DOUBLE) END AS target FROM points",
)
def geojson_collection(spark: SparkSession, sf: str) -> DataFrame:
    """Points written as one FeatureCollection of several files and read again in splits; every seventh lacks the property."""
    path = f"{shared_folder(spark)}/collection"
    points = v.points(spark, sf)
    # A null value is not written, so its feature lacks the member.
    marked = points.withColumn("cost", F.when(F.col("point_id") % 7 != 0, F.col("price")))
    sinks.write_geojson_collection(marked, path, ["point_id", "cost"], "point_id")
    features = tables.read_geojson(spark, path, one_document=True)
    features = features.withColumn("point_id", F.col("feature.properties")["point_id"].cast("long"))
    good, bad = point_ops.normalise_points(features, "cost")
    xy = F.col("feature.geometry.coordinates")
    lost = bad.select(
        F.col("reject_reason").alias("state"), "point_id", *[c.alias(n) for c, n in zip(point_ops.first_xy(xy), "xy")],
        F.lit(None).cast("double").alias("target"),
    )
    return _doubles(good).select(F.lit("good").alias("state"), "point_id", "x", "y", "target").unionByName(lost)


@query("glob_scan", "SELECT o_orderkey AS id, CAST(o_orderkey % 3 AS INTEGER) AS row FROM orders")
def glob_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks written below one folder, found again by a file name pattern."""
    path = f"{shared_folder(spark)}/blocks"
    orders = v.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), (F.col("o_orderkey") % 3).cast("int").alias("row"))
    sinks.write_map(orders, path, rows_per_block=1)
    sinks.write_table(orders.limit(0), f"{path}/other", "csv")
    return tables.read_matching(spark, path, "part-*.parquet", orders.schema)
