"""Views over the given tables, as Spark plans and as SQL text.

There is no geodata here, so the workflow's inputs are derived from the star
schema: training rows from line items, rasters from parts, points from orders.
Bad values are put in by key, so that the clean filter has work to do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.hashing import order_value, unit_uniform
from ..session import spread

FEATURES = ["quantity", "discount", "tax", "size", "retailprice"]

GRID_WIDTH = 50
X0, Y0, STEP = 500000.0, -3000000.0, 30.0


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# ---- SQL text of the seeded randomness -------------------------------------------------


def sql_order(seed: str | int, *keys: str) -> str:
    return f"CAST('0x' || substr(md5(concat_ws(':', '{seed}', {', '.join(keys)})), 1, 15) AS BIGINT)"


def sql_uniform(seed: str | int, *keys: str) -> str:
    digits = f"CAST('0x' || substr(md5(concat_ws(':', '{seed}', {', '.join(keys)})), 1, 13) AS BIGINT)"
    return f"(CAST({digits} AS DOUBLE) / 4503599627370496.0)"


def sql_clean(*columns: str) -> str:
    return " AND ".join(
        f"{c} IS NOT NULL AND NOT isnan({c}) AND NOT isinf({c}) AND {c} <> -9999" for c in columns
    )


# ---- training rows -----------------------------------------------------------------------

_KEY_SQL = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE))"

TRAIN_SQL = f"""train AS (
  SELECT {_KEY_SQL} AS key,
    CAST(l_quantity * p_retailprice * (1 - l_discount) AS FLOAT) AS target,
    CAST(l_quantity AS FLOAT) AS quantity, CAST(l_discount AS FLOAT) AS discount, CAST(l_tax AS FLOAT) AS tax,
    CAST(p_size AS FLOAT) AS size, CAST(p_retailprice AS FLOAT) AS retailprice,
    CAST(l_partkey * 37 % 850 * 10 + l_linenumber AS DOUBLE) AS x, CAST(l_orderkey * 53 % 500 * 10 + p_size AS DOUBLE) AS y,
    CAST(l_suppkey AS FLOAT) AS groupcv, l_orderkey AS orderkey
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

_DIRTY = {
    "quantity": (97, "CAST(NULL AS FLOAT)", None),
    "target": (89, "CAST('NaN' AS FLOAT)", float("nan")),
    "discount": (83, "CAST('Infinity' AS FLOAT)", float("inf")),
    "tax": (79, "CAST('-Infinity' AS FLOAT)", float("-inf")),
    "size": (73, "CAST(-9999 AS FLOAT)", -9999.0),
}

DIRTY_SQL = f"""{TRAIN_SQL}, dirty AS (
  SELECT key, {', '.join(f"CASE WHEN orderkey % {m} = 0 THEN {sql} ELSE {c} END AS {c}" for c, (m, sql, _) in _DIRTY.items())},
    retailprice, x, y, groupcv FROM train)"""


def _training_key() -> Column:
    return F.concat_ws(
        "-",
        *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
        F.col("l_shipdate").cast("date").cast("string"),
    )


def training(spark: SparkSession, sf: str) -> DataFrame:
    """Line items with their part; no hint: the runtime sizes decide the join."""
    items = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_discount", "l_tax"
    )
    parts = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    items = spread(items, "l_orderkey")
    joined = items.join(parts, items.l_partkey == parts.p_partkey).withColumn("key", _training_key())
    amount = F.col("l_quantity") * F.col("p_retailprice") * (F.lit(1) - F.col("l_discount"))
    return joined.select(
        "key",
        amount.cast("float").alias("target"),
        F.col("l_quantity").cast("float").alias("quantity"),
        F.col("l_discount").cast("float").alias("discount"),
        F.col("l_tax").cast("float").alias("tax"),
        F.col("p_size").cast("float").alias("size"),
        F.col("p_retailprice").cast("float").alias("retailprice"),
        (F.col("l_partkey") * 37 % 850 * 10 + F.col("l_linenumber")).cast("double").alias("x"),
        (F.col("l_orderkey") * 53 % 500 * 10 + F.col("p_size")).cast("double").alias("y"),
        F.col("l_suppkey").cast("float").alias("groupcv"),
        F.col("l_orderkey").alias("orderkey"),
    )


def dirty_training(spark: SparkSession, sf: str) -> DataFrame:
    df = training(spark, sf)
    broken = {
        c: F.when(F.col("orderkey") % m == 0, F.lit(bad).cast("float")).otherwise(F.col(c))
        for c, (m, _, bad) in _DIRTY.items()
    }
    return df.withColumns(broken).drop("orderkey")


CLEAN_SQL = f"""{DIRTY_SQL}, clean AS (
  SELECT * FROM dirty WHERE {sql_clean('target', *FEATURES, 'x', 'y', 'groupcv')})"""


def clean_training(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.clean import clean

    return clean(dirty_training(spark, sf))


def sql_folds(source: str, k: int, seed: str | int = 1, name: str = "folds", key: str = "key") -> str:
    """Rank by hash, then folds whose sizes differ by at most one row."""
    return f"""{name}_ranked AS (
  SELECT *, row_number() OVER (ORDER BY {sql_order(seed, key)}) - 1 AS r, count(*) OVER () AS n FROM {source}),
{name} AS (
  SELECT * EXCLUDE (r, n), CAST(CASE WHEN r < (n // {k} + 1) * (n % {k}) THEN r // (n // {k} + 1)
    ELSE n % {k} + (r - (n // {k} + 1) * (n % {k})) // greatest(n // {k}, 1) END AS INTEGER) AS fold FROM {name}_ranked)"""


def sql_holdout(source: str, percentage: float, seed: str | int = 0, name: str = "held", key: str = "key") -> str:
    return f"""{name} AS (
  SELECT *, row_number() OVER (ORDER BY {sql_order(seed, key)}) - 1
    < CAST(floor(count(*) OVER () * ({percentage} / 100.0)) AS BIGINT) AS is_oos FROM {source})"""


# ---- rasters --------------------------------------------------------------------------------

META_SQL = f"""meta AS (
  SELECT r.raster, r.n_bands, {GRID_WIDTH} AS width, CAST(h.height AS INTEGER) AS height, CAST({X0} AS DOUBLE) AS x0,
    CAST({Y0} AS DOUBLE) AS y0, CAST({STEP} AS DOUBLE) AS dx, CAST({STEP} AS DOUBLE) AS dy, r.nodata
  FROM (SELECT 'price' AS raster, 1 AS n_bands, CAST(-9999.0 AS DOUBLE) AS nodata
        UNION ALL SELECT 'parts', 2, CAST(NULL AS DOUBLE)) r,
       (SELECT max(p_partkey) // {GRID_WIDTH} + 1 AS height FROM part) h)"""

CELLS_SQL = f"""cells AS (
  SELECT covariate, CAST(p_partkey // {GRID_WIDTH} AS INTEGER) AS row, CAST(p_partkey % {GRID_WIDTH} AS INTEGER) AS col, value
  FROM (SELECT p_partkey, 'price' AS covariate, CAST(p_retailprice AS FLOAT) AS value FROM part
        UNION ALL SELECT p_partkey, 'parts_1', CAST(p_size AS FLOAT) FROM part
        UNION ALL SELECT p_partkey, 'parts_2', CAST(p_retailprice / p_size AS FLOAT) FROM part) c)"""


def raster_cells(spark: SparkSession, sf: str) -> DataFrame:
    """`price` (one band) and `parts` (two bands) on a grid of part numbers."""
    parts = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    bands = parts.selectExpr(
        "p_partkey",
        "stack(3, 'price', 1, p_retailprice, 'parts', 1, CAST(p_size AS DOUBLE), 'parts', 2, p_retailprice / p_size)"
        " AS (raster, band, value)",
    )
    return bands.select(
        "raster",
        "band",
        F.floor(F.col("p_partkey") / GRID_WIDTH).cast("int").alias("row"),
        F.pmod("p_partkey", F.lit(GRID_WIDTH)).cast("int").alias("col"),
        F.col("value").cast("float").alias("value"),
    )


def raster_meta(spark: SparkSession, sf: str) -> DataFrame:
    height = table(spark, sf, "part").agg((F.floor(F.max("p_partkey") / GRID_WIDTH) + 1).cast("int").alias("height"))
    return height.selectExpr(
        "stack(2, 'price', 1, CAST(-9999.0 AS DOUBLE), 'parts', 2, CAST(NULL AS DOUBLE)) AS (raster, n_bands, nodata)",
        "height",
    ).select(
        "raster", "n_bands", F.lit(GRID_WIDTH).alias("width"), "height", F.lit(X0).alias("x0"), F.lit(Y0).alias("y0"),
        F.lit(STEP).alias("dx"), F.lit(STEP).alias("dy"), "nodata",
    )


MASK_SQL = f"""mask AS (
  SELECT CAST(p_partkey // {GRID_WIDTH} AS INTEGER) AS row, CAST(p_partkey % {GRID_WIDTH} AS INTEGER) AS col,
    CAST(CASE WHEN p_size > 10 THEN 1 ELSE 0 END AS FLOAT) AS value FROM part)"""


def mask_cells(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part")
    return parts.select(
        F.floor(F.col("p_partkey") / GRID_WIDTH).cast("int").alias("row"),
        F.pmod("p_partkey", F.lit(GRID_WIDTH)).cast("int").alias("col"),
        F.when(F.col("p_size") > 10, 1.0).otherwise(0.0).cast("float").alias("value"),
    )


def area_of(spark: SparkSession, sf: str) -> dict:
    """The area of interest: one row of metadata."""
    row = raster_meta(spark, sf).filter("raster = 'price'").first().asDict()
    row["nodata"] = None
    return row


# ---- points ---------------------------------------------------------------------------------

# A margin of half a cell around the raster: some points fall outside.
_X_SQL = f"{X0 - STEP / 2} + {sql_uniform('px', 'o_orderkey')} * {STEP * (GRID_WIDTH + 1)}"
_Y_SQL = f"{Y0 + STEP / 2} - {sql_uniform('py', 'o_orderkey')} * ({STEP} * (height + 1))"

POINTS_SQL = f"""points AS (
  SELECT o_orderkey AS point_id, {_X_SQL} AS x, {_Y_SQL} AS y, o_totalprice AS price, o_custkey AS customer
  FROM orders, (SELECT max(p_partkey) // {GRID_WIDTH} + 1 AS height FROM part) h)"""


def points(spark: SparkSession, sf: str) -> DataFrame:
    height = area_of(spark, sf)["height"]
    return spread(table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_custkey"), "o_orderkey").select(
        F.col("o_orderkey").alias("point_id"),
        (F.lit(X0 - STEP / 2) + unit_uniform("px", "o_orderkey") * F.lit(STEP * (GRID_WIDTH + 1))).alias("x"),
        (F.lit(Y0 + STEP / 2) - unit_uniform("py", "o_orderkey") * F.lit(STEP * (height + 1))).alias("y"),
        F.col("o_totalprice").alias("price"),
        F.col("o_custkey").alias("customer"),
    )


def point_features(spark: SparkSession, sf: str) -> DataFrame:
    """The points as parsed GeoJSON features: (point_id, feature)."""
    from ..functions.geojson import point_feature
    from ..operators.points import parse_features

    text = points(spark, sf).select(
        "point_id", point_feature(F.col("x"), F.col("y"), [F.col("price"), F.col("customer")]).alias("value")
    )
    return parse_features(text)

