"""Column roles and table schemas shared by all operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

# Columns that are never used as model features.
RESERVED = ("x", "y", "target", "weight", "groupcv", "groupcv_class", "class", "id")

# Columns this package adds to a training table.
BOOKKEEPING = ("key", "fold", "point_id")

# Fixed value: the number that stands for "missing" in rasters and tables.
MISSING = -9999.0

FEATURE_SCHEMA = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
        T.StructField(
            "geometry",
            T.StructType(
                [
                    T.StructField("type", T.StringType()),
                    # Raw JSON text: its depth differs between point kinds.
                    T.StructField("coordinates", T.StringType()),
                ]
            ),
        ),
    ]
)

COLLECTION_SCHEMA = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("features", T.ArrayType(FEATURE_SCHEMA)),
    ]
)

RASTER_META_SCHEMA = T.StructType(
    [
        T.StructField("raster", T.StringType(), False),
        T.StructField("n_bands", T.IntegerType(), False),
        T.StructField("width", T.IntegerType(), False),
        T.StructField("height", T.IntegerType(), False),
        T.StructField("x0", T.DoubleType(), False),
        T.StructField("y0", T.DoubleType(), False),
        T.StructField("dx", T.DoubleType(), False),
        T.StructField("dy", T.DoubleType(), False),
        T.StructField("nodata", T.DoubleType(), True),
        # Coordinate system; null for the projection in metres.
        T.StructField("crs", T.StringType(), True),
    ]
)

RASTER_CELL_SCHEMA = T.StructType(
    [
        T.StructField("raster", T.StringType(), False),
        T.StructField("band", T.IntegerType(), False),
        T.StructField("row", T.IntegerType(), False),
        T.StructField("col", T.IntegerType(), False),
        T.StructField("value", T.FloatType(), True),
    ]
)


def covariates_of(df: DataFrame) -> list[str]:
    """Feature columns of a training table, in column order."""
    skip = set(RESERVED) | set(BOOKKEEPING)
    return [c for c in df.columns if c not in skip]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
