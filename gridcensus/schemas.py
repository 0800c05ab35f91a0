"""Explicit schemas of the tables the package reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

# polygon -> ring -> vertex -> [x, y]; ring 0 of a polygon is its shell, the others are holes
GEOMETRY = T.ArrayType(T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType()))))

RASTER_CELLS = T.StructType(
    [
        T.StructField("src", T.IntegerType()),
        T.StructField("col", T.IntegerType()),
        T.StructField("row", T.IntegerType()),
        T.StructField("value", T.DoubleType()),
    ]
)

RASTER_TILES = T.StructType(
    [
        T.StructField("src", T.IntegerType()),
        T.StructField("tile_col", T.IntegerType()),
        T.StructField("tile_row", T.IntegerType()),
        T.StructField("cells", T.ArrayType(T.DoubleType())),
    ]
)

COUNTRIES = T.StructType(
    [T.StructField("code", T.StringType()), T.StructField("name", T.StringType())]
)

COUNTRY_ATTRIBUTES = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("code", T.StringType()),
        T.StructField("join_attribute", T.StringType()),
    ]
)

ADMIN1_PROPERTIES = T.StructType(
    [T.StructField("adm1_code", T.StringType()), T.StructField("adm0_a3", T.StringType())]
)

ADMIN0_PROPERTIES = T.StructType([T.StructField("adm0_a3", T.StringType())])

REGION_PROPERTIES = T.StructType([T.StructField("location_name", T.StringType())])

DISTRIBUTION = T.ArrayType(
    T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
)
