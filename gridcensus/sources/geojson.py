"""GeoJSON regions: feature collections, or one feature per line for large inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcensus.schemas import ADMIN0_PROPERTIES, ADMIN1_PROPERTIES, GEOMETRY, REGION_PROPERTIES

POLYGON = GEOMETRY.elementType


#: Holds a feature's text where it is not the JSON that the schema calls for.
BROKEN = "_broken"


def feature_schema(properties: T.StructType) -> T.StructType:
    """A feature whose coordinates stay text until its geometry type is known."""
    geometry = T.StructType(
        [T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())]
    )
    return T.StructType(
        [
            T.StructField("type", T.StringType()),
            T.StructField("geometry", geometry),
            T.StructField("properties", properties),
        ]
    )


def _ddl(kind: T.DataType) -> str:
    return kind.simpleString()


def _multipolygon(geometry: Column) -> Column:
    """Polygons become multipolygons of one; other geometries become NULL."""
    text = geometry["coordinates"]
    return F.when(
        geometry["type"] == "Polygon", F.array(F.from_json(text, _ddl(POLYGON)))
    ).when(geometry["type"] == "MultiPolygon", F.from_json(text, _ddl(GEOMETRY)))


def _whole(geom: Column) -> Column:
    """Whether every ring of a multipolygon is there, with two numbers for each vertex."""

    def vertex(v: Column) -> Column:
        return v.isNotNull() & (F.size(v) >= 2) & F.get(v, F.lit(0)).isNotNull() & F.get(v, F.lit(1)).isNotNull()

    def ring(vertices: Column) -> Column:
        return vertices.isNotNull() & (F.size(vertices) >= 3) & F.forall(vertices, vertex)

    def polygon(rings: Column) -> Column:
        return rings.isNotNull() & (F.size(rings) > 0) & F.forall(rings, ring)

    return F.coalesce((F.size(geom) > 0) & F.forall(geom, polygon), F.lit(False))


def _judged(features: DataFrame, properties: T.StructType) -> DataFrame:
    """Adds geom and ``flaw``: what is wrong with a feature that ought to be a region, else NULL."""
    geometry = F.col("feature.geometry")
    polygonal = F.coalesce(geometry["type"].isin("Polygon", "MultiPolygon"), F.lit(False))
    complete = F.lit(True)
    for name in properties.fieldNames():
        complete = complete & F.col(f"feature.properties.{name}").isNotNull()
    broken = F.col(f"feature.{BROKEN}").isNotNull() if BROKEN in features.schema["feature"].dataType.names else F.lit(False)
    read = features.withColumn("geom", _multipolygon(geometry))
    flaw = (
        F.when(broken, F.lit("a feature is not well-formed JSON"))
        .when(polygonal & ~complete, F.lit("a feature lacks a required property"))
        .when(polygonal & ~_whole(F.col("geom")), F.lit("a feature has broken rings"))
    )
    return read.withColumn("polygonal", polygonal).withColumn("flaw", flaw)


def _regions(features: DataFrame, properties: T.StructType, strict: bool) -> DataFrame:
    """Properties and geom of the polygonal features in a ``feature`` column.

    A flaw fails a strict read and drops the feature from a lenient one.
    """
    kept = [c for c in features.columns if c != "feature"]
    judged = _judged(features, properties)
    if strict:
        # a condition on the rows themselves, so no choice of columns leaves it out
        sound = F.when(F.col("flaw").isNotNull(), F.raise_error(F.col("flaw")).cast("boolean"))
        judged = judged.where(F.coalesce(sound, F.col("polygonal")))
    else:
        judged = judged.where(F.col("polygonal") & F.col("flaw").isNull())
    return judged.select(*kept, "feature.properties.*", "geom")


def number_regions(regions: DataFrame) -> DataFrame:
    """Adds region_id, a hash of the region's content and of its number among equal regions.

    Equal regions are alike, so a recomputed task that takes them in another order gives the same rows.
    """
    stamped = regions.withColumn("_content", F.xxhash64(*regions.columns))
    nth = F.row_number().over(Window.partitionBy("_content").orderBy("_content"))
    return stamped.withColumn("region_id", F.xxhash64("_content", nth)).drop("_content")


def _features(lines: DataFrame, properties: T.StructType, column: str) -> DataFrame:
    """The lines' features; blank lines are none. A malformed line keeps its text in the feature."""
    schema = _ddl(feature_schema(properties).add(BROKEN, T.StringType()))
    feature = F.from_json(F.col(column), schema, {"columnNameOfCorruptRecord": BROKEN})
    kept = [c for c in lines.columns if c != column]
    return lines.where(F.trim(column) != "").select(*kept, feature.alias("feature"))


def parse_features(
    lines: DataFrame, properties: T.StructType, column: str = "value", strict: bool = False
) -> DataFrame:
    """Regions from a table with one feature's JSON text per row; other columns are kept."""
    return _regions(_features(lines, properties, column), properties, strict)


def read_feature_lines(
    spark: SparkSession, path: str, properties: T.StructType, strict: bool = False
) -> DataFrame:
    """Regions from line-delimited GeoJSON; the files split among tasks."""
    return number_regions(parse_features(spark.read.text(path), properties, strict=strict))


def read_feature_collection(
    spark: SparkSession, path: str, properties: T.StructType, strict: bool = False
) -> DataFrame:
    """Regions from FeatureCollection files. A file is one JSON value, so one task reads it.

    A file that is not a whole JSON value, a truncated one for instance, fails every read.
    """
    schema = T.StructType(
        [T.StructField("features", T.ArrayType(feature_schema(properties)))]
    )
    reader = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST")
    features = reader.json(path).select(F.explode("features").alias("feature"))
    return number_regions(_regions(features, properties, strict))


def count_dropped(lines: DataFrame, properties: T.StructType, column: str = "value") -> DataFrame:
    """How many lines are polygonal features, and how many a lenient read drops.

    Dropped are lines that are not well-formed, and polygonal features with broken rings or without
    a required property.
    """
    return _judged(_features(lines, properties, column), properties).agg(
        F.count(F.when(F.col("polygonal"), 1)).alias("n_polygonal"), F.count("flaw").alias("n_dropped")
    )


def read_regions(
    spark: SparkSession, path: str, properties: T.StructType, strict: bool = False, lines: bool = False
) -> DataFrame:
    """Regions from feature collections, or with ``lines`` from files of one feature per line."""
    read = read_feature_lines if lines else read_feature_collection
    return read(spark, path, properties, strict)


def read_admin1(spark: SparkSession, path: str, strict: bool = False, lines: bool = False) -> DataFrame:
    return read_regions(spark, path, ADMIN1_PROPERTIES, strict, lines)


def read_admin0(spark: SparkSession, path: str, strict: bool = False, lines: bool = False) -> DataFrame:
    return read_regions(spark, path, ADMIN0_PROPERTIES, strict, lines)


def read_named_regions(spark: SparkSession, path: str, strict: bool = False, lines: bool = False) -> DataFrame:
    return read_regions(spark, path, REGION_PROPERTIES, strict, lines)
