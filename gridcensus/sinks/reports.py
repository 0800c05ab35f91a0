"""Reports of region summaries as CSV, GeoJSON and JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcensus.functions.values import truncate_long
from gridcensus.operators.zonal import quantile_breaks

# Fixed value: columns of the Admin-1 report.
ADMIN_HEADER = (
    "adm1_code", "adm0_a3", "population", "density", "min", "max", "mean", "median", "mode", "stddev",
)
STATISTICS = {
    "min": "zmin", "max": "zmax", "mean": "mean", "median": "median", "mode": "mode", "stddev": "stddev",
}


def _text(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("null"))


def admin_csv(result: DataFrame, digits: int | None = None) -> DataFrame:
    """Report rows as text; a missing statistic reads ``null``."""

    def statistic(name: str) -> Column:
        value = F.col(STATISTICS[name])
        return _text(value if digits is None else F.round(value, digits))

    return result.select(
        "adm1_code",
        "adm0_a3",
        truncate_long(F.col("population")).cast("string").alias("population"),
        truncate_long(F.col("density")).cast("string").alias("density"),
        *[statistic(name).alias(name) for name in STATISTICS],
    )


def write_admin_csv(result: DataFrame, output: str) -> None:
    admin_csv(result).write.option("header", True).csv(output + ".csv")


def admin_geojson(result: DataFrame) -> DataFrame:
    """One GeoJSON Feature per row, in column ``value``. ``result`` carries ``geom``."""
    stats = F.when(
        F.col("zmin").isNotNull(),
        F.struct("zmin", "zmax", "mean", "median", "mode", "stddev"),
    )
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("MultiPolygon").alias("type"), F.col("geom").alias("coordinates")).alias(
            "geometry"
        ),
        F.struct(
            "adm1_code",
            "adm0_a3",
            truncate_long(F.col("population")).alias("population"),
            "density",
            stats.alias("stats"),
        ).alias("properties"),
    )
    return result.select(F.to_json(feature, {"ignoreNullFields": "false"}).alias("value"))


def write_admin_geojson(result: DataFrame, output: str) -> None:
    admin_geojson(result).write.text(output + ".geojson")


def admin_breaks(result: DataFrame, n: int = 10) -> DataFrame:
    """Quantile breaks of whole populations and of densities over regions, as one row."""
    counted = result.select(
        truncate_long(F.col("population")).cast("double").alias("population"), "density"
    )
    return quantile_breaks(counted, ["population", "density"], n)


def quantile_json(result: DataFrame, n: int = 10) -> DataFrame:
    breaks = admin_breaks(result, n)
    return breaks.select(F.to_json(F.struct("population", "density"), {"pretty": "true"}).alias("value"))


def write_quantile_json(result: DataFrame, output: str) -> None:
    quantile_json(result).write.text(output + "_quantile.json")


def region_csv(result: DataFrame) -> DataFrame:
    return result.select(
        "location_name", truncate_long(F.col("population")).alias("population")
    )


def write_region_csv(result: DataFrame, output: str) -> None:
    region_csv(result).write.option("header", True).option("encoding", "UTF-8").csv(output)
