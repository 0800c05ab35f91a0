"""Country catalog: codes, names, selections and raster locations.

The catalog is a table the user supplies, with columns code and name; the attribute file adds
the join attribute.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcensus.schemas import COUNTRIES, COUNTRY_ATTRIBUTES


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Headerless CSV of code, name."""
    return spark.read.schema(COUNTRIES).csv(path)


def read_attributes(spark: SparkSession, path: str) -> DataFrame:
    """Headerless CSV of name, code, join attribute."""
    return spark.read.schema(COUNTRY_ATTRIBUTES).csv(path)


def parse_attributes(lines: DataFrame, column: str = "value") -> DataFrame:
    """The same from a table of CSV lines."""
    parsed = F.from_csv(F.col(column), COUNTRY_ATTRIBUTES.simpleString()[7:-1].replace(":", " "))
    return lines.select(parsed.alias("row")).select("row.*")


def clean_code(code: Column) -> Column:
    return F.upper(code)


def resolve_codes(
    requests: DataFrame, catalog: DataFrame, code: str = "code", strict: bool = True
) -> DataFrame:
    """Requests with the upper-cased code, the catalog name and whether the code is known.

    An unknown code fails a strict job; a lenient one keeps it with known = false.
    """
    cleaned = requests.withColumn(code, clean_code(F.col(code)))
    names = catalog.select(F.col("code").alias(code), F.col("name"))
    joined = cleaned.join(names, code, "left").withColumn("known", F.col("name").isNotNull())
    if not strict:
        return joined
    # the check sits in the code itself, so no choice of columns leaves it out
    failure = F.raise_error(F.concat(F.lit("unknown country code "), F.coalesce(code, F.lit("NULL"))))
    return joined.withColumn(code, F.when(F.col("known"), F.col(code)).otherwise(failure.cast("string")))


def include(df: DataFrame, wanted: Sequence[str] | DataFrame | None, code: str = "code") -> DataFrame:
    """Only wanted codes; None keeps all. A list becomes a filter the scan can prune with."""
    if wanted is None:
        return df
    if isinstance(wanted, DataFrame):
        return df.join(wanted.select(code), code, "left_semi")
    return df.where(F.col(code).isin(list(wanted)))


def exclude(df: DataFrame, unwanted: Sequence[str] | DataFrame | None, code: str = "code") -> DataFrame:
    """All but unwanted codes."""
    if unwanted is None:
        return df
    if isinstance(unwanted, DataFrame):
        return df.join(unwanted.select(code), code, "left_anti")
    return df.where(~F.col(code).isin(list(unwanted)))


def source_ids(sources: DataFrame, codes: Sequence[str]) -> list[int]:
    """Numbers of all sources of the given codes, code by code; unknown codes fail.

    ``sources`` has src and code. Brings back the rasters of the codes asked for; for very many of
    them hand ``sources_of`` to ``include`` instead.
    """
    numbers: dict[str, list[int]] = {code.upper(): [] for code in codes}
    for row in sources_of(sources, codes).collect():
        numbers[row["code"]].append(row["src"])
    missing = sorted(code for code, found in numbers.items() if not found)
    if missing:
        raise ValueError(f"unknown country codes {missing}")
    return [src for found in numbers.values() for src in sorted(found)]


def sources_of(sources: DataFrame, codes: Sequence[str]) -> DataFrame:
    """(code, src) of every source that the given codes have."""
    wanted = [code.upper() for code in codes]
    return sources.select(clean_code(F.col("code")).alias("code"), "src").where(F.col("code").isin(wanted)).distinct()


def source_url(base: str, code: Column, suffix: str = "_ppp_2020.tif") -> Column:
    """Location of a country's raster: base/{CODE}/{code in lower case}{suffix}."""
    upper = clean_code(code)
    return F.concat_ws("/", F.lit(base), upper, F.concat(F.lower(upper), F.lit(suffix)))
