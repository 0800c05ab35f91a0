"""Scalar expressions over cell values and results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_data(value: Column) -> Column:
    """Finite values are data; NULL, NaN and infinite ones are not, in cells and tiles alike."""
    return F.coalesce(F.abs(value) < F.lit(float("inf")), F.lit(False))


def nodata_to_null(value: Column, nodata: float | None = None) -> Column:
    """NULL for values that are no data, among them the raster's own mark if it has one."""
    kept = is_data(value) if nodata is None else is_data(value) & (value != F.lit(nodata))
    return F.when(kept, value)


def band(bands: Column, index: int = 0) -> Column:
    return bands.getItem(index)


def truncate_long(value: Column) -> Column:
    """Integer part, towards zero."""
    return value.cast("bigint")


def density(population: Column, area: Column) -> Column:
    return F.try_divide(population, area)
