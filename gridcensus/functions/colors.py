"""Colour classes for rendered cells. Colours are RGBA integers in BIGINT columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Class breaks and palettes.
GLOBAL_BREAKS = (1, 2, 5, 10, 20, 50, 100, 200, 1000)
TWOFOLD_BREAKS = (1, 2, 4, 8, 16, 32, 64, 128, 256, 512, 1025, 2048)
BLUE_RAMP = (
    0xFFF7FBFF, 0xECE7F2FF, 0xD0D1E6FF, 0xA6BDDBFF, 0x74A9CFFF, 0x3690C0FF, 0x0570B0FF, 0x034E7BFF,
)
ORANGE_NINE = (
    0x00000000, 0xFEE6CEFF, 0xFDD0A2FF, 0xFDAE6BFF, 0xFD8D3CFF, 0xF16913FF, 0xD94801FF, 0xA63603FF,
    0x7F2704FF,
)
BLUE_NINE = (
    0x000000, 0xDFECF8, 0xC8DDF0, 0xA3CCE3, 0x73B3D8, 0x4A97C9, 0x2879B9, 0x0D58A1, 0x08306B,
)

TRANSPARENT = 0
MAP_COLORS = (TRANSPARENT, *BLUE_RAMP)


def stable(value: Column) -> Column:
    """A mean to six digits, so that the order of its sum cannot move it over a class break."""
    return F.floor(value * F.lit(1e6) + F.lit(0.5)) / F.lit(1e6)


def classify(
    value: Column,
    colors: Sequence[int] = MAP_COLORS,
    breaks: Sequence[float] = GLOBAL_BREAKS,
    nodata: int = TRANSPARENT,
) -> Column:
    """Colour of the first class whose break is not below the value.

    Values above the last break take the last colour, as do classes past the palette's end.
    """
    color = F.when(value.isNull() | F.isnan(value), F.lit(nodata).cast("bigint"))
    for i, limit in enumerate(breaks):
        shade = colors[min(i, len(colors) - 1)]
        color = color.when(value <= F.lit(float(limit)), F.lit(shade).cast("bigint"))
    last = colors[min(len(breaks), len(colors)) - 1]
    return color.otherwise(F.lit(last).cast("bigint"))


def classify_arrays(
    colors: Sequence[int] = MAP_COLORS,
    breaks: Sequence[float] = GLOBAL_BREAKS,
    nodata: int = TRANSPARENT,
) -> Callable[[Column], Column]:
    """``classify`` of ``stable`` values for a column of packed cells, an array at a time."""
    limits = np.asarray(breaks, dtype=float)
    shades = [colors[min(i, len(breaks) - 1, len(colors) - 1)] for i in range(len(breaks) + 1)]
    palette = np.asarray(shades, dtype=np.int64)

    def shade(cells: np.ndarray) -> np.ndarray:
        values = np.floor(np.asarray(cells, dtype=float) * 1e6 + 0.5) / 1e6
        return np.where(np.isnan(values), nodata, palette[np.searchsorted(limits, values)])

    def shade_all(cells: pd.Series) -> pd.Series:
        return cells.map(shade)

    return F.pandas_udf(shade_all, "array<bigint>")


def channels(rgba: Column) -> Column:
    """[red, green, blue, alpha] of a colour."""
    return F.array(
        *[F.shiftright(rgba, shift).bitwiseAND(F.lit(255)).cast("int") for shift in (24, 16, 8, 0)]
    )


def tile_path(output: str, zoom: Column, col: Column, row: Column, suffix: str = "png") -> Column:
    return F.format_string(f"%s/%d/%d/%d.{suffix}", F.lit(output), zoom, col, row)
