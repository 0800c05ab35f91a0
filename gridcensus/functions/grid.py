"""Grid arithmetic: cells, tiles, layouts and Web Mercator zoom levels."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Half the side of the Web Mercator square in metres, and the latitude of its top.
MERCATOR_HALF = 20037508.342789244
MERCATOR_MAX_LAT = 85.05112877980659


def tile_of(index: Column, tile_size: int) -> Column:
    """Tile number holding a cell number."""
    return F.floor(index / F.lit(tile_size)).cast("int")


@dataclass(frozen=True)
class GridSpec:
    """A north-up grid of equal cells, cut into square tiles from its upper left corner."""

    xmin: float
    ymin: float
    xmax: float
    ymax: float
    cell_width: float
    cell_height: float
    tile_size: int

    @property
    def cols(self) -> int:
        return math.floor((self.xmax - self.xmin) / self.cell_width + 0.5)

    @property
    def rows(self) -> int:
        return math.floor((self.ymax - self.ymin) / self.cell_height + 0.5)

    @property
    def layout_cols(self) -> int:
        return -(-self.cols // self.tile_size)

    @property
    def layout_rows(self) -> int:
        return -(-self.rows // self.tile_size)

    @property
    def tile_width(self) -> float:
        return self.cell_width * self.tile_size

    @property
    def tile_height(self) -> float:
        return self.cell_height * self.tile_size

    def center_x(self, col: Column) -> Column:
        return F.lit(self.xmin) + (col + F.lit(0.5)) * F.lit(self.cell_width)

    def center_y(self, row: Column) -> Column:
        return F.lit(self.ymax) - (row + F.lit(0.5)) * F.lit(self.cell_height)

    def col_at(self, x: Column) -> Column:
        return F.floor((x - F.lit(self.xmin)) / F.lit(self.cell_width)).cast("int")

    def row_at(self, y: Column) -> Column:
        return F.floor((F.lit(self.ymax) - y) / F.lit(self.cell_height)).cast("int")

    def tile_of(self, index: Column) -> Column:
        return tile_of(index, self.tile_size)

    def cell_index(self, col: Column, row: Column) -> Column:
        """Row-major position of a cell in its tile's array, from 0."""
        size = F.lit(self.tile_size)
        return F.pmod(row, size) * size + F.pmod(col, size)

    def tile_extent(self, tile_col: Column, tile_row: Column) -> dict[str, Column]:
        """Extent of a tile; tiles at the right and bottom may reach past the grid."""
        west = F.lit(self.xmin) + tile_col * F.lit(self.tile_width)
        north = F.lit(self.ymax) - tile_row * F.lit(self.tile_height)
        return {
            "xmin": west,
            "ymin": north - F.lit(self.tile_height),
            "xmax": west + F.lit(self.tile_width),
            "ymax": north,
        }


# The global 100 m job grid with 512-cell tiles.
GLOBAL_100M = GridSpec(-180.0, -90.0, 180.0, 90.0, 8.3333333e-4, 8.3333333e-4, 512)


def layout_columns(
    xmin: Column,
    ymin: Column,
    xmax: Column,
    ymax: Column,
    cell_width: Column,
    cell_height: Column,
    tile_size: Column,
) -> dict[str, Column]:
    """Cell and tile counts of the layout over an extent, for many grids at once."""
    grid_cols = F.floor((xmax - xmin) / cell_width + F.lit(0.5)).cast("int")
    grid_rows = F.floor((ymax - ymin) / cell_height + F.lit(0.5)).cast("int")
    layout_cols = F.ceil(grid_cols / tile_size).cast("int")
    layout_rows = F.ceil(grid_rows / tile_size).cast("int")
    return {
        "grid_cols": grid_cols,
        "grid_rows": grid_rows,
        "layout_cols": layout_cols,
        "layout_rows": layout_rows,
        "cols": (layout_cols * tile_size).cast("int"),
        "rows": (layout_rows * tile_size).cast("int"),
    }


@dataclass(frozen=True)
class ZoomLevel:
    """The Web Mercator square at one zoom: 2^zoom tiles on each axis."""

    zoom: int
    tile_size: int = 256

    @property
    def tiles(self) -> int:
        return 1 << self.zoom

    @property
    def pixels(self) -> int:
        return self.tiles * self.tile_size

    @property
    def pixel_metres(self) -> float:
        return 2.0 * MERCATOR_HALF / self.pixels


def zoom_tile(x: Column, y: Column, zoom: Column | int) -> tuple[Column, Column]:
    """Zoomed tile (col, row) of a Web Mercator point; NULL outside the square."""
    zoom = F.lit(zoom) if isinstance(zoom, int) else zoom
    tiles = F.pow(F.lit(2.0), zoom)
    side = F.lit(2.0 * MERCATOR_HALF)
    col = F.floor((x + F.lit(MERCATOR_HALF)) / side * tiles).cast("int")
    row = F.floor((F.lit(MERCATOR_HALF) - y) / side * tiles).cast("int")
    inside = (F.abs(x) <= F.lit(MERCATOR_HALF)) & (F.abs(y) <= F.lit(MERCATOR_HALF))
    last = (tiles - 1).cast("int")
    return F.when(inside, F.least(col, last)), F.when(inside, F.least(row, last))
