"""What the zonal jobs do to their raster and masks before they count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcensus.functions.grid import GridSpec
from gridcensus.operators import mask
from gridcensus.operators.hierarchy import mask_hierarchy
from gridcensus.operators.joins import measured_checkpoint, packed_bytes
from gridcensus.operators.reading import read_spans, shifted_grid
from gridcensus.operators.regions import part_bounds
from gridcensus.operators.tiles import rebalance
from gridcensus.sources import catalog
from gridcensus.sources.rasters import within


def choose(
    raster: DataFrame,
    sources: DataFrame,
    include: Sequence[int] | DataFrame | None,
    exclude: Sequence[int] | DataFrame | None,
    partitions: int | None,
) -> tuple[DataFrame, DataFrame]:
    """The chosen sources' raster and extents; lists or tables with a column src choose.

    ``partitions`` spreads the raster over that many tasks, which is a shuffle.
    """
    raster = catalog.exclude(catalog.include(raster, include, "src"), exclude, "src")
    sources = catalog.exclude(catalog.include(sources, include, "src"), exclude, "src")
    return (raster if partitions is None else rebalance(raster, partitions)), sources


def is_packed(raster: DataFrame) -> bool:
    return bool({"cells", "sums"} & set(raster.columns))


def cell_spans(parts: DataFrame, grid: GridSpec, source: GridSpec, merge_parts: bool) -> DataFrame:
    """Runs of source cells under each part, or under each region once, cut at tile borders."""
    spans = mask.part_spans(parts, grid)
    spans = mask.region_spans(spans) if merge_parts else spans
    return mask.clip_spans(spans if source == grid else read_spans(spans, grid, source), source)


def packed_masks(
    raster: DataFrame, parts: DataFrame, grid: GridSpec, source: GridSpec, merge_parts: bool
) -> tuple[DataFrame, DataFrame, int]:
    """Packed tiles that a region can meet, the packed masks of their grid, checkpointed, and their bytes.

    Masks are made coarse to fine where the source's cells are the job's cells under other numbers;
    where distances change between the regions, runs are cut at those places. Either way the raster
    keeps its own grid and stays packed. Only packed rows are stored. Their size and the tiles they
    reach are measured while they are written, so that is the one job of a plan, besides the regions'
    bounds for a raster of another grid.
    """
    same = grid
    if source != grid:
        bounds = part_bounds(parts)
        same = source if bounds is None else shifted_grid(grid, source, bounds)
    if same is not None:
        packed = mask_hierarchy(parts, same, merge_parts)
    else:
        packed = mask.pack_masks(cell_spans(parts, grid, source, merge_parts), source)
    ends = {f"{end.__name__}_{c}": end(f"tile_{c}") for c in ("col", "row") for end in (F.min, F.max)}
    stored, seen = measured_checkpoint(packed, n_bytes=F.sum(packed_bytes(packed)), **ends)
    if seen["n_bytes"] is None:
        return raster.where("false"), stored, 0
    window = (seen["min_col"], seen["min_row"], seen["max_col"], seen["max_row"])
    return within(raster, window), stored, seen["n_bytes"]
