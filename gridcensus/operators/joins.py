"""Joins of a raster with region masks, sized before they are planned."""

from __future__ import annotations

import tempfile
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridcensus.functions.grid import GridSpec

# A mask row of one run is about 40 bytes, so a broadcast stays under some 100 MB.
BROADCAST_ROWS = 2_000_000
ROW_BYTES = 40
# Raster rows of one key that a single task should meet in a shuffled join.
ROWS_PER_SLICE = 4_000_000
# Masks that a task of a shuffled join should hold. Each meets many cells, so the join's rows, and what is
# kept to sum them up, are many times as large.
TASK_BYTES = 1 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, as the session names it in spark.checkpoint.dir.

    A session in one process without one gets a temporary folder; any other session must name one.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if context.master != "local" and not context.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="gridcensus-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint to the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def measured_checkpoint(df: DataFrame, **metrics: Column) -> tuple[DataFrame, dict]:
    """Checkpoint to the shared folder, with aggregates that are taken on the way."""
    shared_folder(df.sparkSession)
    seen = Observation()
    stored = df.observe(seen, *[column.alias(name) for name, column in metrics.items()]).checkpoint(eager=True)
    return stored, seen.get


def held_bytes(df: DataFrame, row_bytes: Column | None = None) -> int:
    """Room that a table takes, by default in rows of one run; summed where the rows are."""
    return df.agg(F.sum(F.lit(ROW_BYTES) if row_bytes is None else row_bytes)).head()[0] or 0


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS, row_bytes: Column | None = None) -> bool:
    """Whether a table takes no more room than ``limit`` rows of one run."""
    return held_bytes(df, row_bytes) <= limit * ROW_BYTES


def mask_tasks(spark: SparkSession, mask_bytes: int) -> int:
    """Tasks of a shuffled join with masks of that size; the share of one does not grow with the masks."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-mask_bytes // TASK_BYTES))


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """Marked for a broadcast where its measured size allows one."""
    return F.broadcast(df) if fits_broadcast(df) else df


def hot_keys(raster: DataFrame, keys: Sequence[str], rows_per_slice: int) -> DataFrame:
    """Keys with more rows than one slice, and the number of slices each one needs.

    There are at most rows / rows_per_slice of them.
    """
    counted = raster.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    slices = F.ceil(F.col("n") / F.lit(rows_per_slice)).cast("int")
    hot = counted.where(F.col("n") > rows_per_slice)
    return cut_lineage(hot.select(*keys, slices.alias("slices")))


def join_masks(
    raster: DataFrame,
    masks: DataFrame,
    keys: Sequence[str],
    spread: Sequence[str],
    condition: Column | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    rows_per_slice: int = ROWS_PER_SLICE,
    row_bytes: Column | None = None,
    mask_bytes: int | None = None,
    spread_tasks: bool = False,
    stream_masks: bool = False,
) -> DataFrame:
    """Equi-join raster rows with mask rows on ``keys``.

    Masks that take no more room than ``broadcast_rows`` rows of one run, as measured here or given as
    ``mask_bytes``, are broadcast, so the raster is not moved. Larger ones meet it in a join on the keys
    alone, which a bucketed raster table answers in place. Only where some keys are hot do these get
    cut into slices by the ``spread`` columns, with the masks of just those keys repeated per slice. ``condition`` narrows the matches; mask columns other
    than the keys must not share a name with raster columns. With ``spread_tasks`` a shuffled join gets
    tasks by the size of its masks: Spark, which sizes tasks by what they read, would bring together
    small inputs whose join is large. A bucketed raster is then moved. With ``stream_masks`` a shuffled
    join gives all raster rows of a mask in a row, where it otherwise gives all masks of a raster row.
    """
    if mask_bytes is None:
        mask_bytes = held_bytes(masks, row_bytes)
    if mask_bytes <= broadcast_rows * ROW_BYTES:
        joined = raster.join(F.broadcast(masks), list(keys))
        return joined if condition is None else joined.where(condition)

    # sizes that Spark derives from the regions' files know nothing of exploded rows and would allow a broadcast
    masks = masks.hint("merge")
    tasks = mask_tasks(masks.sparkSession, mask_bytes) if spread_tasks else None

    def dealt(df: DataFrame, *by: str) -> DataFrame:
        return df.repartition(tasks, *by) if spread_tasks else df

    def merged(raster: DataFrame, masks: DataFrame, *by: str) -> DataFrame:
        raster, masks = dealt(raster, *by), dealt(masks, *by)
        if not stream_masks:
            return raster.join(masks.hint("merge"), list(by))
        rest = [c for df in (raster, masks) for c in df.columns if c not in by]
        return masks.join(raster.hint("merge"), list(by)).select(*by, *rest)

    hot = hot_keys(raster, keys, rows_per_slice)
    if hot.isEmpty():
        joined = merged(raster, masks, *keys)
        return joined if condition is None else joined.where(condition)

    # a table of hot keys too wide for a broadcast is joined like any other
    hot = F.broadcast(hot) if fits_broadcast(hot, broadcast_rows) else hot
    slices = F.coalesce(F.col("slices"), F.lit(1))
    sliced_raster = (
        raster.join(hot, list(keys), "left")
        .withColumn("slice", F.pmod(F.xxhash64(*spread), slices).cast("int"))
        .drop("slices")
    )
    sliced_masks = (
        masks.join(hot, list(keys), "left")
        .withColumn("slice", F.explode(F.sequence(F.lit(0), slices - 1)))
        .drop("slices")
    )
    joined = merged(sliced_raster, sliced_masks, *keys, "slice").drop("slice")
    return joined if condition is None else joined.where(condition)


def packed_bytes(packed: DataFrame) -> Column:
    """Room that a row of packed masks takes in a broadcast, where every run is a row of its own numbers."""
    numbers = len(packed.schema["runs"].dataType.elementType.fields)
    # an array's entry, the null bits and the numbers of a run; keys, array and place in the table of a row
    return F.lit(96) + (17 + 8 * numbers) * F.greatest(F.size("runs"), F.lit(0)).cast("long")


def join_packed(
    tiles: DataFrame,
    packed: DataFrame,
    grid: GridSpec,
    broadcast_rows: int = BROADCAST_ROWS,
    rows_per_slice: int = ROWS_PER_SLICE,
    mask_bytes: int | None = None,
    stream_masks: bool = False,
) -> DataFrame:
    """Tiles next to the packed masks (``runs``, NULL for a whole tile) of their keys."""
    return join_masks(
        tiles,
        packed,
        keys=["tile_col", "tile_row"],
        spread=["src"],
        broadcast_rows=broadcast_rows,
        rows_per_slice=max(1, rows_per_slice // (grid.tile_size * grid.tile_size)),
        row_bytes=packed_bytes(packed),
        mask_bytes=mask_bytes,
        stream_masks=stream_masks,
    )
