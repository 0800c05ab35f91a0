"""Aggregates of masked cells by region."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcensus.operators import states
from gridcensus.operators.histograms import bins_array, flat_bins, fold_runs, key_codes, list_sizes, merge_in_turn

DISTRIBUTION_BINS = 64
MEDIAN_ACCURACY = 10_000
BREAK_ACCURACY = 100_000
# Masked cells that a task sums up at a time.
STEP_ROWS = 1 << 20


def zonal_sum(masked: DataFrame, keys: Sequence[str] = ("region_id",)) -> DataFrame:
    return masked.groupBy(*keys).agg(
        F.sum("value").alias("population"), F.count("value").alias("n_cells")
    )


def zonal_summary(
    masked: DataFrame, keys: Sequence[str] = ("region_id",), bins: int = DISTRIBUTION_BINS
) -> DataFrame:
    """Population and its mergeable distribution sketch, in one pass.

    A task sums up some rows at a time by key, whatever the number of keys, and only these sums and
    sketches are shuffled and merged; values are neither sorted nor moved.
    """
    keys = list(keys)
    made = masked.select(*keys, F.col("value").cast("double").alias("value"))

    def summary(rows: pa.RecordBatch) -> pa.RecordBatch:
        code = key_codes(rows, keys)
        first = np.zeros(int(code.max()) + 1, dtype=np.int64)
        first[code[::-1]] = np.arange(len(code))[::-1]
        value = rows["value"]
        valid = value.is_valid().to_numpy(zero_copy_only=False)
        values, owner = value.to_numpy(zero_copy_only=False)[valid], code[valid]
        total = np.bincount(owner, weights=values, minlength=len(first))
        empty = np.bincount(owner, minlength=len(first)) == 0
        bins_of = bins_array(*states.sketch_many(owner, values, np.ones(len(owner)), bins), len(first))
        of = pa.array(first)
        return pa.RecordBatch.from_arrays([*[rows[k].take(of) for k in keys], pa.array(total, mask=empty), bins_of], names)

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= STEP_ROWS:
                yield summary(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                held, n = [], 0
        if held:
            yield summary(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    def fold(batch: pa.RecordBatch, owner: np.ndarray) -> list[pa.Array]:
        total, sketch, n = batch["population"], batch["distribution"], int(owner[-1]) + 1
        valid = total.is_valid().to_numpy(zero_copy_only=False)
        summed = np.bincount(owner[valid], weights=total.to_numpy(zero_copy_only=False)[valid], minlength=n)
        empty = np.bincount(owner[valid], minlength=n) == 0
        return [pa.array(summed, mask=empty), bins_array(*merge_in_turn(owner, list_sizes(sketch), *flat_bins(sketch), bins), n)]

    names = [*keys, "population", "distribution"]
    types = ", ".join(f"`{k}` {made.schema[k].dataType.simpleString()}" for k in keys)
    schema = f"{types}, population double, distribution array<struct<x double, y double>>"
    partial = made.mapInArrow(some, schema).repartition(*keys).sortWithinPartitions(*keys)
    merged = partial.mapInArrow(fold_runs(keys, fold), schema)
    kind = masked.agg(F.sum("value").alias("s")).schema["s"].dataType
    return merged.select(
        *keys, F.col("population").cast(kind).alias("population"),
        F.when(F.size("distribution") > 0, F.col("distribution")).alias("distribution"),
    )


def statistics() -> list[Column]:
    """Moments and order statistics that combine partially; the mode has its own operator."""
    value = F.col("value")
    return [
        F.min(value).alias("zmin"),
        F.max(value).alias("zmax"),
        F.avg(value).alias("mean"),
        F.percentile_approx(value, 0.5, MEDIAN_ACCURACY).alias("median"),
        F.stddev_pop(value).alias("stddev"),
    ]


def zonal_mode(masked: DataFrame, keys: Sequence[str] = ("region_id",)) -> DataFrame:
    """Most frequent value, the smallest on a tie.

    Values are counted per key first, so no task holds all values of a large region.
    """
    counted = masked.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n"))
    rank = F.struct(F.col("n"), (-F.col("value")).alias("low"))
    return counted.groupBy(*keys).agg(F.max_by("value", rank).alias("mode"))


def distribution_mode(distribution: Column) -> Column:
    """Centre of the fullest bin of a sketch, the lowest on a tie: a mode without a second pass."""
    start = F.struct(F.lit(None).cast("double").alias("x"), F.lit(0.0).alias("y"))
    fullest = F.aggregate(
        distribution,
        start,
        lambda best, b: F.when(
            b["y"] > best["y"], F.struct(b["x"].alias("x"), b["y"].alias("y"))
        ).otherwise(best),
    )
    return fullest["x"]


def zonal_stats(masked: DataFrame, keys: Sequence[str] = ("region_id",)) -> DataFrame:
    keys = list(keys)
    base = masked.groupBy(*keys).agg(
        F.sum("value").alias("population"), F.count("value").alias("n_cells"), *statistics()
    )
    return base.join(zonal_mode(masked, keys), keys)


def combine_sums(partials: DataFrame, keys: Sequence[str] = ("region_id",)) -> DataFrame:
    """Merge per-tile partial sums into one row per key."""
    return partials.groupBy(*keys).agg(
        F.sum("population").alias("population"),
        F.sum("n_cells").alias("n_cells"),
        F.count(F.lit(1)).alias("n_partials"),
    )


def visited_regions(candidates: DataFrame, source_keys: DataFrame) -> DataFrame:
    """Regions that meet at least one source tile, with the number of (tile, source) visits."""
    sources = source_keys.groupBy("tile_col", "tile_row").agg(
        F.count(F.lit(1)).alias("n_sources")
    )
    return (
        candidates.join(sources, ["tile_col", "tile_row"])
        .groupBy("region_id")
        .agg(F.sum("n_sources").alias("n_tiles"))
    )


def zonal_outcome(regions: DataFrame, visited: DataFrame, sums: DataFrame) -> DataFrame:
    """Every region with its outcome: ``absent`` (no tile met), ``empty`` (no data cell) or ``value``."""
    outcome = (
        F.when(F.col("n_tiles").isNull(), F.lit("absent"))
        .when(F.col("n_cells").isNull(), F.lit("empty"))
        .otherwise(F.lit("value"))
    )
    return (
        regions.select("region_id")
        .join(visited, "region_id", "left")
        .join(sums, "region_id", "left")
        .select(
            "region_id",
            outcome.alias("outcome"),
            F.coalesce("n_tiles", F.lit(0)).alias("n_tiles"),
            F.coalesce("n_cells", F.lit(0)).alias("n_cells"),
            F.coalesce("population", F.lit(0.0)).alias("population"),
        )
    )


def quantile_breaks(df: DataFrame, columns: Sequence[str], n: int = 10) -> DataFrame:
    """One row with ``n`` quantile breaks of each column, every row weighing one."""
    shares = F.array(*[F.lit((i + 1) / n) for i in range(n)])
    return df.agg(
        *[F.percentile_approx(F.col(c), shares, BREAK_ACCURACY).alias(c) for c in columns]
    )
