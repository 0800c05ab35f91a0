"""Coarse-to-fine masks, running sums, covered shares, states, key ranges, other cell sizes and refreshes."""

import math
import os
import random

import micro
import numpy as np
import pytest
from micro import GRID, block, square
from pyspark.sql import functions as F

from gridcensus.functions.grid import GridSpec, ZoomLevel
from gridcensus.operators import (
    curve,
    families,
    hierarchy,
    histograms,
    joins,
    mask,
    prefix,
    regions as region_ops,
    resample,
    shares,
    sketches,
    states,
    tiles as tile_ops,
    zonal,
)
from gridcensus.operators.block_tiles import warp_levels
from gridcensus.operators.reading import read_axes, read_spans
from gridcensus.plans.admin_population import admin1_population
from gridcensus.plans.region_population import region_population
from gridcensus.plans.render_pyramid import tile_levels
from gridcensus.plans.render_refresh import refresh_levels, source_tiles_of, stale_tiles
from gridcensus.sources import geojson


def star(rng, x, y, radius, corners, turn=1):
    """A ring around (x, y), to the left with turn 1."""
    angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(corners))[::turn]
    radii = [radius * rng.uniform(0.6, 1) for _ in angles]
    return [[x + r * math.cos(a), y + r * math.sin(a)] for a, r in zip(angles, radii, strict=True)]


def shapes(spark, seed=3):
    rng = random.Random(seed)
    named = {
        "holed": [[star(rng, 5.3, 2.1, 40, 14), star(rng, 5.3, 2.1, 9, 6)]],
        "two": [[square(-60.3, -40.2, 50)], [square(-40.1, -20.4, 55)]],
        "small": [[square(100.2, 10.3, 0.4)]],
        "right": [[star(rng, -100.7, 33.3, 25, 9, -1)]],
    }
    return micro.regions(spark, named)


def dots(spark, seed=4, n=6000, nan=True):
    """Cells of two sources with fractions, some without data."""
    rng = random.Random(seed)
    rows = {(rng.randrange(2), rng.randrange(40, 330), rng.randrange(20, 160)): rng.random() * 100 for _ in range(n)}
    odd = [None, float("nan"), float("inf")] if nan else [1.0]
    return micro.cells(spark, [(*k, rng.choice(odd) if i % 11 == 0 else v) for i, (k, v) in enumerate(rows.items())])


def covered(packed, grid, keys):
    """{keys: {(col, row): times}} of packed masks."""
    found = {}
    for m in packed.collect():
        cells = found.setdefault(tuple(m[k] for k in keys), {})
        size = grid.tile_size
        for start, length in [(r["start"], r["length"]) for r in m["runs"]] if m["runs"] is not None else [(1, size * size)]:
            for i in range(start - 1, start - 1 + length):
                place = (m["tile_col"] * size + i % size, m["tile_row"] * size + i // size)
                cells[place] = cells.get(place, 0) + 1
    return found


# --- masks -----------------------------------------------------------------------------------


@pytest.mark.parametrize("merge", [False, True])
def test_hierarchy_covers_what_the_scanline_covers(spark, merge):
    parts = region_ops.explode_parts(shapes(spark))
    spans = mask.part_spans(parts, GRID)
    spans = mask.region_spans(spans) if merge else spans
    keys = ["region_id"] if merge else ["region_id", "part"]
    packed = hierarchy.mask_hierarchy(parts, GRID, merge_parts=merge)
    assert covered(packed, GRID, keys) == covered(mask.pack_masks(mask.clip_spans(spans, GRID), GRID), GRID, keys)


def test_no_run_is_made_for_a_whole_tile(spark):
    parts = region_ops.explode_parts(micro.regions(spark, {"a": [[square(-100.5, -50.5, 120)]]}))
    pieces = hierarchy.border_pieces(parts, GRID, mask.part_spans(parts, GRID))
    whole = hierarchy.whole_tiles(parts, GRID)
    assert whole.count() > 20
    assert pieces.join(whole, ["region_id", "part", "tile_col", "tile_row"], "left_semi").isEmpty()
    # and no more than a run per row of a border tile
    edges = region_ops.part_edges(parts)
    assert pieces.count() <= 16 * region_ops.edge_tiles(edges, GRID).distinct().count()


# --- running sums ----------------------------------------------------------------------------


def test_running_sums_equal_sums_of_cells_without_a_row_per_cell(spark):
    parts = region_ops.explode_parts(shapes(spark))
    packed = hierarchy.mask_hierarchy(parts, GRID, merge_parts=True)
    tiles = tile_ops.pack_tiles(dots(spark), 16)
    running = prefix.prefix_tiles(tiles, 16)
    sums = prefix.zonal_sum_prefix(running, packed, GRID)
    spans = mask.clip_spans(mask.region_spans(mask.part_spans(parts, GRID)), GRID)
    exact = {r["region_id"]: r for r in zonal.zonal_sum(mask.mask_cells(dots(spark), spans, GRID)).collect()}
    got = {r["region_id"]: r for r in sums.collect()}
    assert got.keys() == exact.keys()
    for key, row in exact.items():
        assert got[key]["n_cells"] == row["n_cells"]
        assert got[key]["population"] == pytest.approx(row["population"], rel=1e-12)
    stored = joins.cut_lineage(running)
    plan = micro.plan(prefix.tile_sums(stored, joins.cut_lineage(packed), GRID))
    assert "Generate" not in plan and "MapInArrow" not in plan


def test_jobs_on_tiles_make_no_row_per_cell_and_read_tiles_once(spark, tmp_path):
    regions, path = shapes(spark), str(tmp_path / "tiles")
    tile_ops.save_tiles(tile_ops.pack_tiles(dots(spark, nan=False), 16), path, 16)
    stored = spark.read.parquet(path)
    extents = micro.sources(spark, (0, -180, -90, 180, 90), (1, -180, -90, 180, 90))
    for job in (admin1_population(regions, stored, extents, GRID), region_population(regions, stored, extents, GRID)):
        plan = micro.plan(job)
        assert "explode(cells" not in plan and "flatten(" not in plan
        assert sum("FileScan" in line and "cells#" in line for line in plan.split("\n")) == 1


# --- covered shares --------------------------------------------------------------------------


def share_of(spark, named, grid=GRID):
    """{region: {(col, row): share}}."""
    parts = region_ops.explode_parts(micro.regions(spark, named))
    found = {}
    for s in shares.share_spans(parts, grid).collect():
        cells = found.setdefault(s["region_id"], {})
        for col in range(s["c0"], s["c1"] + 1):
            assert (col, s["row"]) not in cells
            cells[col, s["row"]] = s["share"]
    return found


def test_shares_of_regions_that_tile_the_world_add_up_to_one(spark):
    rng = random.Random(6)
    xs = [-180.0, *sorted(rng.uniform(-170, 170) for _ in range(5)), 180.0]
    tops = [rng.uniform(-60, 60) for _ in xs]
    named = {}
    for i in range(len(xs) - 1):
        a, b, ya, yb = xs[i], xs[i + 1], tops[i], tops[i + 1]
        named[f"n{i}"] = [[[[a, ya], [b, yb], [b, 90.0], [a, 90.0]]]]
        named[f"s{i}"] = [[[[a, ya], [b, yb], [b, -90.0], [a, -90.0]]]]  # turns the other way
    total = np.zeros((GRID.rows, GRID.cols))
    for cells in share_of(spark, named).values():
        for (col, row), share in cells.items():
            assert 0 < share <= 1
            total[row, col] += share
    assert np.abs(total - 1).max() < 1e-9


def test_shares_add_up_to_the_area_with_holes_and_beyond_the_grid(spark):
    rng = random.Random(9)
    outer, hole = star(rng, 10, 5, 30, 24), star(rng, 10, 5, 5, 9)
    area = lambda p: abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(p, p[1:] + p[:1]))) / 2
    small = GridSpec(0.0, -10.0, 20.0, 10.0, 0.5, 0.5, 8)
    found = share_of(spark, {"a": [[outer, hole]], "b": [[outer, hole[::-1]]], "w": [[square(-5.0, -15.0, 40)]]}, small)
    everywhere = share_of(spark, {"a": [[outer, hole]]})
    assert sum(everywhere[0].values()) == pytest.approx(area(outer) - area(hole), rel=1e-9)
    assert found[0] == pytest.approx(found[1])
    assert len(found[2]) == small.cols * small.rows and set(found[2].values()) == {1.0}
    for (col, row), share in found[0].items():
        assert share == pytest.approx(inside_share(outer, hole, small, col, row), abs=0.02)


def inside_share(outer, hole, grid, col, row, n=40):
    """By testing n x n points of a cell."""
    inside = 0
    for i in range(n):
        for j in range(n):
            x = grid.xmin + (col + (i + 0.5) / n) * grid.cell_width
            y = grid.ymax - (row + (j + 0.5) / n) * grid.cell_height
            odd = 0
            for ring in (outer, hole):
                for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
                    odd ^= (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1
            inside += odd
    return inside / n / n


# --- sketches and states ---------------------------------------------------------------------


def test_quantiles_of_a_sketch_are_near_in_rank(spark):
    rng = np.random.default_rng(2)
    for values in (rng.normal(size=5000), rng.exponential(size=5000), rng.integers(0, 7, 900).astype(float), np.array([3.0]), np.array([1.0, 9.0])):
        x, y = states.sketch_of(values, 64)
        assert y.sum() == len(values) and (x * y).sum() == pytest.approx(values.sum()) and len(x) <= 64
        rows = [(list(zip(x.tolist(), y.tolist(), strict=True)), float(values.min()), float(values.max()))]
        df = spark.createDataFrame(rows, "distribution array<struct<x:double,y:double>>, zmin double, zmax double")
        read = sketches.sketch_statistics(df, breaks=10).head()
        for share, point in zip([0.5, *[(i + 1) / 10 for i in range(10)]], [read["median"], *read["breaks"]], strict=True):
            low, high = (values < point - 1e-12).sum(), (values <= point + 1e-12).sum()
            assert low - y.max() <= share * len(values) <= high + y.max()
        assert read["mean"] == pytest.approx(values.mean()) and read["stddev"] <= values.std() + 1e-9
        assert read["breaks"][-1] == pytest.approx(values.max())
    empty = spark.createDataFrame([([], None, None)], df.schema)
    read = sketches.sketch_statistics(empty, breaks=2).head()
    assert read["median"] is None and read["mean"] is None and read["breaks"] is None


def test_merged_states_equal_statistics_of_the_cells(spark):
    parts = region_ops.explode_parts(shapes(spark))
    tiles = tile_ops.pack_tiles(dots(spark).withColumn("value", F.col("value") + 1e7), 16)
    packed = hierarchy.mask_hierarchy(parts, GRID)
    merged = {r["region_id"]: r for r in states.merge_states(states.tile_states(tiles, packed, GRID)).collect()}
    masked = mask.mask_packed(tiles, packed, GRID).groupBy("region_id")
    exact = masked.agg(F.count("value").alias("n"), F.min("value").alias("a"), F.max("value").alias("b"), F.avg("value").alias("m"), F.stddev_pop("value").alias("s")).collect()
    assert merged.keys() == {r["region_id"] for r in exact}
    for r in exact:
        m = merged[r["region_id"]]
        assert (m["n_cells"], m["zmin"], m["zmax"]) == (r["n"], r["a"], r["b"])
        assert m["mean"] == pytest.approx(r["m"], rel=1e-14) and m["stddev"] == pytest.approx(r["s"], rel=1e-9)
        assert sum(b["y"] for b in m["distribution"]) == r["n"]


def test_a_refresh_equals_a_full_run_and_skips_tiles_that_did_not_change(spark):
    parts = region_ops.explode_parts(shapes(spark))
    packed = joins.cut_lineage(hierarchy.mask_hierarchy(parts, GRID))
    old = joins.cut_lineage(tile_ops.pack_tiles(dots(spark, 4), 16))
    new = joins.cut_lineage(tile_ops.pack_tiles(dots(spark, 5), 16).where("src = 1 and tile_col < 14"))
    gone = old.where("src = 0 and tile_row = 5").select("src", "tile_col", "tile_row")
    stored = joins.cut_lineage(states.stored_states(old, packed, GRID))
    # an unchanged tile among the updated ones keeps its state, marked here by another number
    same = old.where("src = 1 and tile_col >= 14")
    marked = stored.withColumn("population", F.when((F.col("src") == 1) & (F.col("tile_col") >= 14), 0.5).otherwise(F.col("population")))
    fresh = states.refresh_states(marked, new.unionByName(same), packed, GRID, removed=gone)
    key = ["src", "tile_col", "tile_row"]
    now = old.join(new, key, "left_anti").join(gone, key, "left_anti").unionByName(new)
    full = states.stored_states(now, packed, GRID).withColumn("population", F.when((F.col("src") == 1) & (F.col("tile_col") >= 14), 0.5).otherwise(F.col("population")))
    order = ["region_id", "part", *key]
    assert fresh.orderBy(order).collect() == full.select(*fresh.columns).orderBy(order).collect()


# --- key ranges ------------------------------------------------------------------------------


def test_curve_keys_number_each_square_of_the_quadtree_in_one_range(spark):
    keys = spark.range(64 * 64).selectExpr("int(id % 64) tile_col", "int(id div 64) tile_row")
    keyed = keys.select("*", curve.curve_key(F.col("tile_col"), F.col("tile_row")).alias("key")).collect()
    assert sorted(r["key"] for r in keyed) == list(range(64 * 64))
    squares = {}
    for r in keyed:
        squares.setdefault((r["tile_col"] // 16, r["tile_row"] // 16), []).append(r["key"])
    assert all(max(k) - min(k) == 255 for k in squares.values())
    far = spark.createDataFrame([(65535, 65535)], "tile_col int, tile_row int")
    assert far.select(curve.curve_key(F.col("tile_col"), F.col("tile_row"))).head()[0] == 2**32 - 1


def test_two_far_regions_read_no_file_between_them(spark, tmp_path):
    path = str(tmp_path / "curve")
    grid = GridSpec(-180.0, -90.0, 180.0, 90.0, 0.1, 0.1, 16)
    keys = spark.range(225 * 113).selectExpr("0 src", "int(id % 225) tile_col", "int(id div 225) tile_row")
    tiles = keys.withColumn("cells", F.array_repeat(F.lit(1.0), 256)).select("src", "tile_col", "tile_row", "cells")
    curve.save_curve_tiles(tiles.coalesce(4), path, 16)
    named = {"west": [[square(-170.0, 60.0, 5)]], "east": [[square(160.0, -80.0, 5)]]}
    wanted = region_ops.region_tile_candidates(region_ops.explode_parts(micro.regions(spark, named)), grid)
    ranges = curve.key_ranges(wanted)
    squares = {k >> curve.SQUARE_BITS for low, high in ranges for k in range(low, high + 1)}
    folders = [f for f in os.listdir(path) if f.startswith("square=")]
    assert len(folders) > 50 and len(squares) <= 8
    for folder in folders:
        if int(folder.removeprefix("square=")) not in squares:
            for file in os.listdir(f"{path}/{folder}"):
                if file.endswith(".parquet"):
                    with open(f"{path}/{folder}/{file}", "wb") as broken:
                        broken.write(b"no parquet")
                    os.remove(f"{path}/{folder}/.{file}.crc")
    read = curve.read_curve_tiles(spark, path, ranges)
    found = tile_ops.scan_windows(read, wanted)
    assert found.count() == wanted.count() > 0
    plan = micro.plan(read)
    assert "PartitionFilters: [" in plan and "square#" in plan and "PushedFilters: [Or(" in plan


def test_few_ranges_hold_all_wanted_keys(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(800), rng.randrange(400)) for _ in range(300)]
    wanted = spark.createDataFrame(rows, "tile_col int, tile_row int")
    keys = [r[0] for r in wanted.select(curve.curve_key(F.col("tile_col"), F.col("tile_row"))).collect()]
    for most in (1, 5, 64):
        ranges = curve.key_ranges(wanted, most)
        assert len(ranges) <= most and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
        assert all(any(low <= k <= high for low, high in ranges) for k in keys)
    assert curve.key_ranges(wanted.where("false")) == []


def test_partitions_along_the_curve_hold_equal_weight(spark):
    rng = random.Random(3)
    rows = [(c, r, 1000.0 if c < 20 and r < 20 else rng.random()) for c in range(100) for r in range(60)]
    weights = spark.createDataFrame(rows, "tile_col int, tile_row int, weight double")
    tiles = weights.select(F.lit(0).alias("src"), "tile_col", "tile_row", "weight")
    placed = curve.balance_along_curve(tiles, weights, 8)
    sums = placed.groupBy(F.spark_partition_id()).agg(F.sum("weight")).collect()
    total = sum(w for *_, w in rows)
    assert len(sums) == 8 and max(s[1] for s in sums) <= 1.3 * total / 8


# --- other cell sizes ------------------------------------------------------------------------


@pytest.mark.parametrize("size", [0.3, 0.47, 0.9, 0.999, 1.0, 1.0004, 1.25, 1.9, 2.0, 3.7])
def test_cut_runs_read_what_each_cell_reads(spark, size):
    rng = random.Random(int(size * 1000))
    source = GridSpec(-100.0 + rng.random(), -70.0, -100.0 + rng.random() + 200 * size, -70.0 + 130 * size, size, size, 16)
    across, down = read_axes(GRID, source)
    runs = [(i, rng.randrange(180), a, min(359, a + rng.randrange(200))) for i, a in enumerate(rng.randrange(360) for _ in range(60))]
    spans = spark.createDataFrame(runs, "region_id int, row int, c0 int, c1 int")
    got = {}
    for r in read_spans(spans, GRID, source).collect():
        for col in range(r["c0"], r["c1"] + 1):
            at = (r["region_id"], col, r["row"])
            got[at] = got.get(at, 0) + 1
    want = {}
    for i, row, c0, c1 in runs:
        for c in range(c0, c1 + 1):
            col, at = across.source_of(c), down.source_of(row)
            if 0 <= col < source.cols and 0 <= at < source.rows:
                want[i, col, at] = want.get((i, col, at), 0) + 1
    assert got == want


@pytest.mark.parametrize("size", [0.7, 1.3])
def test_packed_tiles_of_another_cell_size_give_the_resampled_sums(spark, size):
    regions = shapes(spark)
    # off by a little, as a centre on a border between two cells may be read either way
    source = GridSpec(-120.013, -60.013, -120.013 + 300 * size, -60.013 + 170 * size, size, size, 16)
    cells = dots(spark, nan=False).where(f"col < {source.cols} and row < {source.rows}")
    extents = micro.sources(spark, (0, -180, -90, 180, 90), (1, -180, -90, 180, 90))
    resampled = resample.resample_nearest(cells, source, resample.grid_axes(GRID))
    want = region_population(regions, resampled, extents, GRID).orderBy("location_name").collect()
    packed = tile_ops.pack_tiles(cells, 16)
    for raster in (packed, prefix.prefix_tiles(packed, 16), cells):
        got = region_population(regions, raster, extents, GRID, source_grid=source)
        assert got.orderBy("location_name").collect() == want


# --- rendering again -------------------------------------------------------------------------


def test_refreshed_levels_equal_a_full_render_and_read_only_what_changed(spark):
    rng = random.Random(8)
    keys = [(s, c, r) for s in range(2) for c in range(3, 20) for r in range(2, 10)]

    def made(only=lambda s, c, r: False):
        rows = []
        for s, c, r in keys:
            values = [float((s * 7 + c * 5 + r * 3 + i) % 23) for i in range(256)]
            if only(s, c, r):
                values = [None if i % 3 else 50.0 + rng.randrange(9) for i in range(256)]
            rows.append((s, c, r, values))
        return spark.createDataFrame(rows, "src int, tile_col int, tile_row int, cells array<double>").repartition(4)

    is_changed = lambda s, c, r: s == 0 and (c, r) in ((5, 4), (17, 8))
    before, after = made(), joins.cut_lineage(made(is_changed))
    stored = joins.cut_lineage(tile_levels(before, GRID, 5, 0, 16))
    changed = spark.createDataFrame([(5, 4), (17, 8)], "tile_col int, tile_row int")
    full = tile_levels(after, GRID, 5, 0, 16)
    # a tile that nothing stale reads cannot be read: it has no whole array
    stale = stale_tiles(changed, GRID, 5, 0, 16)
    needed = source_tiles_of(after, stale, GRID, 5, 16)
    assert 2 < needed.count() < 40
    flagged = needed.withColumn("needed", F.lit(True))
    broken = after.join(F.broadcast(flagged), ["tile_col", "tile_row"], "left")
    broken = broken.withColumn("cells", F.when(F.col("needed"), F.col("cells")).otherwise(F.array(F.lit(1.0))))
    fresh = refresh_levels(stored, broken.select(after.columns), changed, GRID, base_zoom=5, tile_size=16)
    order = ["zoom", "tile_col", "tile_row"]

    def rounded(levels):
        return levels.select(*order, F.transform("cells", lambda v: F.round(v, 9)).alias("cells")).orderBy(order)

    a, b = rounded(fresh).toPandas(), rounded(full).toPandas()
    assert a[order].equals(b[order])
    assert all(np.array_equal(np.array(x, dtype=float), np.array(y, dtype=float), equal_nan=True) for x, y in zip(a["cells"], b["cells"], strict=True))
    one = warp_levels(after, GRID, ZoomLevel(5, 16), range(5, 4, -1), 16, only=spark.createDataFrame([(9, 9)], "block_col int, block_row int"))
    assert {(r["tile_col"], r["tile_row"]) for r in one.collect()} <= {(9, 9)}


# --- families and ids ------------------------------------------------------------------------


def test_families_connect_over_bucket_borders_and_around_the_cell(spark):
    t = 0.01
    rows = [
        (1, 10.0, 5.0, 1.0), (2, 10.0 + 0.6 * t, 5.0, 1.0), (3, 10.0 + 1.2 * t, 5.0, 1.0),  # a chain
        (4, 10.5, 5.0, 1.0),  # half a cell off
        (5, 20.0 - 0.5 * t, 5.0, 1.0),  # before the whole cell, so near 1 around it
        (6, 10.0, 5.0, 2.0), (7, 10.0, 5.0, 2.0), (8, 10.0, 6.0, 2.0),
    ]
    grids = spark.createDataFrame(rows, "id int, xmin double, ymin double, cell_width double").withColumn("cell_height", F.col("cell_width"))
    found = {r["id"]: (r["family"], r["n_grids"]) for r in families.grid_families(grids, "id").collect()}
    assert found == {1: (1, 4), 2: (1, 4), 3: (1, 4), 5: (1, 4), 4: (4, 1), 6: (6, 2), 7: (6, 2), 8: (8, 1)}
    assert families.grid_families(grids.where("false"), "id").count() == 0


def test_a_long_chain_is_one_family(spark):
    grids = spark.range(60).selectExpr("int(id) id", "10 + id * 0.008 xmin", "0D ymin", "1D cell_width", "1D cell_height")
    assert {r["family"] for r in families.grid_families(grids, "id").collect()} == {0}


def test_region_ids_come_from_content(spark):
    feature = '{"type":"Feature","geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,%d]]]},"properties":{"adm0_a3":"X"}}'
    lines = spark.createDataFrame([(feature % (i % 3),) for i in range(9)], "value string")
    parsed = geojson.parse_features(lines, geojson.ADMIN0_PROPERTIES)
    ids = [sorted(r["region_id"] for r in geojson.number_regions(parsed.repartition(n)).collect()) for n in (1, 5)]
    assert ids[0] == ids[1] and len(set(ids[0])) == 9


def test_bins_of_many_owners_merge_as_those_of_each_alone():
    draw = np.random.default_rng(5)
    sizes = draw.integers(0, 200, 60)
    owner = np.repeat(np.arange(60), sizes)
    x, y = draw.integers(0, 900, len(owner)).astype(float), draw.integers(1, 4, len(owner)).astype(float)
    of, got_x, got_y = histograms.merge_many(owner, x, y, 16)
    for k in range(60):
        want_x, want_y = histograms.merge_bins(x[owner == k], y[owner == k], 16)
        assert np.array_equal(got_x[of == k], want_x) and np.array_equal(got_y[of == k], want_y)


def test_states_of_many_keys_fold_across_batches(spark):
    kept = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = spark.range(300, numPartitions=2).selectExpr(
            "if(id % 5 = 4, null, id % 5) as k", "cast(2 * id + 1 as double) as population", "2L as n_cells",
            "cast(id as double) as zmin", "cast(id + 1 as double) as zmax", "id + 0.5D as centre", "0.5D as squares",
            "array(named_struct('x', cast(id as double), 'y', 1D), named_struct('x', cast(id + 1 as double), 'y', 1D)) as distribution",
        )
        merged = {r["k"]: r for r in states.merge_states(rows, "k", bins=8).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", kept)
    assert set(merged) == {0, 1, 2, 3, None}
    for k, found in merged.items():
        values = np.array([v for i in range(4 if k is None else k, 300, 5) for v in (i, i + 1)], float)
        assert (found["n_cells"], found["population"]) == (len(values), values.sum())
        assert (found["zmin"], found["zmax"]) == (values.min(), values.max())
        assert abs(found["stddev"] - values.std()) < 1e-9
        bins = found["distribution"]
        assert len(bins) <= 8 and sum(b["y"] for b in bins) == len(values)
        assert abs(sum(b["x"] * b["y"] for b in bins) - values.sum()) < 1e-6
