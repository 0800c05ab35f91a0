import math

import micro
import numpy as np
import pytest
from micro import GRID, block, plan, square
from pyspark.sql import functions as F

from gridcensus.functions import colors
from gridcensus.functions.grid import GLOBAL_100M, GridSpec, ZoomLevel
from gridcensus.operators import joins, mask, mosaic, pyramid, regions as region_ops, resample, tiles
from gridcensus.plans.render_pyramid import mercator_layer, render_pyramid, render_tiles, tile_levels
from gridcensus.sources import rasters

SMALL = GridSpec(0.0, 0.0, 12.0, 9.0, 1.0, 1.0, 4)


def sample(spark):
    rng = np.random.default_rng(7)
    data = []
    for src in (0, 1, 2):
        for c in range(12):
            for r in range(9):
                if rng.random() < 0.6:
                    data.append((src, c, r, None if rng.random() < 0.2 else float(rng.integers(1, 50))))
    return data


def as_dict(df):
    return {(r["src"], r["col"], r["row"]): r["value"] for r in df.collect()}


def test_global_layout():
    assert (GLOBAL_100M.cols, GLOBAL_100M.rows) == (432000, 216000)
    assert (GLOBAL_100M.layout_cols, GLOBAL_100M.layout_rows) == (844, 422)
    half = GridSpec(-180.0, -90.0, 180.0, 90.0, 8.3333333e-4, 8.3333333e-4, 256)
    assert (half.layout_cols, half.layout_rows) == (1688, 844)


def test_pack_and_unpack(spark):
    data = sample(spark)
    packed = tiles.pack_tiles(micro.cells(spark, data), 4)
    assert {len(r["cells"]) for r in packed.collect()} == {16}
    got = as_dict(tiles.unpack_tiles(packed, 4))
    assert got == {(s, c, r): v for s, c, r, v in data if v is not None}
    assert tiles.unpack_tiles(packed, 4, keep_nodata=True).count() == packed.count() * 16


def test_a_cell_given_twice_is_an_error(spark):
    with pytest.raises(Exception, match="holds a cell twice"):
        tiles.pack_tiles(micro.cells(spark, [(0, 1, 1, 1.0), (0, 1, 1, 2.0)]), 4).collect()


def test_nearest_against_brute_force(spark):
    data = sample(spark)
    target = GridSpec(0.3, 0.1, 12.3, 8.6, 0.7, 0.8, 4)
    got = as_dict(resample.resample_nearest(micro.cells(spark, data), SMALL, resample.grid_axes(target)))
    known = {(s, c, r): v for s, c, r, v in data}
    expected = {}
    for s in (0, 1, 2):
        for t in range(target.cols):
            for u in range(target.rows):
                c = math.floor(0.3 + (t + 0.5) * 0.7)
                r = math.floor(9.0 - (8.6 - (u + 0.5) * 0.8))
                if (s, c, r) in known:
                    expected[(s, t, u)] = known[(s, c, r)]
    assert got == expected


def test_bilinear_against_brute_force(spark):
    data = sample(spark)
    target = GridSpec(0.3, 0.1, 12.3, 8.6, 0.7, 0.8, 4)
    got = as_dict(resample.resample_bilinear(micro.cells(spark, data), SMALL, resample.grid_axes(target)))
    known = {(s, c, r): v for s, c, r, v in data if v is not None}
    expected = {}
    for s in (0, 1, 2):
        for t in range(target.cols):
            for u in range(target.rows):
                fx, fy = 0.3 + (t + 0.5) * 0.7 - 0.5, 9.0 - (8.6 - (u + 0.5) * 0.8) - 0.5
                total = weight = 0.0
                for dx in (0, 1):
                    for dy in (0, 1):
                        c, r = math.floor(fx) + dx, math.floor(fy) + dy
                        w = (1 - abs(fx - c)) * (1 - abs(fy - r))
                        if w > 1e-12 and (s, c, r) in known:
                            total, weight = total + w * known[(s, c, r)], weight + w
                if weight:
                    expected[(s, t, u)] = total / weight
    assert set(got) == set(expected)
    assert all(got[k] == pytest.approx(expected[k]) for k in got)


def test_resampling_to_its_own_grid_changes_nothing(spark):
    cells = micro.cells(spark, [d for d in sample(spark) if d[3] is not None])
    axes = resample.grid_axes(SMALL)
    assert as_dict(resample.resample_nearest(cells, SMALL, axes)) == as_dict(cells)
    assert as_dict(resample.resample_bilinear(cells, SMALL, axes)) == as_dict(cells)


def test_mosaic_takes_the_lowest_source_with_data(spark):
    cells = micro.cells(spark, [(2, 0, 0, 5.0), (0, 0, 0, None), (1, 0, 0, 7.0), (3, 1, 0, float("nan"))])
    assert [tuple(r) for r in mosaic.mosaic_cells(cells).collect()] == [(0, 0, 7.0)]


def test_mosaic_of_tiles_passes_single_tiles_through(spark):
    data = sample(spark) + [(0, 30, 30, 9.0), (0, 31, 31, None)]
    cells = micro.cells(spark, data)
    merged = mosaic.mosaic_tiles(tiles.pack_tiles(cells, 4), SMALL)
    got = {(r["col"], r["row"]): r["value"] for r in tiles.unpack_tiles(merged, 4).collect()}
    assert got == {(r["col"], r["row"]): r["value"] for r in mosaic.mosaic_cells(cells).collect()}


def test_pyramid_levels_are_means_of_means(spark):
    base = spark.createDataFrame(
        [(0, 0, 1.0), (1, 0, 3.0), (2, 0, 10.0), (7, 7, 4.0)], "col int, row int, value double"
    )
    levels = pyramid.pyramid(base, 3, 0, 2).collect()
    got = {(r["zoom"], r["col"], r["row"]): r["value"] for r in levels}
    assert got[(2, 0, 0)] == 2.0 and got[(2, 1, 0)] == 10.0
    assert got[(1, 0, 0)] == 6.0 and got[(1, 1, 1)] == 4.0
    assert got[(0, 0, 0)] == 5.0 and len(got) == 4 + 3 + 2 + 1


def test_each_level_of_a_pyramid_is_computed_once(spark):
    """Also where a pyramid of several steps starts from cells outside the blocks of its top levels."""
    rng = np.random.default_rng(5)
    cells = {(int(c), int(r)): float(v) for c, r, v in zip(rng.integers(0, 700, 3000), rng.integers(0, 700, 3000), rng.random(3000))}
    base = spark.createDataFrame([(*k, v) for k, v in cells.items()], "col int, row int, value double")
    drawn = pyramid.pyramid(base, 6, 0, 4)
    got = {}
    for r in drawn.collect():
        assert (r["zoom"], r["col"], r["row"]) not in got
        got[r["zoom"], r["col"], r["row"]] = r["value"]
    want = means_upwards(cells, 6)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    final = plan(drawn).split("== Initial Plan ==")[0].splitlines()
    assert len([line for line in final if "MapInPandas" in line]) == 1


def means_upwards(cells, zoom):
    """{(zoom, col, row): value} of all levels above cells {(col, row): value}."""
    found = {}
    while True:
        found |= {(zoom, *k): v for k, v in cells.items()}
        if zoom == 0:
            return found
        above = {}
        for (c, r), v in cells.items():
            above.setdefault((c // 2, r // 2), []).append(v)
        cells, zoom = {k: sum(v) / len(v) for k, v in above.items()}, zoom - 1


def test_rendering_shuffles_once_per_four_levels(spark):
    cells = micro.cells(spark, block(0, 180, 80, 10, 10))
    # pixels are coarser than cells: they reduce to pixels and go to blocks for levels 4..1, which are
    # kept; what is left moves the last of them once for level 0
    drawn = render_pyramid(cells, GRID, base_zoom=4, min_zoom=0, tile_size=16)
    drawn.collect()
    final = plan(drawn).split("== Initial Plan ==")[0]
    fresh = [
        line
        for line in final.splitlines()
        if "Exchange hashpartitioning" in line and "Reused" not in line
    ]
    assert len(fresh) == 1, "\n".join(fresh)


@pytest.mark.parametrize("zoom", [4, 6])
def test_tiles_carry_path_and_every_pixel(spark, zoom):
    cells = micro.cells(spark, block(0, 180, 80, 10, 10, 3.0))
    drawn = render_tiles(cells, GRID, "out", base_zoom=zoom, min_zoom=zoom - 1, tile_size=16)
    rows = drawn.collect()
    assert {len(r["rgba"]) for r in rows} == {256}
    assert all(r["path"] == f"out/{r['zoom']}/{r['tile_col']}/{r['tile_row']}.png" for r in rows)
    pixels = render_pyramid(cells, GRID, base_zoom=zoom, min_zoom=zoom - 1, tile_size=16)
    pixels = pixels.where("color <> 0").count()
    assert sum(sum(c != 0 for c in r["rgba"]) for r in rows) == pixels


def test_array_colours_equal_cell_colours(spark):
    values = [0.0, 0.5, 1.0, 1.0000001, 1.00001, 2.0, 5.0, 49.9, 50.0, 50.1, 1000.0, 1000.1, 9e4, None]
    cells = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    for palette, breaks in (
        (colors.MAP_COLORS, colors.GLOBAL_BREAKS),
        (colors.ORANGE_NINE, colors.TWOFOLD_BREAKS),
        (colors.MAP_COLORS, colors.GLOBAL_BREAKS[:4]),
    ):
        single = cells.select("i", colors.classify(colors.stable(F.col("v")), palette, breaks).alias("c"))
        packed = cells.agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "v"))), lambda e: e["v"]).alias("a"))
        shades = packed.select(colors.classify_arrays(palette, breaks)(F.col("a")).alias("c")).head()["c"]
        assert shades == [r["c"] for r in single.orderBy("i").collect()]
    red = cells.limit(1).select(colors.channels(F.lit(0xFF8001FE)).alias("c")).head()["c"]
    assert red == [255, 128, 1, 254]


def test_zoom_level_size():
    assert ZoomLevel(12).pixels == 1 << 20
    assert ZoomLevel(0).pixel_metres == pytest.approx(156543.03392804097)


def test_stored_tiles_prune_sources_and_push_windows(spark, tmp_path):
    path = str(tmp_path / "tiles")
    cells = micro.cells(spark, block(0, 0, 0, 40, 40) + block(1, 100, 100, 40, 40))
    tiles.save_tiles(tiles.pack_tiles(cells, 16), path, 16)
    scan = rasters.read_tiles(spark, path, exclude=[0], window=(6, 6, 7, 7))
    text = plan(scan)
    assert "PartitionFilters: [isnotnull(src" in text or "PartitionFilters: [NOT" in text
    assert "GreaterThanOrEqual(tile_col,6)" in text
    rows = scan.collect()
    assert {r["src"] for r in rows} == {1}
    assert {(r["tile_col"], r["tile_row"]) for r in rows} == {(6, 6), (6, 7), (7, 6), (7, 7)}


def test_bucketed_tiles_stay_in_place(spark):
    cells = micro.cells(spark, block(0, 170, 70, 40, 40))
    tiles.save_bucketed_tiles(tiles.pack_tiles(cells, 16), "bucketed_tiles", 16, buckets=4)
    stored = spark.table("bucketed_tiles")
    parts = region_ops.explode_parts(micro.regions(spark, {"a": [[square(-5, -5, 20)]]}))
    spans = mask.clip_spans(mask.part_spans(parts, GRID), GRID)
    moved = mask.mask_tiles(stored, joins.cut_lineage(spans), GRID, broadcast_rows=1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = mask.mask_tiles(stored, joins.cut_lineage(spans), GRID, broadcast_rows=1)
        side = plan(joined).split("bucketed_tiles")[0].rsplit("SortMergeJoin", 1)[1]
        assert "Exchange" not in side
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert moved.agg(F.sum("value")).head()[0] == 400.0


def test_row_groups_of_tile_tables_are_bounded(spark, tmp_path, monkeypatch):
    import pyarrow.parquet as pq

    monkeypatch.setattr(tiles, "CELLS_PER_GROUP", 16 * 16 * 3)
    path = tmp_path / "groups"
    cells = micro.cells(spark, block(0, 0, 0, 128, 128, None))
    tiles.save_tiles(tiles.pack_tiles(cells, 16), str(path), 16)
    files = [pq.ParquetFile(f).metadata for f in path.rglob("*.parquet")]
    sizes = [m.row_group(i).num_rows for m in files for i in range(m.num_row_groups)]
    assert sum(sizes) == 64 and max(sizes) <= 3


@pytest.mark.parametrize("zoom, tile_size", [(6, 16), (5, 64)])
def test_tiles_and_cells_render_the_same_levels(spark, zoom, tile_size):
    """Levels across two shuffles, sources that overlap, tiles on block borders and the map's edge."""
    data = [
        (s, c, r, float((c * 7 + r * 5 + s) % 60 + 1) if (c + r) % 11 else None)
        for s in (0, 1)
        for c in [*range(0, 9), *range(150, 200, 1 + s), *range(355, 360)]
        for r in [*range(3, 20), *range(40, 110)]
    ]
    cells = micro.cells(spark, data)
    tiled = tile_levels(tiles.pack_tiles(cells, GRID.tile_size), GRID, zoom, 0, tile_size)
    got = {
        (r["zoom"], r["col"], r["row"]): r["value"]
        for r in tiles.unpack_tiles(tiled, tile_size).collect()
    }
    base = mercator_layer(cells, GRID, ZoomLevel(zoom, tile_size)).collect()
    expected = means_upwards({(r["col"], r["row"]): r["value"] for r in base}, zoom)
    assert {k[0] for k in got} == set(range(zoom + 1))
    assert set(got) == set(expected)
    assert all(got[k] == pytest.approx(expected[k]) for k in got)
    assert tiled.groupBy("zoom", "tile_col", "tile_row").count().where("count > 1").isEmpty()


def test_packed_rendering_moves_tiles_once_per_four_levels(spark):
    packed = tiles.pack_tiles(micro.cells(spark, block(0, 180, 80, 10, 10)), GRID.tile_size)
    drawn = tile_levels(joins.cut_lineage(packed), GRID, 6, 0, 16)
    drawn.collect()
    final = plan(drawn).split("== Initial Plan ==")[0].splitlines()
    # the warp and its four levels are kept; what is left moves the last of them once
    assert len([line for line in final if "Exchange hashpartitioning" in line]) == 1, "\n".join(final)
    assert len([line for line in final if "MapInPandas" in line]) == 1
