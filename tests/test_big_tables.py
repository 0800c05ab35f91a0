"""What keeps the zonal queries in bounds on large tables; every test builds its own rows."""

import collections
import math
import random
import statistics

import micro
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from checks import queries
from gridcensus.operators import counts, histograms, joins, states
from gridcensus.operators.tiles import pack_tiles
from gridcensus.plans.admin_population import admin1_population


@pytest.fixture()
def tables(spark, tmp_path):
    """Two dozen regions and some thousand cells."""
    spark.range(24).selectExpr("id as s_suppkey", "concat('S', id) as s_name", "cast(id % 5 as int) as s_nationkey").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.range(6000).selectExpr(
        "id as l_orderkey", "id * 7 as l_partkey", "id % 24 as l_suppkey", "cast(id % 7 as int) as l_linenumber", "cast(id % 50 + 1 as double) as l_quantity"
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_points_of_sketches_reach_cells_with_the_spans(spark, tables, monkeypatch):
    seen, mask_cells = [], queries.mask.mask_cells
    monkeypatch.setattr(queries.mask, "mask_cells", lambda cells, spans, *a, **k: seen.append(spans.columns) or mask_cells(cells, spans, *a, **k))
    rows = queries.QUERIES["sketch_stats"](spark, tables).collect()
    assert rows and all(r["ranks_ok"] and r["mean_ok"] and r["stddev_ok"] for r in rows)
    assert seen and all("points" in columns for columns in seen)


def test_spans_of_sketches_meet_their_points_without_a_broadcast(spark, tables, monkeypatch):
    seen, mask_cells = [], queries.mask.mask_cells
    monkeypatch.setattr(queries.mask, "mask_cells", lambda cells, spans, *a, **k: seen.append(spans) or mask_cells(cells, spans, *a, **k))
    queries.QUERIES["sketch_stats"](spark, tables)
    [spans] = seen
    plan = spans._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_states_of_a_mask_come_side_by_side_and_merge_before_they_are_sorted(spark, tables):
    packed = queries.hierarchy.mask_hierarchy(queries._parts(spark, tables), queries.GRID)
    made = states.tile_states(queries.fx.tiles(spark, tables), packed, queries.GRID, broadcast_rows=1)
    small = states.tile_states(queries.fx.tiles(spark, tables), packed, queries.GRID)
    assert made.columns == small.columns
    numbers = [c for c in made.columns if c not in ("centre", "squares", "distribution")]
    assert made.select(numbers).exceptAll(small.select(numbers)).isEmpty() and made.count() == small.count()
    keys = ["region_id", "part", "tile_col", "tile_row"]
    rows = [tuple(r) for r in made.select(F.spark_partition_id(), *keys).collect()]
    runs = 1 + sum(a != b for a, b in zip(rows, rows[1:]))
    assert runs == len(set(rows)) < len(rows)
    plan = states.merge_states(made)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 4


@pytest.mark.parametrize("distinct", [3, 900])
def test_rows_merge_in_any_order_where_keys_repeat(monkeypatch, distinct):
    monkeypatch.setattr(histograms, "FOLD_ROWS", 500)
    rng = np.random.default_rng(5)
    keys = rng.permutation(1200) % distinct
    batches = [pa.RecordBatch.from_arrays([pa.array([None if k == 2 else int(k) for k in keys[at : at + 100]]), pa.array([1] * 100)], ["k", "n"]) for at in range(0, 1200, 100)]

    def fold(batch, owner):
        return [pa.array(np.bincount(owner, weights=batch["n"].to_numpy()).astype(np.int64))]

    out = [*histograms.fold_some(["k"], fold)(iter([*batches[:1], batches[0].slice(0, 0), *batches[1:]]))]
    assert sum(b.num_rows for b in out) == (9 if distinct == 3 else 1200)
    got = collections.Counter()
    for b in out:
        for k, n in zip(b["k"].to_pylist(), b["n"].to_pylist()):
            got[k] += n
    assert got == collections.Counter(None if k == 2 else int(k) for k in keys)


@pytest.mark.parametrize("runs_of_a_tile", [1, 3, 40])
def test_covered_cells_of_few_and_of_many_runs(runs_of_a_tile):
    rng = random.Random(runs_of_a_tile)
    size = [64] * 30
    drawn = [None if runs_of_a_tile == 3 and i % 9 == 4 else [{"start": rng.randrange(1, 60), "length": rng.randrange(1, 5)} for _ in range(runs_of_a_tile)] for i in range(30)]
    want = collections.Counter()
    for i, runs in enumerate(drawn):
        for run in [{"start": 1, "length": 64}] if runs is None else runs:
            want.update((i, 64 * i + run["start"] - 1 + k) for k in range(run["length"]))
    runs = pa.array(drawn, pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())])))
    tile, place, times = states._covered(runs, np.array(size))
    got = collections.Counter()
    for t, p, n in zip(tile.tolist(), place.tolist(), times.tolist()):
        got[t, p] += n
    assert got == want and sorted(tile) == tile.tolist()


def test_stored_states_are_read_and_not_made_again(spark, tables, monkeypatch):
    seen, refresh = [], queries.states.refresh_states
    monkeypatch.setattr(queries.states, "refresh_states", lambda states, *a, **k: seen.append(_plan(states)) or refresh(states, *a, **k))
    rows = queries.QUERIES["zonal_refresh"](spark, tables)
    want = queries.zonal.zonal_sum(queries._masked_parts(spark, tables)).withColumnRenamed("population", "exact")
    assert rows.join(want.drop("n_cells"), "region_id").where(F.col("population") != F.col("exact")).count() == 0
    assert rows.count() == want.count() > 0
    assert len(seen) == 1 and "MapInArrow" not in seen[0]


@pytest.mark.parametrize("fields", ["start int, length int", "start int, length int, share double"])
def test_masks_are_sized_as_the_rows_that_a_broadcast_holds(spark, fields):
    runs = f"transform(sequence(1, 1000), i -> named_struct({', '.join(f'{f.split()[0]!r}, cast(i as {f.split()[1]})' for f in fields.split(', '))}))"
    packed = spark.range(2).selectExpr("id as region_id", f"if(id = 0, {runs}, null) as runs")
    sizes = [r[0] for r in packed.select(joins.packed_bytes(packed)).collect()]
    held = packed.coalesce(1)._jdf.queryExecution().toRdd().collect()
    assert all(size >= row.getSizeInBytes() for size, row in zip(sizes, held, strict=True))
    assert sizes[0] < 1.1 * held[0].getSizeInBytes()


def test_large_masks_of_small_files_are_not_broadcast(spark, tables):
    parts = queries._parts(spark, tables)
    running = queries.prefix.prefix_tiles(queries.fx.tiles(spark, tables), queries.GRID.tile_size)
    masks = queries.shares.mask_shares(parts, queries.GRID)
    sums = queries.shares.zonal_sum_shares(running, masks, queries.GRID, broadcast_rows=1)
    kept = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for table in (masks, sums):
            plan = table.select("*")._jdf.queryExecution().executedPlan().toString()
            joins_made = [line for line in plan.splitlines() if "Join" in line and "s_suppkey" not in line]
            assert joins_made and all("SortMergeJoin" in line for line in joins_made), plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", kept)


def test_values_are_summed_up_before_they_are_moved(spark):
    rows = spark.range(40_000, numPartitions=2).selectExpr(
        "if(id % 400 = 7, null, id % 400) as a", "concat('s', id % 2) as b", "cast(id % 400 = 5 as int) as c",
        "if(id % 400 = 9, null, cast(id as double)) as value",
    )
    summary = queries.zonal.zonal_summary(rows, ["a", "b"], bins=8)
    plan = summary._jdf.queryExecution().optimizedPlan().toString()
    assert "histogram_numeric" not in plan
    got = {(r["a"], r["b"]): r for r in summary.collect()}
    want = {(r["a"], r["b"]): r for r in rows.groupBy("a", "b").agg(F.sum("value").alias("s"), F.count("value").alias("n")).collect()}
    assert got.keys() == want.keys() and len(got) == 400
    for key, w in want.items():
        assert got[key]["population"] == w["s"]
        bins = got[key]["distribution"]
        assert (bins is None) == (w["n"] == 0)
        assert bins is None or (len(bins) <= 8 and sum(b["y"] for b in bins) == w["n"])


def test_tasks_of_a_shuffled_mask_join_grow_in_number_with_its_masks(spark, tables, monkeypatch):
    monkeypatch.setattr(joins, "TASK_BYTES", 400, raising=False)
    parts, cells = queries._parts(spark, tables), queries.fx.cells(spark, tables)
    spans = queries.mask.clip_spans(queries.mask.part_spans(parts, queries.GRID), queries.GRID).drop("tile_row")
    masked = queries.mask.mask_cells(cells, spans, queries.GRID, broadcast_rows=1)
    # Spark brings the small inputs of this join together in a task or a few, however many rows come of it
    by_task = masked.groupBy(F.spark_partition_id().alias("task")).count().collect()
    rows = sum(r["count"] for r in by_task)
    assert len(by_task) > 50 and max(r["count"] for r in by_task) < rows / 20
    small = queries.mask.mask_cells(cells, spans, queries.GRID)
    columns = ["region_id", "part", "src", "col", "row", "value"]
    assert rows == small.count() and masked.select(columns).exceptAll(small.select(columns)).isEmpty()


def _job(spark, rows, named):
    regions = micro.regions(spark, named).withColumn("adm1_code", F.col("location_name"))
    extents = micro.sources(spark, *[(s, -180, -90, 180, 90) for s in {r[0] for r in rows}])
    return regions, micro.cells(spark, rows), extents


@pytest.mark.parametrize("packed", [False, True])
def test_exact_statistics_come_from_counts_of_values(spark, packed, monkeypatch):
    rng = random.Random(7)
    rows = [(s, c, r, float(rng.randrange(40)) / 2 - 3) for s in range(5) for c in range(170, 230) for r in range(60, 100)]
    rows += [(0, 231, 70, None), (1, 231, 71, float("nan")), (2, 231, 72, float("inf"))]
    squares = {f"r{i}": (-8 + 5 * i, -6 + 3 * i, 9 + 4 * (i % 6)) for i in range(9)}
    named = {name: [[micro.square(*at)]] for name, at in squares.items()}
    named["r0"] = [*named["r0"], [micro.square(-5, -4, 12)]]  # overlapping parts count their cells twice
    regions, cells, extents = _job(spark, rows, named)
    want = {}
    for name, at in squares.items():
        held = [v for x, y, side in [at, *([(-5, -4, 12)] if name == "r0" else [])] for s, c, r, v in rows
                if v is not None and math.isfinite(v) and x < c - 179.5 < x + side and y < 89.5 - r < y + side]
        held.sort()
        times = collections.Counter(held)
        want[name] = (len(held), held[0], held[-1], held[(len(held) - 1) // 2], min(times, key=lambda v: (-times[v], v)), sum(held), statistics.pstdev(held))
    raster = pack_tiles(cells, 16) if packed else cells
    for stack, masks, tasks in ((1 << 20, 256, 1 << 20), (300, 2, 400)):
        monkeypatch.setattr(counts, "STACK_CELLS", stack)
        monkeypatch.setattr(counts, "MASKS_PER_ROW", masks)
        monkeypatch.setattr(joins, "TASK_BYTES", tasks)
        result = admin1_population(regions, raster, extents, queries.GRID, exact_mode=True, broadcast_rows=1 if masks == 2 else 2_000_000)
        got = {r["adm1_code"]: r for r in result.collect()}
        assert got.keys() == want.keys()
        for name, (n, low, high, median, mode, total, dev) in want.items():
            r = got[name]
            assert (r["n_cells"], r["zmin"], r["zmax"], r["median"], r["mode"], r["population"]) == (n, low, high, median, mode, int(total))
            assert r["mean"] == pytest.approx(total / n) and r["stddev"] == pytest.approx(dev)
            assert sum(b["y"] for b in r["distribution"]) == n


def test_exact_mode_makes_no_row_per_cell_and_no_sketch_that_is_not_read(spark):
    rng = random.Random(3)
    values = rng.sample(range(10**6), 30_000)
    rows = [(0, 100 + i % 200, 10 + i // 200, float(v)) for i, v in enumerate(values)]
    regions, cells, extents = _job(spark, rows, {"all": [[micro.square(-80.25, -80.25, 165)]]})
    result = admin1_population(regions, cells, extents, queries.GRID, exact_mode=True).drop("distribution")
    plan = _plan(result)
    assert "percentile_approx" not in plan and "histogram_numeric" not in plan and plan.count("MapInArrow") == 1
    [row] = result.collect()
    held = sorted(v for (_, c, r, v) in rows if -80.25 < c - 179.5 < 84.75 and -80.25 < 89.5 - r < 84.75)
    # percentile_approx is off by some ranks among so many values
    assert row["n_cells"] == len(held) > 20_000 and row["median"] == held[(len(held) - 1) // 2]
