"""Sharding by a k-d tree over document metadata.

A node is split at the weighted median (weights are bytes) along the dimension in which its box is
widest, until a leaf holds the target bytes. Each dimension is a position from 0 up to 1 in the bytes
of all documents: a value owns an interval as long as its share of the bytes, and a document lies in
it by its hash. So a source with a third of all rows is split like any other interval.

Everything is DataFrame functions. The driver holds one cut per inner node, as many as shards.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcensus.llm.common import local_table, materialize, running_total, text_or_empty, unit_hash

#: A median is found by two histograms of so many bins, each over all rows of the node.
BINS = 2048
#: Cuts of up to so many nodes are broadcast (48 bytes each); beyond, nodes are small enough to join.
BROADCAST_NODES = 100_000
ROWS_PER_PART = 512


def _positions(rows: DataFrame, column: str, seed: int, in_order: bool) -> DataFrame:
    """Start and share of the interval that each value of a column owns.

    Values are ordered by hash, or as they are where ``in_order`` (few integers). The 4096 hash
    ranges are summed first, so no task orders all values.
    """
    part = F.col(column) if in_order else F.shiftrightunsigned(F.xxhash64(F.lit(seed), column), 52)
    shares = rows.groupBy(column).agg(F.sum("size").alias("w")).withColumn("part", part.cast("long"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = shares.groupBy("part").agg(F.sum("w").alias("pw"))
    parts = parts.select(F.col("part").alias("of_part"), F.coalesce(F.sum("pw").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("part").orderBy(column).rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.withColumn("inner", F.coalesce(F.sum("w").over(inside), F.lit(0)))
    shares = shares.join(parts, F.col("part").eqNullSafe(F.col("of_part")))
    return shares.select(F.col(column).alias("value"), (F.col("start") + F.col("inner")).alias("start"), "w")


def _with_position(rows: DataFrame, column: str, seed: int, total: int, in_order: bool = False) -> DataFrame:
    at = materialize(_positions(rows, column, seed, in_order), "positions").toDF("_value", "_start", "_w")
    within = unit_hash(F.col("doc_id"), F.col("text_crc32"), F.col("row"), seed=seed)
    position = (F.col("_start") + within * F.col("_w")) / F.lit(float(max(total, 1)))
    joined = rows.join(at, F.col(column).eqNullSafe(F.col("_value")))
    return joined.withColumn("at", F.concat("at", F.array(position))).drop("_value", "_start", "_w")


def _first_reaching_goal(rows: DataFrame) -> dict:
    """By node: the bin whose running bytes first reach the node's goal, the bytes before and with it."""
    upto = Window.partitionBy("base").orderBy("bin")
    sums = rows.groupBy("base", "goal", "bin").agg(F.sum("size").alias("w"))
    sums = sums.withColumn("upto", F.sum("w").over(upto)).where(F.col("upto") >= F.col("goal"))
    first = F.min(F.struct("bin", (F.col("upto") - F.col("w")).alias("before"), "upto"))
    return {r.base: r for r in sums.groupBy("base").agg(first.alias("b")).select("base", "b.*").collect()}


def _join_nodes(rows: DataFrame, nodes: list[tuple], schema: str, how: str = "inner") -> DataFrame:
    names = [column.split()[0] for column in schema.split(", ")]
    table = local_table(rows.sparkSession, [dict(zip(names, n, strict=True)) for n in nodes], schema)
    return rows.join(F.broadcast(table) if len(nodes) <= BROADCAST_NODES else table, "base", how)


def _place() -> Column:
    """Where a document lies in its node's box, in bins."""
    return (F.get("at", F.col("dim")) - F.col("low")) / F.col("width") * BINS


def _bin(place: Column) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor(place))).cast("int")


def _split(rows: DataFrame, nodes: list[dict]) -> tuple[DataFrame, list[dict]]:
    """Split every node of more than one shard; ``base``, a node's first shard, names it."""
    inner = [n for n in nodes if n["k"] > 1]
    for n in inner:
        n["dim"] = max(range(len(n["box"])), key=lambda d: n["box"][d][1] - n["box"][d][0])
        n["low"], high = n["box"][n["dim"]]
        n["width"] = high - n["low"]
        n["goal"] = n["bytes"] * (n["k"] // 2) / n["k"]
    coarse_nodes = [(n["base"], n["dim"], n["low"], n["width"], n["goal"]) for n in inner]
    box = "base int, dim int, low double, width double"
    coarse = _first_reaching_goal(_join_nodes(rows, coarse_nodes, f"{box}, goal double").withColumn("bin", _bin(_place())))

    fine_nodes = [
        (n["base"], n["dim"], n["low"], n["width"], n["goal"] - coarse[n["base"]].before, coarse[n["base"]].bin)
        for n in inner
        if n["base"] in coarse
    ]
    inside = _join_nodes(rows, fine_nodes, f"{box}, goal double, hit int").where(_bin(_place()) == F.col("hit"))
    fine = _first_reaching_goal(inside.withColumn("bin", _bin((_place() - F.col("hit")) * BINS)))

    cuts, children = [], [n for n in nodes if n["k"] == 1]
    for n in inner:
        left, cut = 0, BINS / 2
        if n["base"] in coarse:
            at, sub = coarse[n["base"]], fine[n["base"]]
            goal = n["goal"] - at.before
            whole = abs(sub.upto - goal) <= abs(sub.before - goal)
            left = at.before + (sub.upto if whole else sub.before)
            cut = at.bin + (sub.bin + (1 if whole else 0)) / BINS
        k = n["k"] // 2
        cuts.append((n["base"], n["dim"], n["low"], n["width"], cut, k))
        edge = n["low"] + n["width"] * cut / BINS
        for base, shards, size, ends in (
            (n["base"], k, left, (n["low"], edge)),
            (n["base"] + k, n["k"] - k, n["bytes"] - left, (edge, n["low"] + n["width"])),
        ):
            sides = [ends if d == n["dim"] else side for d, side in enumerate(n["box"])]
            children.append({"base": base, "k": shards, "bytes": size, "box": sides})
    moved = _join_nodes(rows, cuts, f"{box}, cut double, left_k int", "left")
    right = F.when(_place() >= F.col("cut"), F.col("left_k")).otherwise(0)
    base = F.col("base") + F.coalesce(right, F.lit(0))
    return moved.withColumn("base", base.cast("int")).select(*rows.columns), children


def kd_shards(
    docs: DataFrame,
    shards: int | None = None,
    target_bytes: int | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    metadata: tuple[str, ...] = ("source", "lang"),
    seed: int = 0,
) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row.

    Size is the UTF-8 bytes of the text plus 16 (a null text has none). Dimensions are the
    ``metadata`` columns and the size. Shards have near equal bytes: a cut misses its goal by one
    document. Rows are numbered once, when their metadata are stored, and hashed with their number, so
    repeated rows spread like others. Nulls are a value like any other; an empty table gives an empty
    result. Slots count from 0 in each shard
    without gaps, in hash order. Other columns are ignored.
    """
    body = text_or_empty(F.col(text)).cast("binary")
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(body) + 16).cast("long").alias("size"),
        F.crc32(body).cast("long").alias("text_crc32"),
        *[F.col(c).cast("string").alias(f"m{i}") for i, c in enumerate(metadata)],
    )
    rows = rows.withColumn("size_class", F.floor(F.log2("size") * 64).cast("int"))
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "metadata")
    count, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    if shards is None:
        shards = max(1, math.ceil(total / (target_bytes or 256 << 20)))

    placed = rows.withColumn("at", F.array().cast("array<double>"))
    for i in range(len(metadata)):
        placed = _with_position(placed, f"m{i}", seed + 1 + i, total)
    placed = _with_position(placed, "size_class", seed + 1 + len(metadata), total, in_order=True)
    placed = placed.select("doc_id", "size", "text_crc32", "row", "at", F.lit(0).alias("base"))
    placed = materialize(placed, "placed")

    nodes = [{"base": 0, "k": shards, "bytes": total, "box": [(0.0, 1.0)] * (len(metadata) + 1)}]
    while total and any(n["k"] > 1 for n in nodes):
        placed, nodes = _split(placed, nodes)
    placed = placed.withColumn("place", unit_hash(F.col("doc_id"), F.col("text_crc32"), F.col("row"), seed=seed))
    parts = max(1, count // shards // ROWS_PER_PART)
    slotted = running_total(placed, "base", "place", ["row"], F.lit(1), F.lit(parts), "slot")
    return slotted.select(
        "doc_id", "size", "text_crc32", F.col("base").alias("shard"), F.col("slot").cast("long").alias("slot")
    )
