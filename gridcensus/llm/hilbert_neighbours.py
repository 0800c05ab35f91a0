"""Nearest neighbours along shifted Hilbert curves, completed by an exact scan under a bound.

Vectors are projected by several seeded rotations, shifted, and ordered along a Hilbert curve each;
Spark range-partitions the orderings. A query reads the windows around its place on every curve, and
what the windows hold is ranked by the exact inner product.

The windows are of fixed size, so their last score is only a floor for what a query still needs. All
candidates are then read once more along the first curve, in chunks with a centre and a radius: the
product with the centre plus the radius times the query's norm bounds every product of a chunk, and a
query skips the chunks whose bound is below its floor. The rest is multiplied out, so no neighbour is
missed. Where the vectors spread alike in all directions the bound skips little, and the scan then
costs a product for each query and candidate.

For inner products, candidates get one component more so that all have the largest norm, and queries
are scaled to it: the largest inner product then is the least distance, which the curves follow.
Equal vectors are one candidate that keeps its k + 1 smallest ids, so any number of copies takes one
place on a curve and ties still go to the smallest ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcensus.llm.common import materialize

CURVES = 16
DIMS, BITS = 10, 6
#: Candidates of one block; a query reads the block of its place and those before and after it.
BLOCK = 4096
#: Candidates of one chunk of the scan, and the bytes of query vectors that are broadcast at a time.
CHUNK = 1024
ROUND_BYTES = 16 << 20
SEED = 8


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of integer coordinates on the Hilbert curve, as one integer.

    The usual two steps: undo the reflections and exchanges of axes from the top bit down, then
    turn the Gray code into a count; the bits of all axes are then read in turn.
    """
    x = [cells[:, i].astype(np.uint64) for i in range(cells.shape[1])]
    for bit in range(bits - 1, 0, -1):
        top, low = np.uint64(1 << bit), np.uint64((1 << bit) - 1)
        for axis in range(len(x)):
            set_ = (x[axis] & top) != 0
            swap = np.where(set_, np.uint64(0), (x[0] ^ x[axis]) & low)
            x[0] = np.where(set_, x[0] ^ low, x[0] ^ swap)
            x[axis] = x[axis] ^ swap
    for axis in range(1, len(x)):
        x[axis] = x[axis] ^ x[axis - 1]
    flip = np.zeros(len(cells), np.uint64)
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] & np.uint64(1 << bit)) != 0, np.uint64((1 << bit) - 1), np.uint64(0))
    key = np.zeros(len(cells), np.uint64)
    for bit in range(bits - 1, -1, -1):
        for axis in x:
            key = (key << np.uint64(1)) | (((axis ^ flip) >> np.uint64(bit)) & np.uint64(1))
    return key.astype(np.int64)


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors as rows; shorter ones are padded with zeros."""
    out = np.zeros((len(column), dim))
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(column)), sizes)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = column.flatten().to_numpy(zero_copy_only=False)
    return out


class Curves:
    """Seeded rotations and shifts, scaled by the mean and spread of all vectors."""

    def __init__(self, mean: np.ndarray, spread: float, longest: float, curves: int) -> None:
        rng = np.random.default_rng(SEED)
        dim = len(mean) + 1
        self.longest, self.spread = longest, spread or 1.0
        self.mean = np.append(mean, 0.0)
        self.turns = [np.linalg.qr(rng.normal(size=(dim, max(dim, DIMS))).T)[0].T[:, :DIMS] for _ in range(curves)]
        self.shifts = [rng.random(DIMS) * 0.25 for _ in range(curves)]

    def keys(self, vectors: np.ndarray, query: bool) -> list[np.ndarray]:
        norms = np.linalg.norm(vectors, axis=1)
        rest = np.sqrt(np.maximum(0.0, self.longest**2 - norms**2))
        if query:
            vectors, rest = vectors * (self.longest / norms)[:, None], np.zeros(len(norms))
        x = (np.column_stack((vectors, rest)) - self.mean) / self.spread
        found = []
        for turn, shift in zip(self.turns, self.shifts, strict=True):
            y = (x @ turn + 4) / 8 * 0.75 + shift[: turn.shape[1]]
            found.append(hilbert_key(np.clip(y * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64), BITS))
        return found


def _best(queries: np.ndarray, candidates: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query the k largest products, ties to smaller ids, summed in one order everywhere."""
    for at in range(0, len(queries), 64):
        rough = queries[at : at + 64] @ candidates.T
        for i, row in enumerate(rough):
            # a few more than k, as the rough product may differ in its last bit
            near = np.argpartition(-row, k + 8)[: k + 8] if len(row) > k + 8 else np.arange(len(row))
            floor = row[near].min()
            near = np.flatnonzero(row >= floor - 1e-9 * max(1.0, abs(floor)))
            exact = (queries[at + i] * candidates[near]).sum(1)
            order = np.lexsort((ids[near], -exact))[:k]
            yield at + i, ids[near][order], exact[order]


class Floors:
    """Queries of one round with the last (score, id) that the curves found for each; -inf where too few."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, scores: np.ndarray, last: np.ndarray, longest: float) -> None:
        self.ids, self.x, self.scores, self.last = ids, x, scores, last
        self.norms = np.linalg.norm(x, axis=1)
        # more than any order of summation can differ by
        self.slack = 4 * (x.shape[1] + 8) * np.finfo(float).eps * self.norms * longest


def _scan(chunks: Iterator[tuple[np.ndarray, np.ndarray]], asks: Floors, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query the k best candidates of all chunks (ids, vectors) that are not below its floor."""
    scores, last = asks.scores.copy(), asks.last.copy()
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for ids, x in chunks:
        centre = x.mean(0)
        radius = np.sqrt(((x - centre) ** 2).sum(1).max())
        # written so that what is not a number is searched
        open_ = np.flatnonzero(~(asks.x @ centre + asks.norms * radius < scores - asks.slack))
        for at in range(0, len(open_), 256):
            some = open_[at : at + 256]
            hits = ~(asks.x[some] @ x.T < (scores[some] - asks.slack[some])[:, None])
            for j in np.flatnonzero(hits.any(1)):
                i, near = some[j], np.flatnonzero(hits[j])
                exact = (asks.x[i] * x[near]).sum(1)
                good = (exact > scores[i]) | ((exact == scores[i]) & (ids[near] <= last[i]))
                if good.any():
                    own, score = ids[near[good]], exact[good]
                    if i in held:
                        own, score = np.concatenate((held[i][0], own)), np.concatenate((held[i][1], score))
                    order = np.lexsort((own, -score))[:k]
                    held[i] = own[order], score[order]
                    if len(order) == k:
                        scores[i], last[i] = score[order[-1]], own[order[-1]]
    for i, (own, score) in held.items():
        yield i, own, score


def _complete(candidates: DataFrame, queries: DataFrame, dim: int, longest: float, k: int) -> list[DataFrame]:
    """q, c and score of all candidates (c, v) that are not below the floor of a query (q, v, score, last).

    Queries are broadcast in rounds of bounded size; candidates are read where they lie.
    """
    spark = candidates.sparkSession
    rounds = max(1, -(-queries.count() * 8 * dim // ROUND_BYTES))
    queries = materialize(queries.withColumn("round", F.pmod(F.xxhash64("q"), F.lit(rounds)).cast("int")), "floors")
    found = []
    for n in range(rounds):
        # about ROUND_BYTES, however many queries there are
        rows = queries.where(F.col("round") == n).toArrow().combine_chunks()
        if not rows.num_rows:
            continue
        columns = [rows[name].to_numpy() for name in ("q", "score", "last")]
        x = _matrix(pa.concat_arrays(rows["v"].chunks), dim)
        shared = spark.sparkContext.broadcast(Floors(columns[0], x, columns[1], columns[2], longest))

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            parts = (b.slice(at, CHUNK) for b in batches for at in range(0, b.num_rows, CHUNK))
            chunks = ((p["c"].to_numpy(), _matrix(p["v"], dim)) for p in parts)
            for i, near, score in _scan(chunks, shared.value, k):
                q = np.full(len(near), shared.value.ids[i])
                yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(near), pa.array(score)], ["q", "c", "score"])

        found.append(materialize(candidates.mapInArrow(scan, "q long, c long, score double"), "scanned"))
        shared.destroy()
    return found


def hilbert_neighbours(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    curves: int = CURVES,
    block: int = BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id and score: the k largest inner products of each query row.

    Rows with a null id, and vectors that are null, zero or hold nulls or non-finite components, take
    no part. The search is exact; ``curves`` and ``block`` decide how much of it the curves do. A row
    that is repeated with its id is one row. An empty table gives none; other columns are ignored.
    """
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("id"),
        F.col(vector).cast("array<double>").alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("q"),
    ).where(F.col("id").isNotNull() & _usable(F.col("v")))
    # the k + 1 smallest ids of equal vectors; Spark limits each task's rows before the shuffle
    nth = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    few = rows.select("v", "id").withColumn("nth", nth).where(F.col("nth") <= k + 1)
    classes = few.groupBy("v").agg(F.sort_array(F.collect_set("id")).alias("ids"))
    classes = materialize(classes.select(F.get("ids", F.lit(0)).alias("c"), "v", "ids"), "classes")
    queries = rows.where("q").select("id", "v").distinct().join(classes.select("v", "c"), "v").select("id", "c")
    queries = materialize(queries, "queries")
    asked = queries.select("c").distinct()
    marked = classes.join(asked.withColumn("asked", F.lit(True)), "c", "left")
    marked = marked.select("c", "v", F.col("asked").isNotNull().alias("asked"))

    dim = classes.agg(F.max(F.size("v"))).first()[0] or 0
    component = [F.coalesce(F.get("v", F.lit(i)), F.lit(0.0)) for i in range(dim)]
    norm2 = F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x)
    sums = classes.agg(F.max(norm2), F.avg(norm2), *[F.avg(x) for x in component]).first()
    mean = np.array([m or 0.0 for m in sums[2:]])
    spread = max((sums[1] or 0.0) - float(mean @ mean), 0.0) / max(1, dim)
    longest = (sums[0] or 0.0) ** 0.5
    shared = vectors.sparkSession.sparkContext.broadcast(Curves(mean, spread**0.5, longest, curves))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                ids, asked_here = part["c"].to_numpy(), np.array(part["asked"].to_pylist(), bool)
                x = _matrix(part["v"], dim)
                for query, members in ((False, np.ones(len(ids), bool)), (True, asked_here)):
                    if members.any():
                        keys = shared.value.keys(x[members], query)
                        n, own = len(keys), int(members.sum())
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.repeat(np.arange(n, dtype=np.int32), own)),
                                pa.array(np.concatenate(keys)),
                                pa.array(np.tile(ids[members], n)),
                                pa.array(np.full(n * own, query)),
                            ],
                            ["curve", "key", "c", "q"],
                        )

    placed = marked.mapInArrow(place, "curve int, key long, c long, q boolean")
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = placed.repartitionByRange(parts, "curve", "key", "c", "q").sortWithinPartitions("curve", "key", "c", "q")
    ordered = ordered.select("curve", "c", "q", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    ordered = materialize(ordered, "ordered")
    before = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ordered.groupBy("curve", "part")
        .agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
        .select("curve", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    )
    # a row for each curve and range partition
    ranked = ordered.join(F.broadcast(starts), ["curve", "part"])
    here = F.floor((F.col("start") + F.col("at") - F.col("first")) / block).cast("int")
    blocks = F.when(F.col("q"), F.array(here - 1, here, here + 1)).otherwise(F.array(here))
    ranked = ranked.select("curve", "c", "q", F.explode(blocks).alias("block"))
    members = ranked.join(classes.select("c", "v"), "c")

    def search(group: pa.Table) -> pa.Table:
        asks = np.array(group["q"].to_pylist(), bool)
        ids = group["c"].to_numpy()
        x = _matrix(group["v"].combine_chunks(), dim)
        found: list[tuple] = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        if (~asks).any():
            for i, near, score in _best(x[asks], x[~asks], ids[~asks], k + 1):
                found.append((np.full(len(near), ids[asks][i]), near, score))
        q, c, s = (np.concatenate(column) for column in zip(*found, strict=True))
        return pa.table({"q": q, "c": c, "score": s})

    near = members.groupBy("curve", "block").applyInArrow(search, "q long, c long, score double")
    best = Window.partitionBy("q").orderBy(F.desc("score"), "c")
    near = near.groupBy("q", "c").agg(F.max("score").alias("score"))
    near = near.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k + 1)
    near = materialize(near, "near")

    floors = near.where(F.col("nth") == k + 1).select("q", F.col("c").alias("last"), F.col("score"))
    floors = asked.select(F.col("c").alias("q")).join(floors, "q", "left").join(classes.select(F.col("c").alias("q"), "v"), "q")
    nothing = [F.coalesce("score", F.lit(float("-inf"))).alias("score"), F.coalesce("last", F.lit((1 << 63) - 1)).alias("last")]
    # neighbours on the first curve share a chunk, which makes its radius small
    first = ordered.where(~F.col("q") & (F.col("curve") == 0)).select("c", "at").join(classes.select("c", "v"), "c")
    first = materialize(first.repartitionByRange(parts, "at").sortWithinPartitions("at").select("c", "v"), "first")
    near = near.select("q", "c", "score")
    for more in _complete(first, floors.select("q", "v", *nothing), dim, longest, k + 1):
        near = near.unionByName(more)
    near = near.groupBy("q", "c").agg(F.max("score").alias("score"))
    near = near.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k + 1).drop("nth")
    listed = near.join(classes.select("c", "ids"), "c").select("q", "score", F.explode("ids").alias("vec_id"))
    # copies of a query share its list; each leaves itself out
    answers = queries.withColumnRenamed("c", "q").join(listed, "q").where(F.col("id") != F.col("vec_id"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("score"), "vec_id"))
    return answers.select(F.col("id").alias("query_id"), rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
