"""Jaccard self-join on word shingles by T-occurrence search.

1. Equal shingle sets become one class. Heavy shingles (a bounded list) are found in the same pass.
2. An inverted index over all classes, built in hash ranges, tells how many classes each shingle has;
   one with a single class has no partner, and a class that shares fewer than 80 % of its shingles can
   have none. Slices of documents ask ranges and get back what is shared.
3. Partners share a shingle among the rarest fifth of each (prefix filter), so components over those
   shingles hold all pairs. Small components are packed together; a component beyond a block is cut
   into blocks by set size and hash, and each pair of blocks whose sizes can match is one group.
4. In a group, DivideSkip searches every set: the short inverted lists are merged by a heap, sets that
   can still reach the overlap are probed by binary search for the shingles of the long lists.
5. Links reduce to a forest inside the group; components of the forests give the result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcensus.llm.common import materialize, pieces, release_kept
from gridcensus.llm.components import connected_components
from gridcensus.llm.packing import pack, unpack, word_lists

WORDS = 5
SLICE_BYTES = 4 << 20
KEYS_PER_RANGE = 1_200_000
LEAST_RANGES = 48
#: Shingles that the index leaves out because very many documents have them; this bounds a broadcast
#: and decides only where a shingle stands in the order, never whether it counts.
HEAVY = 65_536
HEAVY_SHARE = 512
HEAVY_ORDER = 1 << 40
#: Sets in one block of a group.
BLOCK = 512
#: Weight of the list length in the number of long lists, as proposed with DivideSkip.
MU = 0.0085
ANSWER = ["slice", "keys", "owners", "df", "cids", "ns"]
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Set sizes, and the sorted keys of each text's set one after the other."""
    sizes, index, words = word_lists(texts)
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)[index]
    counts = np.where(sizes >= WORDS, sizes - WORDS + 1, np.minimum(sizes, 1))
    doc = np.repeat(np.arange(len(sizes)), counts)
    ends = np.cumsum(sizes)
    place = np.repeat(ends - sizes, counts) + np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
    padded = np.concatenate((hashes, np.zeros(WORDS, np.uint64)))
    keys = np.zeros(len(doc), np.uint64)
    for k in range(WORDS):
        keys = (keys ^ (keys >> np.uint64(31))) * _MIX + padded[place + k]
    keys = (keys ^ (keys >> np.uint64(29))) * _MIX
    short = np.flatnonzero((sizes > 0) & (sizes < WORDS))
    first = np.cumsum(counts) - counts
    for d in short:
        keys[first[d]] = xxhash.xxh64_intdigest(hashes[ends[d] - sizes[d] : ends[d]].tobytes(), seed=int(sizes[d]))
    # the lowest byte is left out: 56 bits tell the shingles of any two texts apart, and travel lighter
    keys &= ~np.uint64(255)
    order = np.lexsort((keys, doc))
    keys, doc = keys[order], doc[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
    return np.bincount(doc[new], minlength=len(sizes)), keys[new]


def _classes(sizes: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """A 63-bit hash of each set; 0 for empty sets."""
    ends = np.cumsum(sizes)
    sets = zip(ends, sizes, strict=True)
    return np.array([xxhash.xxh64_intdigest(keys[e - n : e].tobytes()) >> 1 if n else 0 for e, n in sets], np.int64)


def _firsts(sizes: np.ndarray, keys: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct non-empty classes of a slice, their sizes, and the keys with the class each belongs to."""
    cids, first = np.unique(classes, return_index=True)
    cids, first = cids[cids != 0], first[cids != 0]
    place = np.full(len(sizes), -1)
    place[first] = np.arange(len(first))
    owner = np.repeat(place, sizes)
    return cids, sizes[first], keys[owner >= 0], owner[owner >= 0]


def document_classes(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, np.ndarray]:
    """doc_id, n and class of every row; and the heavy shingles."""
    kind = dict(docs.dtypes)[doc_id]
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_kept()
        for batch in batches:
            for part in pieces(batch, SLICE_BYTES):
                sizes, keys = shingle_sets(part["text"])
                classes = _classes(sizes, keys)
                cids, _, own, _ = _firsts(sizes, keys, classes)
                found, seen = np.unique(own, return_counts=True)
                some = seen >= max(8, len(cids) // (HEAVY_SHARE // 2))
                n, m = part.num_rows, int(some.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([part["id"], pa.nulls(m, part["id"].type)]),
                        pa.concat_arrays([pa.array(sizes, pa.int64()), pa.nulls(m, pa.int64())]),
                        pa.concat_arrays([pa.array(classes), pa.nulls(m, pa.int64())]),
                        pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(found[some].view(np.int64))]),
                        pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(seen[some], pa.int64())]),
                    ],
                    ["doc_id", "n", "cid", "heavy", "seen"],
                )

    found = materialize(rows.mapInArrow(run, f"doc_id {kind}, n long, cid long, heavy long, seen long"), "sets")
    members = found.where("n is not null").select("doc_id", "n", "cid")
    least = max(64, members.count() // HEAVY_SHARE)
    heavy = found.where("heavy is not null").groupBy("heavy").agg(F.sum("seen").alias("seen")).where(F.col("seen") >= least)
    heavy = heavy.orderBy(F.desc("seen"), "heavy").limit(HEAVY).collect()
    return members, np.sort(np.array([r["heavy"] for r in heavy], np.int64).view(np.uint64))


def shared_sets(docs: DataFrame, text: str, heavy: np.ndarray, ranges: int) -> DataFrame:
    """cid, n, keys (shared ones, rarest first) and how many of them are in the prefix, where partners are possible."""
    edges = (np.arange(1, ranges, dtype=np.uint64) * np.uint64(((1 << 64) - 1) // ranges)).astype(np.uint64)
    known = docs.sparkSession.sparkContext.broadcast(heavy)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_kept()
        for batch in batches:
            for part in pieces(batch, SLICE_BYTES):
                sizes, keys = shingle_sets(part["text"])
                cids, ns, own, owner = _firsts(sizes, keys, _classes(sizes, keys))
                if not len(cids):
                    continue
                # equal slices have equal numbers, and then equal classes
                number = xxhash.xxh64_intdigest(cids.tobytes()) >> 1
                is_heavy = np.isin(own, known.value)
                heads = (pack(own[is_heavy]), pack(owner[is_heavy].astype(np.int32)), pack(cids), pack(ns.astype(np.int32)))
                rows = [(-1 - number % 64, number, *heads)]
                own, owner = own[~is_heavy], owner[~is_heavy]
                order = np.argsort(own, kind="stable")
                own, owner = own[order], owner[order]
                cuts = np.concatenate(([0], np.searchsorted(own, edges), [len(own)]))
                for r in range(ranges):
                    if cuts[r] < cuts[r + 1]:
                        s = slice(cuts[r], cuts[r + 1])
                        steps = pack(np.diff(own[s], prepend=np.uint64(0)))
                        rows.append((r, number, steps, pack(owner[s].astype(np.int32)), pack(cids), None))
                kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 4]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                    ["range", "slice", "keys", "owners", "cids", "ns"],
                )

    def index(group: pa.Table) -> pa.Table:
        release_kept()
        numbers = group["slice"].to_pylist()
        if group["range"][0].as_py() < 0:
            passed = {n: group[n] for n in ("slice", "keys", "owners", "cids", "ns")}
            return pa.table(passed | {"df": pa.nulls(len(numbers), pa.binary())}).select(ANSWER)
        keys = [np.cumsum(unpack(b, np.uint64), dtype=np.uint64) for b in group["keys"].to_pylist()]
        owners = [unpack(b, np.int32) for b in group["owners"].to_pylist()]
        cid = np.concatenate([unpack(b, np.int64)[o] for b, o in zip(group["cids"].to_pylist(), owners, strict=True)])
        _, which = np.unique(np.concatenate(keys), return_inverse=True)
        # a class that several slices hold counts once
        order = np.lexsort((cid, which))
        which_sorted, cid = which[order], cid[order]
        new = np.ones(len(order), bool)
        new[1:] = (which_sorted[1:] != which_sorted[:-1]) | (cid[1:] != cid[:-1])
        df = np.bincount(which_sorted[new])[which]
        del cid, order, which, which_sorted, new
        rows, at = [], 0
        for number, own, owner in zip(numbers, keys, owners, strict=True):
            mine = df[at : at + len(own)]
            at += len(own)
            shared = mine > 1
            if shared.any():
                rows.append((number, pack(own[shared]), pack(owner[shared]), pack(mine[shared])))
        columns = list(zip(*rows, strict=True)) or [[], [], [], []]
        blank = pa.nulls(len(rows), pa.binary())
        return pa.table(
            {"slice": pa.array(columns[0], pa.int64())}
            | {n: pa.array(c, pa.binary()) for n, c in zip(("keys", "owners", "df"), columns[1:], strict=True)}
            | {"cids": blank, "ns": blank}
        ).select(ANSWER)

    def gather(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        head = next(r for r in rows if r["cids"] is not None)
        cids, ns = unpack(head["cids"], np.int64), unpack(head["ns"], np.int32).astype(np.int64)
        keys = np.concatenate([unpack(r["keys"], np.uint64) for r in rows])
        owner = np.concatenate([unpack(r["owners"], np.int32) for r in rows])
        orders = []
        for r in rows:
            heavy_ones = r["df"] is None
            orders.append(np.full(len(unpack(r["owners"], np.int32)), HEAVY_ORDER) if heavy_ones else unpack(r["df"], np.int64))
        df = np.concatenate(orders)
        order = np.lexsort((keys, df, owner))
        keys, owner, df = keys[order], owner[order], df[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
        keys, owner = keys[new], owner[new]
        shared = np.bincount(owner, minlength=len(cids))
        least = -(-4 * ns // 5)
        # unique shingles come first in the order, so they fill the prefix first
        prefix = (ns - least + 1) - (ns - shared)
        ends = np.cumsum(shared)
        alive = np.flatnonzero((shared >= least) & (prefix > 0))
        return pa.table(
            {
                "cid": cids[alive],
                "n": ns[alive],
                "keys": pa.array([keys[ends[i] - shared[i] : ends[i]].tobytes() for i in alive], pa.binary()),
                "prefix": pa.array(np.minimum(prefix[alive], shared[alive]), pa.int32()),
            }
        )

    asked = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(
        ask, "range int, slice long, keys binary, owners binary, cids binary, ns binary"
    )
    answers = asked.groupBy("range").applyInArrow(
        index, "slice long, keys binary, owners binary, df binary, cids binary, ns binary"
    )
    found = answers.groupBy("slice").applyInArrow(gather, "cid long, n long, keys binary, prefix int")
    return materialize(found.dropDuplicates(["cid"]), "shared")


def _prefixes(sets: DataFrame) -> DataFrame:
    """key and cid for each shingle in a class's prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [np.frombuffer(k.as_py(), np.int64)[: p.as_py()] for k, p in zip(batch["keys"], batch["prefix"], strict=True)]
            if keys:
                cid = np.repeat(batch["cid"].to_numpy(), [len(k) for k in keys])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(cid)], ["key", "cid"])

    return sets.select("cid", "keys", "prefix").mapInArrow(run, "key long, cid long")


def divide_skip(query: np.ndarray, least: int, lists: dict[int, np.ndarray], sets: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """(set, overlap) of every set that shares at least ``least`` keys with the query.

    ``lists`` maps a key to the sorted numbers of the sets that hold it, and ``sets`` holds sorted keys.
    The longest lists are left out of the merge, fewer than ``least`` of them; a set must then be met
    in the short lists at least ``least`` less that number of times, and is probed for the rest.
    """
    own = sorted((k for k in query.tolist() if k in lists), key=lambda k: (len(lists[k]), k))
    if len(own) < least:
        return
    longest = max(2, len(lists[own[-1]]))
    n_long = min(least - 1, int(least / (MU * math.log(longest) + 1)))
    short, long_keys = own[: len(own) - n_long], np.array(own[len(own) - n_long :], query.dtype)
    for member, met in groupby(heapq.merge(*[lists[k].tolist() for k in short])):
        count = sum(1 for _ in met)
        if count >= least - n_long:
            keys = sets[member]
            place = np.minimum(np.searchsorted(keys, long_keys), len(keys) - 1)
            overlap = count + int((keys[place] == long_keys).sum())
            if overlap >= least:
                yield member, overlap


def _search(group: pa.Table) -> pa.Table:
    """cid, root (in the group's forest) and linked documents of the sets of one group."""
    cids, ns = group["cid"].to_numpy(), group["n"].to_numpy()
    weight, side = group["docs"].to_numpy(), group["side"].to_numpy()
    sets = [np.sort(np.frombuffer(k.as_py(), np.int64)) for k in group["keys"]]
    # side 0 is searched in itself, or side 1 in side 2
    held = np.flatnonzero(side != 1)
    keys = np.concatenate([sets[i] for i in held]) if len(held) else np.empty(0, np.int64)
    owner = np.repeat(held, [len(sets[i]) for i in held])
    order = np.lexsort((owner, keys))
    keys, owner = keys[order], owner[order]
    distinct, start = np.unique(keys, return_index=True)
    lists = dict(zip(distinct.tolist(), np.split(owner, start[1:]), strict=True)) if len(keys) else {}
    parent = list(range(len(cids)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = np.zeros(len(cids), np.int64)
    for q in np.flatnonzero(side != 2):
        for member, overlap in divide_skip(sets[q], -(-4 * int(ns[q]) // 5), lists, sets):
            both = int(ns[q] + ns[member]) - overlap
            if (side[q] == 1 or member > q) and 100 * overlap >= 80 * both:
                links[q] += weight[member]
                links[member] += weight[q]
                a, b = find(q), find(member)
                parent[max(a, b)] = min(a, b)
    linked = np.flatnonzero(links)
    return pa.table({"cid": cids[linked], "root": pa.array([cids[find(i)] for i in linked], pa.int64()), "links": links[linked]})


def _groups(sets: DataFrame, candidates: DataFrame) -> DataFrame:
    """The sets with the group they are searched in and their side (0: against itself, 1 against 2)."""
    placed = sets.join(candidates, F.col("cid") == F.col("node")).drop("node")
    # linked sizes differ by a factor of 5/4 at most: classes of that width match themselves and the next
    placed = placed.withColumn("size_class", F.floor(F.log("n") / F.log(F.lit(1.25)) + 1e-9).cast("int"))
    placed = materialize(placed, "placed")
    held = placed.groupBy("root").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    # packs of a quarter block on average, so that chance rarely fills one with several large components
    packs = max(1, 4 * placed.count() // BLOCK)
    small = placed.join(held.where(F.col("members") <= BLOCK), "root")
    pack_of = F.concat(F.lit("p"), F.pmod(F.xxhash64("root"), F.lit(packs)).cast("string"))
    small = small.select("cid", "n", "keys", "docs", pack_of.alias("group"), F.lit(0).alias("side"))

    large = placed.join(held.where(F.col("members") > BLOCK).select("root"), "root")
    counted = large.groupBy("root", "size_class").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    counted = materialize(counted, "blocks")
    above = counted.select(F.col("root").alias("r1"), (F.col("size_class") - 1).alias("c1"), F.col("blocks").alias("blocks_above"))
    below = counted.select(F.col("root").alias("r2"), (F.col("size_class") + 1).alias("c2"), F.col("blocks").alias("blocks_below"))
    counted = counted.join(above, (F.col("root") == F.col("r1")) & (F.col("size_class") == F.col("c1")), "left")
    counted = counted.join(below, (F.col("root") == F.col("r2")) & (F.col("size_class") == F.col("c2")), "left")
    large = large.join(counted.drop("r1", "c1", "r2", "c2"), ["root", "size_class"])
    large = large.withColumn("block", F.pmod(F.xxhash64(F.lit(4), "cid"), "blocks").cast("int"))

    def group(low_class: Column, low: Column, high_class: Column, high: Column) -> Column:
        parts = [F.col("root"), low_class, low, high_class, high]
        return F.concat(F.lit("b"), F.concat_ws("/", *[part.cast("string") for part in parts]))

    def upto(n: Column) -> Column:
        return F.when(F.coalesce(n, F.lit(0)) > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    c, b = F.col("size_class"), F.col("block")
    same = F.transform(
        upto(F.col("blocks")),
        lambda o: F.struct(
            group(c, F.least(b, o), c, F.greatest(b, o)).alias("group"),
            F.when(o == b, 0).when(b < o, 1).otherwise(2).alias("side"),
        ),
    )
    up = F.transform(
        upto(F.col("blocks_above")), lambda o: F.struct(group(c, b, c + 1, o).alias("group"), F.lit(1).alias("side"))
    )
    down = F.transform(
        upto(F.col("blocks_below")), lambda o: F.struct(group(c - 1, o, c, b).alias("group"), F.lit(2).alias("side"))
    )
    spread = large.withColumn("to", F.explode(F.concat(same, up, down)))
    return small.union(spread.select("cid", "n", "keys", "docs", "to.group", "to.side"))


def overlap_join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and n_links (other documents linked) of every row.

    Null texts and texts without words have an empty set and no links; a component is named by its
    least id. Repeated rows have equal sets and are linked; with null ids a component's least known
    id counts. An empty table gives none; other columns are ignored. Sets are compared by 56-bit
    hashes of their shingles, and equal sets are recognised by a 63-bit hash.
    """
    members, heavy = document_classes(docs, doc_id, text)
    shingles = members.where("n > 0").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    sets = shared_sets(docs, text, heavy, max(LEAST_RANGES, shingles // KEYS_PER_RANGE))

    classes = members.where("n > 0").groupBy("cid").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("docs"))
    classes = materialize(classes, "classes")
    prefixes = materialize(_prefixes(sets), "prefixes")
    first = prefixes.groupBy("key").agg(F.min("cid").alias("a"), F.count(F.lit(1)).alias("m")).where("m > 1").select("key", "a")
    candidates = connected_components(prefixes.join(first, "key").select("a", F.col("cid").alias("b")).distinct())

    weighted = sets.select("cid", "n", "keys").join(classes.select("cid", "docs"), "cid")
    found = _groups(weighted, candidates).groupBy("group").applyInArrow(_search, "cid long, root long, links long")
    found = materialize(found, "links")
    roots = connected_components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    named = classes.join(roots, F.col("cid") == F.col("node"), "left").join(links, "cid", "left")
    named = named.withColumn("root", F.coalesce("root", "cid"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    verdict = named.join(least, "root").select(
        F.col("cid").alias("of"), "component_id", (F.col("docs") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    joined = members.join(verdict, F.col("cid") == F.col("of"), "left")
    return joined.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )
