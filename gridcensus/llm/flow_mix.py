"""Mixing overlapping sources to target weights by a min-cost flow.

Documents are summed by membership pattern (the set of sources they belong to). A pattern can hand
its words to any of its sources, once at cost 1, a second time at cost 3, a third at 5: convex costs
that spread repeats evenly. The flow fills each source's quota at least cost; then a seeded choice of
documents takes what the flow asks of each pattern. Only sums per pattern reach the driver, one row
for each distinct set of sources.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcensus.llm.common import local_table, materialize, running_total, unit_hash, word_count

ROWS_PER_PART = 256
BROADCAST_PATTERNS = 100_000


def water_fill(sizes: Sequence[int], weights: Sequence[float], total: float, most: Sequence[float]) -> list[float]:
    """Share ``total`` by weight, stop each share at its ``most`` and share the excess again."""
    shares = [0.0] * len(sizes)
    free = [i for i in range(len(sizes)) if weights[i] > 0]
    while free:
        rate = total / sum(weights[i] for i in free)
        full = [i for i in free if weights[i] * rate > most[i]]
        if not full:
            for i in free:
                shares[i] = weights[i] * rate
            break
        for i in full:
            shares[i] = float(most[i])
            total -= most[i]
        free = [i for i in free if i not in set(full)]
    return shares


class _Network:
    def __init__(self) -> None:
        self.to: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []
        self.out: dict[object, list[int]] = defaultdict(list)
        self.names: dict[object, int] = {}

    def node(self, name: object) -> int:
        return self.names.setdefault(name, len(self.names))

    def edge(self, a: object, b: object, room: int, cost: int) -> int:
        u, v = self.node(a), self.node(b)
        for x, y, r, c in ((u, v, room, cost), (v, u, 0, -cost)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.room.append(r)
            self.cost.append(c)
        return len(self.to) - 2

    def fill(self, source: object, sink: object) -> None:
        """Successive cheapest paths; node potentials keep reduced costs from falling below 0."""
        start, end, n = self.names[source], self.names[sink], len(self.names)
        potential = [0] * n
        while True:
            far: dict[int, int] = {start: 0}
            came: dict[int, int] = {}
            queue = [(0, start)]
            while queue:
                d, u = heapq.heappop(queue)
                if d > far[u]:
                    continue
                for e in self.out[u]:
                    v = self.to[e]
                    there = d + self.cost[e] + potential[u] - potential[v]
                    if self.room[e] > 0 and there < far.get(v, there + 1):
                        far[v], came[v] = there, e
                        heapq.heappush(queue, (there, v))
            if end not in far:
                return
            for v in range(n):
                potential[v] += min(far.get(v, far[end]), far[end])
            path, v = [], end
            while v != start:
                path.append(came[v])
                v = self.to[came[v] ^ 1]
            amount = min(self.room[e] for e in path)
            for e in path:
                self.room[e] -= amount
                self.room[e ^ 1] += amount


def route(patterns: dict[tuple, int], quotas: dict[object, int], max_repeats: int) -> dict[tuple[tuple, object], int]:
    """Words that each pattern hands to each of its sources: a min-cost flow per connected component."""
    parent: dict[object, object] = {}

    def find(x: object) -> object:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for pattern in patterns:
        for s in pattern[1:]:
            parent[find(s)] = find(pattern[0])
    parts: dict[object, list[tuple]] = defaultdict(list)
    for pattern in patterns:
        if pattern:
            parts[find(pattern[0])].append(pattern)

    flows: dict[tuple[tuple, object], int] = {}
    for members in parts.values():
        net = _Network()
        hands = []
        for pattern in members:
            for copy in range(max_repeats):
                net.edge("from", ("p", pattern), patterns[pattern], 2 * copy + 1)
            for s in pattern:
                hands.append((pattern, s, net.edge(("p", pattern), ("s", s), max_repeats * patterns[pattern], 0)))
        for s in {s for pattern in members for s in pattern}:
            net.edge(("s", s), "to", quotas.get(s, 0), 0)
        net.fill("from", "to")
        for pattern, s, e in hands:
            flows[pattern, s] = net.room[e ^ 1]
    return flows


def flow_mix(
    docs: DataFrame,
    quotas: Callable[[dict], dict],
    sources: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    max_repeats: int = 2,
    seed: int = 7,
) -> DataFrame:
    """doc_id, size (words), sources, taken (words, repeats counted) and charged_to of every row.

    ``sources`` is an array column: the sources that a document belongs to, where null is a source of
    its own and an empty array belongs to none. ``quotas`` turns {source: words} into {source: words
    wanted}; a source gets its quota as far as ``max_repeats`` copies of its documents go. A pattern's
    documents are ordered by a seeded hash of id, size and the number of the row, given once: all take the whole copies that the flow
    asks for, the first ones that fit into the rest one copy more, and then the one document
    whose size is nearest to the words still missing. ``charged_to`` is the source whose quota the document's first words fill.
    Repeated rows are taken one by one; texts without words take 0; an empty table gives none.
    """
    spark = docs.sparkSession
    keyed = F.array_sort(F.array_distinct(F.transform(sources, lambda s: F.coalesce(F.concat(F.lit("="), s), F.lit("-")))))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        word_count(F.col(text)).alias("size"),
        F.coalesce(keyed, F.array().cast("array<string>")).alias("pattern"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = materialize(rows, "sizes")
    found = rows.groupBy("pattern").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()
    patterns = {tuple(r["pattern"]): r["size"] for r in found}
    counts = {tuple(r["pattern"]): r["n"] for r in found}

    plain = {s: None if s == "-" else s[1:] for p in patterns for s in p}
    held: dict = defaultdict(int)
    for p, size in patterns.items():
        for s in p:
            held[plain[s]] += size
    wanted = {f"={s}" if s is not None else "-": max(0, round(q)) for s, q in quotas(dict(held)).items()}
    flows = route(patterns, wanted, max_repeats)

    table = []
    for p, size in patterns.items():
        given = [(s, flows[p, s]) for s in p if flows.get((p, s))]
        total = sum(f for _, f in given)
        ends, upto = [], 0
        for s, f in given:
            upto += f
            ends.append({"source": plain[s], "upto": upto / total})
        copies, rest = divmod(total, size) if size else (0, 0)
        parts = max(1, counts[p] // ROWS_PER_PART)
        table.append({"pattern": p, "held": size, "copies": copies, "rest": rest, "parts": parts, "charges": ends})
    schema = "pattern array<string>, held long, copies long, rest long, parts long"
    plan = local_table(spark, table, f"{schema}, charges array<struct<source: string, upto: double>>")

    def by_pattern(one_row_each: DataFrame) -> DataFrame:
        return F.broadcast(one_row_each) if len(table) <= BROADCAST_PATTERNS else one_row_each

    rows = rows.join(by_pattern(plan), "pattern")
    rows = rows.withColumn("place", unit_hash(F.col("doc_id"), F.col("size"), F.col("row"), seed=seed))
    rows = rows.withColumn("group", F.array_join("pattern", "\x01"))
    ordered = running_total(rows, "group", "place", ["row"], F.col("size"), F.col("parts"), "before")
    ordered = materialize(ordered, "ordered")
    fits = F.col("before") + F.col("size") <= F.col("rest")
    gaps = ordered.groupBy("group").agg(
        (F.first("rest") - F.coalesce(F.max(F.when(fits, F.col("before") + F.col("size"))), F.lit(0))).alias("gap")
    )
    miss = F.abs(F.col("size") - F.col("gap"))
    best = F.min(F.when(~fits & (miss < F.col("gap")), F.struct(miss.alias("miss"), F.col("before").alias("at"))))
    last = ordered.join(by_pattern(gaps), "group").groupBy("group").agg(best["at"].alias("last"))
    ordered = ordered.join(by_pattern(last), "group")
    extra = F.when(fits | (F.col("before") == F.col("last")), 1).otherwise(0)
    share = F.col("before") / F.col("held")
    charged = F.get(F.filter("charges", lambda c: share < c["upto"]), F.lit(0))["source"]
    return ordered.select(
        "doc_id",
        "size",
        F.transform("pattern", lambda s: F.when(s != "-", F.substring(s, 2, 1 << 30))).alias("sources"),
        (F.col("size") * (F.col("copies") + extra)).cast("long").alias("taken"),
        charged.alias("charged_to"),
    )
