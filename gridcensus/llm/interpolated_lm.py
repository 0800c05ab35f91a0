"""Language-model scores by deleted interpolation of bigrams, words and a uniform share.

Documents are packed into slices of about eight megabytes. A slice knows its own distinct words and
word pairs; only those, with the slice's counts, travel to the hash range that sums them, and the sums
travel back to the slices that asked. So a word that every document uses is one entry per slice, and
nothing is looked up in a table that grows with the corpus.

Mixture weights depend on how often the context word was seen (buckets by powers of two). They are
learned by expectation-maximisation on a held-out part of the training documents, whose own counts are
taken off the sums first. What EM reads is a bounded grid of counts by bucket and binned estimates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcensus.llm.common import fold, materialize, pieces
from gridcensus.llm.packing import pack, unpack, word_lists

SLICE_BYTES = 8 << 20
#: Text for each range of keys, and the least number of ranges.
BYTES_PER_RANGE = 8 << 20
LEAST_RANGES = 48
BUCKETS = 32
#: Estimates are binned at this many steps for each factor of two.
STEPS = 4
NEVER = 9999
EM_ROUNDS = 60
#: Folds of five: the scored-only one, and the training part that the weights are learned on.
OUTSIDE, LEARN_WEIGHTS = 1, 4
END_KEY, START_KEY = np.uint64(0x5851F42D4C957F2C), np.uint64(0x14057B7EF767814E)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Slice:
    """The tokens of some documents as keys: a word per token, and the pair with the token before."""

    def __init__(self, sizes: np.ndarray, folds: np.ndarray, index: np.ndarray, hashes: np.ndarray) -> None:
        ends = np.cumsum(sizes + 1)
        n = int(ends[-1])
        is_end = np.zeros(n, bool)
        is_end[ends - 1] = True
        self.ends = ends
        # local numbers: the end is 0, the start of a document is 1, words follow
        local = np.zeros(n, np.int64)
        local[~is_end] = index + 2
        before = np.concatenate(([1], local[:-1]))
        before[np.concatenate(([True], is_end[:-1]))] = 1
        hashes = np.concatenate((np.array([END_KEY, START_KEY]), hashes))
        couples, place = np.unique(before * len(hashes) + local, return_inverse=True)
        pairs = hashes[couples // len(hashes)] * _MIX + hashes[couples % len(hashes)]
        # the lowest bit tells pairs from words; pairs are told apart by 56 bits
        pairs = (((pairs ^ (pairs >> np.uint64(29))) * _MIX) & ~np.uint64(255)) | np.uint64(1)
        every = np.concatenate((hashes & ~np.uint64(1), pairs))
        self.keys, at = np.unique(every, return_inverse=True)
        self.word, self.pair = at[local], at[len(hashes) :][place]
        self.fold = np.repeat(folds, sizes + 1)

    def counts(self, part: np.ndarray) -> np.ndarray:
        return np.bincount(np.concatenate((self.word[part], self.pair[part])), minlength=len(self.keys)).astype(np.int32)


def _cut(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.Array, list[np.ndarray]]]:
    """Slices of a batch: a number (equal for equal slices), the ids, and what a Slice is made of."""
    for part in pieces(batch, SLICE_BYTES):
        sizes, index, words = word_lists(part["text"])
        hashes = np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)
        arrays = [sizes.astype(np.int64), part["fold"].to_numpy(zero_copy_only=False).astype(np.int8), index, hashes]
        digest = xxhash.xxh64(repr(part["id"].to_pylist()).encode())
        for a in arrays:
            digest.update(np.ascontiguousarray(a).tobytes())
        yield digest.intdigest() >> 1, part["id"], arrays


def _ask(rows: DataFrame, ranges: int) -> DataFrame:
    """range, slice, keys and the slice's own counts: in training, and in the part for the weights."""
    edges = (np.arange(1, ranges, dtype=np.uint64) * np.uint64(((1 << 64) - 1) // ranges)).astype(np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, _, arrays in _cut(batch):
                piece = Slice(*arrays)
                total, part = piece.counts(piece.fold != OUTSIDE), piece.counts(piece.fold == LEARN_WEIGHTS)
                cuts = np.concatenate(([0], np.searchsorted(piece.keys, edges), [len(piece.keys)]))
                found = [(r, slice(cuts[r], cuts[r + 1])) for r in range(ranges) if cuts[r] < cuts[r + 1]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r for r, _ in found], pa.int32()),
                        pa.array([number] * len(found), pa.int64()),
                        pa.array([pack(np.diff(piece.keys[s], prepend=np.uint64(0))) for _, s in found], pa.binary()),
                        pa.array([pack(total[s]) for _, s in found], pa.binary()),
                        pa.array([pack(part[s]) for _, s in found], pa.binary()),
                    ],
                    ["range", "slice", "keys", "total", "part"],
                )

    return rows.mapInArrow(run, "range int, slice long, keys binary, total binary, part binary")


def _sum_range(group: pa.Table) -> pa.Table:
    """The corpus counts of each slice's keys of one range, in the order of the keys.

    Slice -1 holds the distinct words and the tokens seen in training, and those of the part for the
    weights. Slices that are read twice are counted twice and answered once.
    """
    keys = [np.cumsum(unpack(b, np.uint64), dtype=np.uint64) for b in group["keys"].to_pylist()]
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    sums = []
    for name in ("total", "part"):
        own = np.concatenate([unpack(b, np.int32) for b in group[name].to_pylist()])
        sums.append(np.bincount(place, own, len(distinct)).astype(np.int64))
    total, part = sums
    is_word = (distinct & np.uint64(1)) == 0
    facts = np.array([(total[is_word] > 0).sum(), total[is_word].sum(), part[is_word].sum()], np.int64)
    numbers, at, answers = group["slice"].to_pylist(), 0, {}
    for number, own in zip(numbers, keys, strict=True):
        answers[number] = place[at : at + len(own)]
        at += len(own)
    r = group["range"][0].as_py()
    return pa.table(
        {
            "slice": pa.array([*answers, -1], pa.int64()),
            "range": pa.array([r] * (len(answers) + 1), pa.int32()),
            "total": pa.array([*[pack(total[h]) for h in answers.values()], facts.tobytes()], pa.binary()),
            "part": pa.array([*[pack(part[h]) for h in answers.values()], b""], pa.binary()),
        }
    )


#: Arrays of one slice, packed: for each token the corpus counts of its word and pair, and of both in
#: the part for the weights (0 for tokens of other documents).
PACKED = ("word", "pair", "word_part", "pair_part")


def _own_rows(rows: DataFrame) -> DataFrame:
    """slice, ids and the packed arrays that a Slice is made of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, ids, arrays in _cut(batch):
                columns = [pa.array([number], pa.int64()), pa.array([ids.to_pylist()], pa.list_(ids.type))]
                columns += [pa.array([pack(a)], pa.binary()) for a in arrays]
                yield pa.RecordBatch.from_arrays(columns, ["slice", "ids", "sizes", "folds", "index", "hashes"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"slice long, ids array<{kind}>, sizes binary, folds binary, index binary, hashes binary")


def _gather(own: pa.Table, found: pa.Table) -> pa.Table:
    answers = {r["range"]: r for r in found.to_pylist()} if not own.num_rows or found.num_rows else {}
    schema = {"slice": pa.int64(), "ids": own.schema.field("ids").type, "folds": pa.binary(), "ends": pa.binary()}
    schema |= {n: pa.binary() for n in PACKED}
    if own.num_rows and not answers:
        raise RuntimeError("the documents were not read in the same order twice; write them to a table first")
    if not own.num_rows:
        rows = found.to_pylist()
        if rows[0]["slice"] != -1:
            raise RuntimeError("the documents were not read in the same order twice; write them to a table first")
        facts = np.sum([np.frombuffer(r["total"], np.int64) for r in rows], axis=0)
        columns = {"slice": [-1], "ids": [None], "folds": [facts.tobytes()], "ends": [None]} | {n: [None] for n in PACKED}
        return pa.table({n: pa.array(columns[n], t) for n, t in schema.items()})
    counts = [np.concatenate([unpack(answers[r][c], np.int64) for r in sorted(answers)]) for c in ("total", "part")]
    out = []
    for row in own.to_pylist():
        kinds = {"sizes": np.int64, "folds": np.int8, "index": np.int32, "hashes": np.uint64}
        piece = Slice(*[unpack(row[n], kind) for n, kind in kinds.items()])
        learn, places = piece.fold == LEARN_WEIGHTS, (piece.word, piece.pair)
        blobs = [pack(counts[0][p]) for p in places] + [pack(np.where(learn, counts[1][p], 0)) for p in places]
        known = {"slice": row["slice"], "ids": row["ids"], "folds": row["folds"], "ends": pack(piece.ends)}
        out.append(known | dict(zip(PACKED, blobs, strict=True)))
    return pa.table({n: pa.array([r[n] for r in out], t) for n, t in schema.items()})


class _Counted:
    """A slice's tokens with their corpus counts."""

    def __init__(self, row: dict) -> None:
        self.folds, self.ends = unpack(row["folds"], np.int8), unpack(row["ends"], np.int64)
        self.starts = self.ends - np.diff(self.ends, prepend=0)
        self.word, self.pair, self.word_part, self.pair_part = (unpack(row[n], np.int64) for n in PACKED)

    def context(self, counts: np.ndarray, end: int) -> np.ndarray:
        """Of each token, how often the token before it was seen; the start as often as the end."""
        before = np.concatenate(([end], counts[:-1]))
        before[self.starts] = end
        return before


def _bucket(context: np.ndarray) -> np.ndarray:
    return np.minimum(BUCKETS - 1, np.log2(np.maximum(context, 0.5)) + 1).astype(np.int64)


def _share(a: np.ndarray, b: np.ndarray | float) -> np.ndarray:
    return np.divide(a, b, out=np.zeros(len(a)), where=np.broadcast_to(np.asarray(b) > 0, a.shape))


def _binned(p: np.ndarray) -> np.ndarray:
    return np.where(p > 0, np.round(STEPS * np.log2(np.maximum(p, 1e-300))), NEVER).astype(np.int64)


def learn_weights(cells: list[tuple[int, int, int, int]], n_words: int) -> np.ndarray:
    """Weights of pair, word and uniform estimates for each bucket, by EM over the grid's counts.

    A bucket without counts takes those of the next lower one that has some.
    """
    weights = np.zeros((BUCKETS, 3))
    last = np.array([0.0, 0.9, 0.1]) if cells else np.array([0.0, 0.0, 1.0])
    grid = np.array(cells, float).reshape(-1, 4)
    for b in range(BUCKETS):
        own = grid[grid[:, 0] == b]
        if len(own):
            p = np.where(own[:, 1:3] == NEVER, 0.0, np.exp2(np.minimum(own[:, 1:3], 0) / STEPS))
            p = np.column_stack((p, np.full(len(own), 1 / (n_words + 1))))
            w = np.full(3, 1 / 3)
            for _ in range(EM_ROUNDS):
                share = p * w
                share *= (own[:, 3] / share.sum(1))[:, None]
                w = share.sum(0) / share.sum()
            # never zero for unseen words
            w = np.maximum(w, 1e-6)
            last = w / w.sum()
        weights[b] = last
    return weights


def interpolated_lm(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    Tokens are the words of the whole text in lower case and one end. Null and empty texts are their
    end alone; repeated rows count and are scored one by one; without any training document the model
    is uniform; an empty table gives none. Other columns are ignored.

    Texts are read twice, to count and to fetch the counts, which saves writing all tokens to disk.
    Both must yield the rows in the same order, as files do; if not, the job fails rather than
    giving wrong counts.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)[doc_id]
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"), fold(F.col(doc_id)).alias("fold"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    counted = _ask(rows, max(LEAST_RANGES, size // BYTES_PER_RANGE)).groupBy("range")
    counted = counted.applyInArrow(_sum_range, "slice long, range int, total binary, part binary")
    schema = f"slice long, ids array<{kind}>, folds binary, ends binary, " + ", ".join(f"{n} binary" for n in PACKED)
    joined = _own_rows(rows).groupBy("slice").cogroup(counted.groupBy("slice")).applyInArrow(_gather, schema)
    joined = materialize(joined, "counted")
    facts = joined.where("slice = -1").select("folds").first()
    n_words, n_tokens, n_part = (int(x) for x in np.frombuffer(bytes(facts[0]), np.int64)) if facts else (0, 0, 0)
    pieces = joined.where("slice >= 0")

    def grid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                piece = _Counted(row)
                learn = np.repeat(piece.folds == LEARN_WEIGHTS, np.diff(piece.ends, prepend=0))
                if not learn.any():
                    continue
                word, pair = piece.word - piece.word_part, piece.pair - piece.pair_part
                last = piece.ends[np.flatnonzero(piece.folds == LEARN_WEIGHTS)[0]] - 1
                context = piece.context(word, word[last])[learn]
                p2, p1 = _binned(_share(pair[learn], context)), _binned(_share(word[learn], float(n_tokens - n_part)))
                found, n = np.unique(np.column_stack((_bucket(context), p2, p1)), axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays([*[pa.array(found[:, i]) for i in range(3)], pa.array(n)], ["b", "p2", "p1", "n"])

    cells = pieces.mapInArrow(grid, "b long, p2 long, p1 long, n long").groupBy("b", "p2", "p1").agg(F.sum("n").alias("n"))
    weights = learn_weights([tuple(r) for r in cells.collect()], n_words)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(batch.to_pylist()):
                piece = _Counted(row)
                context = piece.context(piece.word, piece.word[piece.ends[0] - 1])
                w = weights[_bucket(context)]
                p = w[:, 0] * _share(piece.pair, context) + w[:, 1] * _share(piece.word, float(n_tokens)) + w[:, 2] / (n_words + 1)
                base = np.log10((piece.word + 0.5) / (n_tokens + 0.5 * (n_words + 1)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["ids"][i].values,
                        pa.array(piece.folds == OUTSIDE),
                        pa.array(np.diff(piece.ends, prepend=0)),
                        pa.array(np.add.reduceat((piece.word > 0).astype(np.int64), piece.starts)),
                        pa.array(np.full(len(piece.folds), n_tokens)),
                        pa.array(np.add.reduceat(base, piece.starts)),
                        pa.array(np.add.reduceat(np.log10(p), piece.starts)),
                    ],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return pieces.mapInArrow(score, schema)
