"""Runs of words that repeat with a period, found by block convolution.

At scale B (a power of two) the periods from B to 2B - 1 are looked for. A run of period q holds four
periods at least, so it holds an aligned block of B words that comes again q words later. The sums of
squared differences between a block and every place of the window behind it are one convolution, done
exactly by number-theoretic transforms; a sum of zero is a hit. Hits are extended by comparing words.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame

from gridcensus.llm.common import pieces

#: Primes below 2^31 with a primitive root each, and the power of two below them.
PRIMES = ((2013265921, 31, 27), (469762049, 3, 26), (167772161, 3, 25))
#: Bytes of text, and numbers of one matrix, that a step of a task holds (or one text).
STEP_BYTES = 4 << 20
STEP_CELLS = 1 << 20
#: Least length of a run in words and in periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4


def _roots(size: int, prime: tuple[int, int, int], inverse: bool) -> list[np.ndarray]:
    """Powers of the roots of unity of size, size / 2, ... 2."""
    p, root, _ = prime
    tables = []
    while size > 1:
        w = pow(root, (p - 1) // size, p)
        w = pow(w, p - 2, p) if inverse else w
        powers = np.ones(size // 2, dtype=np.uint64)
        filled = 1
        while filled < len(powers):
            more = min(filled, len(powers) - filled)
            powers[filled : filled + more] = powers[:more] * np.uint64(pow(w, filled, p)) % np.uint64(p)
            filled += more
        tables.append(powers)
        size //= 2
    return tables


def _transform(x: np.ndarray, p: np.uint64, tables: list[np.ndarray]) -> np.ndarray:
    """Of every row; the result stands in bit-reversed order."""
    rows, size = x.shape
    for powers in tables:
        halves = x.reshape(rows, -1, 2, len(powers))
        a, b = halves[:, :, 0], halves[:, :, 1]
        x = np.stack([(a + b) % p, (a + (p - b)) % p * powers % p], axis=2)
    return x.reshape(rows, size)


def _back(x: np.ndarray, p: np.uint64, tables: list[np.ndarray]) -> np.ndarray:
    """The inverse of ``_transform``, given the tables of the inverse roots."""
    rows, size = x.shape
    for powers in reversed(tables):
        halves = x.reshape(rows, -1, 2, len(powers))
        a, b = halves[:, :, 0], halves[:, :, 1] * powers % p
        x = np.stack([(a + b) % p, (a + (p - b)) % p], axis=2)
    return x.reshape(rows, size) * np.uint64(pow(size, int(p) - 2, int(p))) % p


def zero_mismatches(blocks: np.ndarray, windows: np.ndarray, largest: int) -> np.ndarray:
    """For rows of B words and of the 2B words behind them: where the block occurs, B places each.

    Sums of squared differences are known modulo as many primes as their greatest possible value needs,
    so zero means equal words. The primes reach to blocks of 2^24 words, that is texts of 2^26 words.
    """
    rows, size = blocks.shape
    bound, known, zero = size * largest * largest, 1, np.ones((rows, size), dtype=bool)
    for prime in PRIMES:
        p = np.uint64(prime[0])
        if 2 * size > 1 << prime[2]:
            raise ValueError("a text is too long for the transform")
        b, w = blocks.astype(np.uint64) % p, windows.astype(np.uint64) % p
        padded = np.concatenate([b[:, ::-1], np.zeros_like(b)], axis=1)
        there = _roots(2 * size, prime, inverse=False)
        product = _transform(padded, p, there) * _transform(w, p, there) % p
        cross = _back(product, p, _roots(2 * size, prime, inverse=True))[:, size - 1 : 2 * size - 1]
        upto = np.cumsum(w * w % p, axis=1)
        squares = upto[:, size - 1 : 2 * size - 1].copy()
        squares[:, 1:] -= upto[:, : size - 1]
        squares += (b * b % p).sum(axis=1, keepdims=True)
        zero &= squares % p == cross * np.uint64(2) % p
        known *= prime[0]
        if known > bound:
            break
    return zero


def _equal_words(ids: np.ndarray, at: np.ndarray, period: np.ndarray, stop: np.ndarray, step: int) -> np.ndarray:
    """How many places from ``at`` on (``step`` apart, before ``stop``) hold the word a period later."""
    found = np.zeros(len(at), dtype=np.int64)
    left = np.arange(len(at))
    width = 8
    while len(left):
        again = []
        for some in np.array_split(left, max(1, -(-len(left) * width // STEP_CELLS))):
            first = at[some] + step * found[some]
            room = np.minimum(step * (stop[some] - first), width)
            place = first[:, None] + step * np.arange(width)
            inside = np.arange(width) < room[:, None]
            place = np.where(inside, place, 0)
            same = inside & (ids[place] == ids[np.where(inside, place + period[some][:, None], 0)])
            run = np.where(same.all(axis=1), width, same.argmin(axis=1))
            found[some] += run
            again.append(some[run == width])
        left = np.concatenate(again)
        width = min(2 * width, STEP_CELLS)
    return found


def find_runs(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Runs (start, length, period) of texts laid end to end as numbers of words, by start and period.

    Places count from the first word of the first text. Equal words of one text have equal numbers.
    """
    ends = np.cumsum(lengths)
    begins = ends - lengths
    total = len(ids)
    found = [np.empty((0, 3), dtype=np.int64)]
    text_of = np.repeat(np.arange(len(lengths)), lengths)
    order = np.lexsort((np.arange(total), ids, text_of)) if total else np.empty(0, dtype=np.int64)
    ahead = np.full(total, total + 1, dtype=np.int64)
    same = (ids[order[1:]] == ids[order[:-1]]) & (text_of[order[1:]] == text_of[order[:-1]])
    ahead[order[:-1][same]] = np.diff(order)[same]
    largest = int(ids.max()) + 1 if total else 0

    size = 1
    while True:
        texts = np.flatnonzero(lengths >= max(LEAST_WORDS, LEAST_PERIODS * size))
        if not len(texts):
            break
        # blocks of the texts that are long enough, where every word comes again within two blocks
        far = np.concatenate([[0], np.cumsum(ahead >= 2 * size)])
        per_text = lengths[texts] // size - 1
        nth = np.arange(per_text.sum()) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        start = np.repeat(begins[texts], per_text) + nth * size
        stop = np.repeat(ends[texts], per_text)
        repeated = far[start + size] == far[start]
        start, stop = start[repeated], stop[repeated]
        # what lies in a run of a smaller period has no smallest period of this scale
        runs = np.concatenate(found)
        reach = np.zeros(total + 1, dtype=np.int64)
        np.maximum.at(reach, runs[:, 0], runs[:, 0] + runs[:, 1])
        reach = np.maximum.accumulate(reach)
        open_ = reach[start] < np.minimum(start + 3 * size, stop)
        start, stop = start[open_], stop[open_]

        for some in np.array_split(np.arange(len(start)), -(-len(start) * 2 * size // STEP_CELLS) or 1):
            if not len(some):
                continue
            b, e = start[some], stop[some]
            place = b[:, None] + np.arange(3 * size)
            words = np.where(place < e[:, None], ids[np.minimum(place, total - 1)], largest)
            row, shift = np.nonzero(zero_mismatches(words[:, :size], words[:, size:], largest))
            b, e, period = b[row], e[row], size + shift
            fresh = reach[b] < b + period + size
            b, e, period = b[fresh], e[fresh], period[fresh]
            # only the first block of a run goes on; the one before it would have matched as well
            first = np.maximum(begins[text_of[b]], b - size)
            before = _equal_words(ids, b - 1, period, first - 1, -1)
            least = before < size
            b, e, period, before = b[least], e[least], period[least], before[least]
            after = _equal_words(ids, b + size, period, e - period, 1)
            long = before + size + after + period
            keep = long >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
            found.append(np.stack([b - before, long, period], axis=1)[keep])
        size *= 2
    runs = np.concatenate(found)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


Rearrange = Callable[[object, int], np.ndarray | None]
Outputs = Callable[[list[bytes], np.ndarray], dict]


def _texts_runs(texts: list[list[bytes]]) -> list[np.ndarray]:
    """The runs of each text, given as words; places count from its own first word."""
    numbers: list[int] = []
    for words in texts:
        seen: dict[bytes, int] = {}
        numbers += [seen.setdefault(w, len(seen)) for w in words]
    lengths = np.array([len(w) for w in texts], dtype=np.int64)
    runs = find_runs(np.array(numbers, dtype=np.int64), lengths)
    begins = np.cumsum(lengths) - lengths
    cut = np.searchsorted(runs[:, 0], begins, side="left")
    parts = np.split(runs, cut[1:]) if len(texts) else []
    return [part - [begin, 0, 0] for part, begin in zip(parts, begins, strict=True)]


def periodic_runs(
    docs: DataFrame,
    outputs: Outputs,
    schema: str,
    rearrange: Rearrange | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The runs of every whole text, as ``outputs`` makes columns of ``schema`` from words and runs.

    Runs come as rows (start, length, period) by start and period. ``rearrange`` may give, for an id
    and a number of words, the places whose words stand for the text's words. A null or empty text has
    no words; a null id is handed on as it is; repeated rows give repeated results; other columns are
    ignored. Nothing is shuffled. A step of a task holds four megabytes of text, or one text, so a very
    long text needs memory in proportion to its own length only.
    """
    kind = dict(docs.dtypes)[doc_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, STEP_BYTES):
                # bytes.split() cuts at the six ASCII blanks, which are never part of another character
                texts = [t.split() if t else [] for t in part["text"].cast(pa.binary()).to_pylist()]
                if rearrange is not None:
                    for i, key in enumerate(part["doc_id"].to_pylist()):
                        places = rearrange(key, len(texts[i]))
                        if places is not None:
                            texts[i] = [texts[i][j] for j in places.tolist()]
                made = [outputs(w, r) for w, r in zip(texts, _texts_runs(texts), strict=True)]
                if made:
                    yield pa.RecordBatch.from_arrays(
                        [part["doc_id"], *[pa.array([m[k] for m in made], t) for k, t in zip(made[0], types, strict=True)]],
                        ["doc_id", *made[0]],
                    )

    rows = docs.selectExpr(f"`{doc_id}` as doc_id", f"cast(`{text}` as string) as text")
    types = [_arrow(field.split()[-1]) for field in schema.split(",")]
    return rows.mapInArrow(run, f"doc_id {kind}, {schema}")


def _arrow(kind: str) -> pa.DataType:
    return pa.int64() if kind == "long" else pa.string()


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The text with only the first period of every run left; a word that any run drops is gone."""
    if not len(runs):
        return b" ".join(words)
    steps = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
    np.add.at(steps, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(steps[:-1]) == 0)
    return b" ".join([words[i] for i in kept.tolist()])


def longest_and_digests(words: list[bytes], runs: np.ndarray) -> dict:
    """The longest run (ties: least start, then period) and digests of all runs and of the collapsed text."""
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs.tolist())
    start = length = period = exponent = None
    if len(runs):
        start, length, period = runs[np.argmax(runs[:, 1])].tolist()
        exponent = 1000 * length // period
    return {
        "n_runs": len(runs),
        "start": start,
        "length": length,
        "period": period,
        "exponent_milli": exponent,
        "runs_sha256": hashlib.sha256(lines.encode()).hexdigest(),
        "collapsed_sha256": hashlib.sha256(collapsed(words, runs)).hexdigest(),
    }


LONGEST = (
    "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
)


def repeat_tails(doc_id: int | None, n: int) -> np.ndarray | None:
    """The contract's repeats: a tenth of the ids, by crc32, repeat a part of their text from a word on.

    A null id has no decimal form, so its text stays as it is.
    """
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([np.arange(a), a + np.arange(n - a) % p])
