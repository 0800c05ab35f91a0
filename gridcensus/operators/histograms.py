"""Merging stored distribution sketches (closest-bin merge, Ben-Haim and Tom-Tov 2010)."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sketches of one key that are merged at a time, and bins that a step brings together side by side.
FAN_IN = 8
STEP_BINS = 1 << 17
# Rows of any keys that are held at a time to bring equal keys together.
FOLD_ROWS = 1 << 15


def merge_bins(x: np.ndarray, y: np.ndarray, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``bins`` bins holding the same total count and weighted sum."""
    x, where = np.unique(x, return_inverse=True)
    y = np.bincount(where, weights=y, minlength=len(x))
    while len(x) > bins:
        i = int(np.argmin(np.diff(x)))
        total = y[i] + y[i + 1]
        x[i] = (x[i] * y[i] + x[i + 1] * y[i + 1]) / total
        y[i] = total
        x, y = np.delete(x, i + 1), np.delete(y, i + 1)
    return x, y


def grouped_bins(owner: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins by owner and centre, those of one owner and centre as one."""
    order = np.argsort(x)
    # owners are dense numbers from 0: 16 bits at a time they sort in linear time
    for shift in range(0, max(1, int(owner.max(initial=0)).bit_length()), 16):
        order = order[np.argsort((owner[order] >> shift).astype(np.uint16), kind="stable")]
    owner, x, y = owner[order], x[order], y[order]
    first = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (x[1:] != x[:-1])][: len(x)])
    return owner[first], x[first], np.add.reduceat(y, first) if len(x) else y


def _close_bins(x: np.ndarray, y: np.ndarray, size: np.ndarray, bins: int) -> None:
    """Merges the closest bins of every row until ``bins`` are left, a bin of each row at a time.

    Rows hold ``size`` sorted bins; bins that went into the one before them are left without a y.
    """
    n, width = x.shape
    gap = np.full((n, width), np.inf)
    gap[:, :-1] = x[:, 1:] - x[:, :-1]
    gap[np.arange(width) >= size[:, None] - 1] = np.inf
    # neighbours by their place in all rows, so one number finds a bin; a row's ends have none
    place = np.arange(n * width)
    before, after = place - 1, place + 1
    start = place[::width]
    before[start] = -1
    after[start + size - 1] = -1
    gaps, xs, ys = gap.reshape(-1), x.reshape(-1), y.reshape(-1)
    merges = size - bins
    for step in range(int(merges.max(initial=0))):
        # rows come by falling size, so those still at work are the first ones
        n = int(np.searchsorted(-merges, -step, side="left"))
        i = start[:n] + gap[:n].argmin(axis=1)
        j = after[i]
        xi, yi, xj, yj = xs[i], ys[i], xs[j], ys[j]
        total = yi + yj
        centre = (xi * yi + xj * yj) / total
        xs[i], ys[i], ys[j] = centre, total, np.nan
        k, h = after[j], before[i]
        after[i] = k
        gaps[j] = np.inf
        gaps[i] = np.where(k >= 0, xs[k] - centre, np.inf)
        more, left = k >= 0, h >= 0
        before[k[more]] = i[more]
        gaps[h[left]] = (centre - xs[h])[left]


def merge_many(owner: np.ndarray, x: np.ndarray, y: np.ndarray, bins: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What ``merge_bins`` makes of the bins of each owner, for many owners at once: (owner, x, y)."""
    return merge_grouped(*grouped_bins(owner, x, y), bins)


def merge_grouped(owner: np.ndarray, x: np.ndarray, y: np.ndarray, bins: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same of bins that ``grouped_bins`` made, which it changes."""
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]][: len(x)])
    size = np.diff(np.r_[first, len(x)])
    wide = np.flatnonzero(size > bins)
    wide = wide[np.argsort(-size[wide], kind="stable")]
    at = 0
    while at < len(wide):
        some = wide[at : at + max(1, STEP_BINS // int(size[wide[at]]))]
        at += len(some)
        n = size[some]
        column = np.arange(int(n[0]))
        held = column < n[:, None]
        place = np.where(held, first[some][:, None] + column, 0)
        xs, ys = x[place], np.where(held, y[place], 0.0)
        _close_bins(xs, ys, n, bins)
        x[place[held]], y[place[held]] = xs[held], ys[held]
    kept = ~np.isnan(y)
    return owner[kept], x[kept], y[kept]


def merge_in_turn(owner: np.ndarray, sizes: np.ndarray, x: np.ndarray, y: np.ndarray, bins: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merges sketches of ``sizes`` bins, given by ascending ``owner``, some of an owner's at a time."""
    while True:
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]][: len(owner)])
        count = np.diff(np.r_[first, len(owner)])
        nth = (np.arange(len(owner)) - np.repeat(first, count)) // FAN_IN
        opens = np.r_[True, (owner[1:] != owner[:-1]) | (nth[1:] != nth[:-1])][: len(owner)]
        group = np.cumsum(opens) - 1
        of, x, y = merge_many(np.repeat(group, sizes), x, y, bins)
        owner = owner[opens]
        if int(count.max(initial=0)) <= FAN_IN:
            return owner[of], x, y
        sizes = np.bincount(of, minlength=len(owner))


def bins_array(owner: np.ndarray, x: np.ndarray, y: np.ndarray, n: int) -> pa.ListArray:
    """Bins by ascending owner as ``n`` lists of (x, y)."""
    offsets = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(x), pa.array(y)], ["x", "y"]))


def list_sizes(column: pa.ListArray) -> np.ndarray:
    return column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def flat_bins(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Centres and counts of all bins of a column of sketches."""
    flat = column.flatten()
    return tuple(flat.field(k).to_numpy(zero_copy_only=False).astype(float) for k in (0, 1))


def key_codes(batch: pa.RecordBatch, keys: Sequence[str]) -> np.ndarray:
    """A number of each row that equal keys share, from 0 without gaps; null is a key."""
    code, n = np.zeros(batch.num_rows, dtype=np.int64), 1
    for key in keys:
        held = batch[key].dictionary_encode(null_encoding="encode")
        index = held.indices.to_numpy(zero_copy_only=False)
        if n == 1:
            code, n = index, len(held.dictionary)
        else:
            seen, code = np.unique(code.astype(np.int64) * len(held.dictionary) + index, return_inverse=True)
            n = len(seen)
    return code


def fold_runs(keys: Sequence[str], fold: Callable[[pa.RecordBatch, np.ndarray], list[pa.Array]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Merges runs of equal keys in rows sorted by key; besides a batch, the last key's row is all it keeps.

    ``fold`` gets rows and the run of each, and gives the columns besides the keys, a row per run.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: pa.RecordBatch | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if last is not None:
                batch = pa.Table.from_batches([last, batch.cast(last.schema)]).combine_chunks().to_batches()[0]
            code = key_codes(batch, keys)
            opens = np.r_[True, code[1:] != code[:-1]]
            rows = pa.array(np.flatnonzero(opens))
            columns = [*[batch[k].take(rows) for k in keys], *fold(batch, np.cumsum(opens) - 1)]
            folded = pa.RecordBatch.from_arrays(columns, batch.schema.names)
            if folded.num_rows > 1:
                yield folded.slice(0, folded.num_rows - 1)
            last = folded.slice(folded.num_rows - 1)
        if last is not None:
            yield last

    return run


def fold_some(keys: Sequence[str], fold: Callable[[pa.RecordBatch, np.ndarray], list[pa.Array]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Merges equal keys among some rows at a time, which need no order; rows with few equal keys stay as they are.

    Done before rows are sorted, so that fewer of them are; ``fold`` is that of ``fold_runs``.
    """

    def some(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        code = key_codes(batch, keys)
        if 2 * (int(code.max()) + 1) > len(code):
            return batch
        order = np.argsort(code, kind="stable")
        owner, batch = code[order], batch.take(pa.array(order))
        rows = pa.array(np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]))
        folded = pa.RecordBatch.from_arrays([*[batch[k].take(rows) for k in keys], *fold(batch, owner)], batch.schema.names)
        # rows that stay as they are go out beside these
        return folded.cast(batch.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= FOLD_ROWS:
                yield some(held)
                held, n = [], 0
        if held:
            yield some(held)

    return run


def _fold(bins: int) -> Callable[[pa.RecordBatch, np.ndarray], list[pa.Array]]:
    def fold(batch: pa.RecordBatch, owner: np.ndarray) -> list[pa.Array]:
        column = batch.column(1)
        return [bins_array(*merge_in_turn(owner, list_sizes(column), *flat_bins(column), bins), int(owner[-1]) + 1)]

    return fold


def merge_distributions(
    partials: DataFrame, key: str, column: str = "distribution", bins: int = 64
) -> DataFrame:
    """Merge the sketches of each key into one.

    Every task first sorts and merges what it reads, so the shuffle carries one sketch per task and
    key. The final tasks do the same with theirs. Sorting spills; the fold holds one sketch.
    """
    schema = f"`{key}` {partials.schema[key].dataType.simpleString()}, `{column}` array<struct<x double, y double>>"
    bins_of = F.col(column).cast("array<struct<x double, y double>>")
    flat = partials.select(key, bins_of.alias(column))
    merge = fold_runs([key], _fold(bins))
    local = flat.sortWithinPartitions(key).mapInArrow(merge, schema)
    return local.repartition(key).sortWithinPartitions(key).mapInArrow(merge, schema)
