"""Arrays of a slice of documents: their words as numbers, and arrays packed into bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def pack(a: np.ndarray) -> bytes:
    """An array, compressed byte plane by byte plane: planes of small numbers' high bytes take no room."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpack(b: bytes, kind: type) -> np.ndarray:
    planes = pa.decompress(b[8:], int.from_bytes(b[:8], "little"), codec="zstd", asbytes=True)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, -1).T).view(kind).reshape(-1)


def word_lists(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Words per text, an index for each word in turn, and the distinct words, most frequent first."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    flat, parent = lists.flatten(), pc.list_parent_indices(lists)
    full = pc.not_equal(flat, "")
    flat, parent = flat.filter(full), parent.filter(full)
    sizes = np.bincount(parent.to_numpy(zero_copy_only=False), minlength=len(texts))
    coded = flat.dictionary_encode()
    index = coded.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(-np.bincount(index, minlength=len(coded.dictionary)), kind="stable")
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    return sizes, place[index], coded.dictionary.take(pa.array(order)).to_pylist()
