"""Quality scores by attention-based multiple-instance learning.

A document is a bag of passages of 64 words. Each passage is encoded from surface features through a
hidden layer; gated attention learns from document labels alone how much each passage counts, and the
attention-weighted representation is scored. The network is small, fitted in numpy on a bounded choice
of labelled rows and broadcast; scoring runs inside the tasks that read the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcensus.llm.common import fold, pieces, release_kept

PASSAGE_WORDS = 64
#: Labelled rows, outside the held-out fold, that the network is fitted on.
TRAIN_ROWS = 6000
HIDDEN, ATTENTION = 16, 8
EPOCHS, RATE, DECAY = 400, 0.02, 1e-4
STEP_BYTES = 1 << 20
THRESHOLD = 0.3

#: Byte classes: space, line end, lower, upper, digit, then groups of marks; the last is any other byte.
_GROUPS = [b" \t\x0b\x0c\r", b"\n", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"]
_GROUPS += [b".,", b"!", b"?", b"|", b"#*$%&<>", b";:'\"-()", b"/@_=+~^\\[]{}`"]
N_CLASSES = len(_GROUPS) + 1
CLASS = np.full(256, N_CLASSES - 1, np.uint8)
for _i, _group in enumerate(_GROUPS):
    CLASS[list(_group)] = _i
N_FEATURES = N_CLASSES + 7
_R = np.uint64(0x9E3779B97F4A7C15)
_R_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def passage_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of a batch and the number of passages of each text (1 for empty ones)."""
    parts = [t.encode("utf-8", "replace") + b" " for t in texts]
    data = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.cumsum([len(p) for p in parts])
    kinds = CLASS[data]
    blank = kinds < 2
    starts = np.flatnonzero(~blank & np.concatenate(([True], blank[:-1])))
    stops = np.flatnonzero(blank & np.concatenate(([False], ~blank[:-1])))
    doc = np.searchsorted(ends, starts, side="right")
    words = np.bincount(doc, minlength=len(texts))
    counts = np.maximum(1, -(-words // PASSAGE_WORDS))
    first = np.concatenate(([0], np.cumsum(counts)))
    n = int(first[-1])
    word_first = np.concatenate(([0], np.cumsum(words)))
    passage = first[doc] + (np.arange(len(starts)) - word_first[doc]) // PASSAGE_WORDS

    out = np.zeros((n, N_FEATURES), np.float32)
    if len(starts):
        # a byte belongs to the passage of the last word that began before it
        of_byte = passage[np.maximum(0, np.cumsum(np.bincount(starts, minlength=len(data))) - 1)]
        size = np.bincount(of_byte, minlength=n)
        by_class = np.bincount(of_byte * N_CLASSES + kinds, minlength=n * N_CLASSES).reshape(n, N_CLASSES)
        out[:, :N_CLASSES] = by_class / np.maximum(1, size)[:, None]
        total = np.bincount(passage, minlength=n)
        some = np.maximum(1, total)
        with np.errstate(over="ignore"):
            upto = np.append(np.uint64(0), np.cumsum((data + np.uint64(1)) * _powers(len(data), _R), dtype=np.uint64))
            hashes = (upto[stops] - upto[starts]) * _powers(len(data), _R_BACK)[starts]
        for k, lag in enumerate((1, 2)):
            same = (hashes[lag:] == hashes[:-lag]) & (passage[lag:] == passage[:-lag])
            out[:, N_CLASSES + k] = np.bincount(passage[lag:][same], minlength=n) / some
        order = np.lexsort((hashes, passage))
        new = np.concatenate(([True], (np.diff(hashes[order]) != 0) | (np.diff(passage[order]) != 0)))
        out[:, N_CLASSES + 2] = np.bincount(passage[order][new], minlength=n) / some
        length = stops - starts
        mean = np.bincount(passage, length, n) / some
        out[:, N_CLASSES + 3] = mean / 10
        out[:, N_CLASSES + 4] = np.sqrt(np.maximum(0, np.bincount(passage, length.astype(float) ** 2, n) / some - mean**2)) / 10
        out[:, N_CLASSES + 5] = np.log1p(total) / 4
        out[:, N_CLASSES + 6] = np.bincount(passage, (kinds[starts] == 3), n) / some
    return out, counts


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class AttentionModel:
    """A hidden layer, gated attention over the passages of a bag, and a logistic score of the bag."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, p: dict[str, np.ndarray]) -> None:
        self.mean, self.scale, self.p = mean, scale, p

    def forward(self, x: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        h = np.tanh(x @ p["w"] + p["b"])
        v, u = np.tanh(h @ p["v"]), _sigmoid(h @ p["u"])
        s = (v * u) @ p["a"]
        starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
        bag = np.repeat(np.arange(len(counts)), counts)
        e = np.exp(s - np.maximum.reduceat(s, starts)[bag])
        alpha = e / np.add.reduceat(e, starts)[bag]
        z = np.add.reduceat(alpha[:, None] * h, starts, axis=0)
        y = _sigmoid(z @ p["c"] + p["d"])
        return {"x": x, "h": h, "v": v, "u": u, "alpha": alpha, "z": z, "y": y, "bag": bag, "starts": starts}

    def scores(self, texts: list[str]) -> np.ndarray:
        x, counts = passage_features(texts)
        return self.forward(x, counts)["y"].astype(float)

    def gradients(self, x: np.ndarray, counts: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, f = self.p, self.forward(x, counts)
        h, v, u, alpha, bag = f["h"], f["v"], f["u"], f["alpha"], f["bag"]
        off = (f["y"] - y) / len(y)
        dz = off[:, None] * p["c"]
        d_alpha = (dz[bag] * h).sum(1)
        ds = alpha * (d_alpha - np.add.reduceat(alpha * d_alpha, f["starts"])[bag])
        gate = ds[:, None] * p["a"]
        dv, du = gate * u * (1 - v**2), gate * v * u * (1 - u)
        dh = alpha[:, None] * dz[bag] + dv @ p["v"].T + du @ p["u"].T
        pre = dh * (1 - h**2)
        return {
            "w": f["x"].T @ pre, "b": pre.sum(0), "v": h.T @ dv, "u": h.T @ du,
            "a": (v * u).T @ ds, "c": f["z"].T @ off, "d": off.sum(),
        }


def fit(x: np.ndarray, counts: np.ndarray, y: np.ndarray) -> AttentionModel:
    """Fit by Adam over all bags at once; without any bag every score is 0.5."""
    rng = np.random.default_rng(6)
    start = {
        "w": rng.normal(0, 0.3, (N_FEATURES, HIDDEN)), "b": np.zeros(HIDDEN),
        "v": rng.normal(0, 0.3, (HIDDEN, ATTENTION)), "u": rng.normal(0, 0.3, (HIDDEN, ATTENTION)),
        "a": rng.normal(0, 0.3, ATTENTION), "c": np.zeros(HIDDEN), "d": np.zeros(()),
    }
    if not len(y):
        return AttentionModel(np.zeros(N_FEATURES), np.ones(N_FEATURES), start)
    model = AttentionModel(x.mean(0), np.maximum(x.std(0), 1e-3), start)
    first = {k: np.zeros_like(v) for k, v in start.items()}
    second = {k: np.zeros_like(v) for k, v in start.items()}
    for t in range(1, EPOCHS + 1):
        for k, g in model.gradients(x, counts, y).items():
            g = g + DECAY * model.p[k]
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            step = (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.99**t)) + 1e-8)
            model.p[k] = model.p[k] - RATE * step
    return model


def train(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, rows: int) -> AttentionModel:
    """Fit on at most ``rows`` labelled documents of ``docs`` outside fold 0, chosen by a hash of the id.

    Only their passages' features come to the driver. A document with several labels has the least.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & (fold(F.col(doc_id)) != 0))
    known = known.groupBy(F.col(doc_id).alias("labelled")).agg(F.min(F.col(label)).cast("double").alias("y"))
    # labels of other documents take no place
    present = docs.select(F.col(doc_id).alias("of")).distinct()
    known = known.join(present, F.col("labelled") == F.col("of"), "left_semi")
    chosen = known.orderBy(F.xxhash64(F.lit(6), "labelled"), "labelled").limit(rows)
    texts = docs.select(F.col(doc_id).alias("of"), F.col(text).cast("string").alias("text"))
    # at most ``rows`` rows of two numbers
    texts = texts.join(F.broadcast(chosen), F.col("of") == F.col("labelled"))
    # an id that is repeated gives one text
    texts = texts.groupBy("of").agg(F.min("text").alias("text"), F.min("y").alias("y"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_kept()
        for batch in batches:
            for part in pieces(batch, STEP_BYTES):
                x, counts = passage_features([t or "" for t in part["text"].to_pylist()])
                ends = np.cumsum(counts)
                blobs = [x[a:b].tobytes() for a, b in zip(ends - counts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(blobs, pa.binary()), part["y"], part["of"]], ["x", "y", "of"])

    kind = dict(docs.dtypes)[doc_id]
    found = texts.mapInArrow(features, f"x binary, y double, of {kind}").collect()
    found.sort(key=lambda r: (r["of"], r["x"]))
    bags = [np.frombuffer(bytes(r["x"]), np.float32).reshape(-1, N_FEATURES) for r in found]
    x = np.concatenate(bags).astype(float) if bags else np.zeros((0, N_FEATURES))
    return fit(x, np.array([len(b) for b in bags], int), np.array([r["y"] for r in found]))


def passage_quality(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    carry: list[str] | None = None,
    train_rows: int = TRAIN_ROWS,
) -> DataFrame:
    """``carry`` columns (the id by default) as ``row``, with held_out (fold 0), score and predicted.

    The whole text is scored, whatever its length. Null and empty texts are one empty passage; repeated
    rows get equal scores; without labels every score is 0.5; an empty table gives none.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, doc_id, text, label, train_rows))
    carried = carry or [doc_id]
    # a text that is carried along anyway travels once
    apart = text not in carried
    row = F.struct(*[F.col(c) for c in carried]).alias("row")
    own = [F.col(text).cast("string").alias("text")] if apart else []
    rows = docs.select(row, (fold(F.col(doc_id)) == 0).alias("held_out"), *own)

    def texts(batch: pa.RecordBatch) -> pa.Array:
        return batch["text"] if apart else pc.struct_field(batch["row"], text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_kept()
        for batch in batches:
            for part in pieces(batch, STEP_BYTES, texts(batch)):
                scores = model.value.scores([t or "" for t in texts(part).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part["row"], part["held_out"], pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))],
                    ["row", "held_out", "score", "predicted"],
                )

    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {kind}, held_out boolean, score double, predicted int")


def keep_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents predicted 1, with all their columns."""
    return passage_quality(docs, labels, carry=docs.columns).where("predicted = 1").select("row.*")
