"""Language identification with a blended-spectrum string kernel.

The kernel of two texts counts the letter n-grams of length 1 to 3 that occur in both, over the root
of the product of how many each has. Landmarks are a bounded choice of labelled texts; Nystrom maps a
text to its kernels with the landmarks times the inverse root of the landmarks' own kernel matrix, and
kernel ridge regression learns one language against the rest on those features.

A text's features are linear in its n-gram presence, so landmarks, inverse root and ridge weights
fold into one matrix (n-grams of the landmarks x languages), which a batch of texts is multiplied with.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridcensus.llm.common import fold, pieces

#: Letters are their code points, 0 stands for everything that is no letter, and an n-gram is one number
#: below 2 ** 63.
LETTERS = 0x110000
FIRST = (0, LETTERS, LETTERS + LETTERS**2)
#: Texts with fewer distinct letters are counted in a scratch array, others by sorting so many letters at a time.
CLASSES = 64
SORT_LETTERS = 1 << 20
#: Labelled rows that the model is fitted on, how many n-grams of one it sees, and how many are landmarks.
TRAIN_ROWS = 2000
TRAIN_GRAMS = 1 << 14
LANDMARKS = 256
RIDGE = 1e-3
STEP_BYTES = 1 << 20
SIZES = (CLASSES, CLASSES**2, CLASSES**3)
GRAMS = sum(SIZES)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)


def letters() -> np.ndarray:
    """The number of each code point: itself if it is a letter, else 0."""
    return np.array([low if unicodedata.category(chr(low))[0] == "L" else 0 for low in range(LETTERS)], np.int32)


def _sorted_grams(codes: np.ndarray) -> np.ndarray:
    found = np.empty(0, np.int64)
    for at in range(0, len(codes), SORT_LETTERS):
        # two more, so that no n-gram is cut
        part = codes[at : at + SORT_LETTERS + 2].astype(np.int64)
        two = part[:-1] * LETTERS + part[1:]
        three = two[:-1] * LETTERS + part[2:]
        found = np.unique(np.concatenate((found, part, two + FIRST[1], three + FIRST[2])))
    return found[found != 0]


def presence(text: str, table: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """The distinct n-grams (of length 1 to 3) of a whole text, sorted; runs of non-letters count as one.

    ``seen`` is a scratch array of ``GRAMS`` places, false before and after.
    """
    codes = table[code_points(text)]
    if not codes.any():
        return np.empty(0, np.int64)
    codes = codes[np.concatenate(([True], (codes[1:] != 0) | (codes[:-1] != 0)))]
    here = np.zeros(int(codes.max()) + 1, bool)
    here[codes] = here[0] = True
    own = np.flatnonzero(here)
    if len(own) > CLASSES:
        return _sorted_grams(codes)
    number = np.zeros(len(here), np.int32)
    number[own] = np.arange(len(own))
    classes = number[codes]
    seen[classes] = True
    two = classes[:-1] * CLASSES + classes[1:]
    seen[two + SIZES[0]] = True
    seen[two[:-1] * CLASSES + classes[2:] + SIZES[0] + SIZES[1]] = True
    seen[0] = False
    found = np.flatnonzero(seen)
    seen[found] = False
    ends = np.searchsorted(found, (SIZES[0], SIZES[0] + SIZES[1]))
    one, two, three = np.split(found, ends)
    two, three = two - SIZES[0], three - SIZES[0] - SIZES[1]
    pairs = own[two // CLASSES] * LETTERS + own[two % CLASSES]
    head = own[three // SIZES[1]] * LETTERS + own[three // CLASSES % CLASSES]
    return np.concatenate((own[one], pairs + FIRST[1], head * LETTERS + own[three % CLASSES] + FIRST[2]))


def _places(known: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Where each n-gram is among the known ones; their number for the others."""
    place = np.searchsorted(known, grams)
    return np.where(known[np.minimum(place, len(known) - 1)] == grams, place, len(known))


class Model:
    """Weights of the ``known`` n-grams (sorted) and one row of zeros for all others."""

    def __init__(self, langs: list[str], table: np.ndarray, known: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> None:
        self.langs, self.table, self.known, self.weights, self.bias = langs, table, known, weights, bias

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text, from one product of the batch's presence with the weights."""
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts))
        seen = np.zeros(GRAMS, bool)
        grams = [presence(t or "", self.table, seen) for t in texts]
        sizes = np.array([len(g) for g in grams])
        out = np.zeros((len(texts), len(self.langs)))
        full = np.flatnonzero(sizes)
        if len(full):
            starts = np.concatenate(([0], np.cumsum(sizes[full])[:-1]))
            # rows of a sparse 0/1 matrix times the weights: sums of the weights' rows
            out[full] = np.add.reduceat(self.weights[_places(self.known, np.concatenate([grams[i] for i in full]))], starts, axis=0)
            out[full] /= np.sqrt(sizes[full])[:, None]
        out += self.bias
        best = out.argmax(1)
        score = np.clip(out[np.arange(len(texts)), best], 0, 1)
        letters = sizes > 0
        return [self.langs[b] if ok else "und" for b, ok in zip(best, letters, strict=True)], np.where(letters, score, 0.0)


def fit(rows: list[tuple[np.ndarray, str]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Fit on rows of (n-grams of a text, language); without any row the model answers ``und``."""
    langs = sorted({lang for _, lang in rows})
    table = letters()
    rows = [(g, lang) for g, lang in rows if len(g)]
    if not rows:
        return Model([], table, np.empty(0, np.int64), np.zeros((0, 0)), np.zeros(0))
    of_lang: dict[str, list[np.ndarray]] = {}
    for g, lang in rows:
        of_lang.setdefault(lang, []).append(g)
    # landmarks in turn from each language, so that rare ones have some
    grams = [gs[i] for i in range(landmarks) for gs in of_lang.values() if i < len(gs)][:landmarks]
    chosen = grams
    # only n-grams of a landmark can be in both texts; landmarks are listed by n-gram
    known, column = np.unique(np.concatenate(grams), return_inverse=True)
    sizes = np.array([len(g) for g in grams])
    owner = np.repeat(np.arange(len(chosen), dtype=np.int32), sizes)[np.argsort(column, kind="stable")]
    held = np.append(np.bincount(column), 0)
    first = np.cumsum(held) - held

    def kernels(own: np.ndarray) -> np.ndarray:
        at = _places(known, own)
        n = held[at]
        place = np.repeat(first[at] - np.cumsum(n) + n, n) + np.arange(n.sum())
        return np.bincount(owner[place], minlength=len(chosen)) / np.sqrt(len(own) * sizes)

    kernel = np.stack([kernels(g) for g, _ in rows])
    values, vectors = np.linalg.eigh(np.stack([kernels(g) for g in chosen]))
    good = values > 1e-6 * values[-1]
    root = vectors[:, good] / np.sqrt(values[good])
    x = kernel @ root
    y = np.array([[lang == one for one in langs] for _, lang in rows], float)
    mean, centre = x.mean(0), y.mean(0)
    a = (x - mean).T @ (x - mean) + ridge * len(x) * np.eye(x.shape[1])
    w = np.linalg.solve(a, (x - mean).T @ (y - centre))
    of_mark = (root @ w) / np.sqrt(sizes)[:, None]
    weights = np.zeros((len(known) + 1, len(langs)), np.float32)
    gram = np.repeat(np.arange(len(known)), held[:-1])
    for i in range(len(langs)):
        weights[:-1, i] = np.bincount(gram, of_mark[owner, i], len(known))
    return Model(langs, table, known, weights, centre - mean @ w)


def thinned(grams: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` of a text's n-grams, sorted: those of the least hash, so texts keep the same ones."""
    if len(grams) <= most:
        return grams
    hashed = grams.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return grams[np.sort(np.argpartition(hashed, most - 1)[:most])]


def training_rows(
    docs: DataFrame, doc_id: str, text: str, lang: str, rows: int, most_grams: int = TRAIN_GRAMS
) -> list[tuple[np.ndarray, str]]:
    """n-grams and language of at most ``rows`` labelled texts outside fold 0, whatever their length.

    Ids are chosen first: languages take turns, each in the order of a hash of the id, so rare languages
    have as many as they can. An id that is repeated takes one place and gives one text. Whole texts are
    read in the tasks; the driver gets ``most_grams`` numbers of each at most.
    """
    usable = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("t"), F.col(lang).cast("string").alias("l"))
    usable = usable.where((fold(F.col("id")) != 0) & F.col("l").isNotNull() & F.col("t").isNotNull())
    hashed = F.xxhash64(F.lit(10), "id")
    turn = F.row_number().over(Window.partitionBy("l").orderBy(hashed, "id")).alias("turn")
    of_id = usable.groupBy("id").agg(F.min("l").alias("l")).select("id", turn).where(F.col("turn") <= rows)
    # at most ``rows`` ids
    chosen = F.broadcast(of_id.orderBy("turn", hashed, "id").limit(rows).select("id"))
    kind = dict(usable.dtypes)["id"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = letters(), np.zeros(GRAMS, bool)
        for batch in batches:
            for part in pieces(batch, STEP_BYTES, batch["t"]):
                grams = [thinned(presence(t, table, seen), most_grams).tolist() for t in part["t"].to_pylist()]
                arrays = [part["id"], part["l"], part["hash"], pa.array(grams, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(arrays, ["id", "l", "hash", "grams"])

    texts = usable.join(chosen, "id").select("id", "l", "t", F.xxhash64("t").alias("hash"))
    found = texts.mapInArrow(read, f"id {kind}, l string, hash long, grams array<long>")
    of_id = found.groupBy("id").agg(F.min(F.struct("l", "hash", "grams")).alias("x")).collect()
    return [(np.array(r["x"]["grams"], np.int64), r["x"]["l"]) for r in sorted(of_id, key=lambda r: r["id"])]


def kernel_language(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", train_rows: int = TRAIN_ROWS
) -> DataFrame:
    """doc_id, held_out (fold 0), lang_pred and score of every row.

    The model is fitted on at most ``train_rows`` rows of any length and broadcast: the distinct n-grams
    of the landmarks, of which each has ``TRAIN_GRAMS`` at most, times the languages. Texts that are null or have no letter get ``und`` and score 0. Repeated rows get
    equal results, an empty table none; other columns are ignored.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(training_rows(docs, doc_id, text, lang, train_rows)))
    kind = dict(docs.dtypes)[doc_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, STEP_BYTES):
                langs, scores = model.value.predict(part["text"].to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["held_out"], pa.array(langs, pa.string()), pa.array(scores)],
                    ["doc_id", "held_out", "lang_pred", "score"],
                )

    rows = docs.select(
        F.col(doc_id).alias("doc_id"), (fold(F.col(doc_id)) == 0).alias("held_out"), F.col(text).cast("string").alias("text")
    )
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
