"""How far the sources of a language differ in their words: an exact audit of term shares.

CountVectorizer (minDF, the greatest possible vocabSize) makes sparse vectors of the documents. A term
carries its language, so one model counts document frequencies within each language. Terms are stored
in buckets by hash, and as many buckets as one vocabulary may hold are fitted and read together. Vectors are summed
by (lang, source), and pairs of sources are evaluated on the terms that either of them has.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import CountVectorizer

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcensus.llm.common import materialize, pieces, shared_folder

MIN_DOCS = 3
MOST_TERMS = 2**31 - 1
#: Ranks of terms that are reported.
TOP_TERMS = 200
#: Distinct terms, frequent or not, that the ranges are cut for; a vocabulary is held by the driver
#: and by every executor, and a kept term takes some 200 bytes there.
RANGE_TERMS = 1_500_000
#: Distinct terms are counted in one of so many hash slices.
SLICES = 16
#: Buckets that terms are stored in: the bytes of text in units of this, to the power of 0.6.
BUCKET_BYTES = 350_000_000
STEP_BYTES = 4 << 20
STEP_CELLS = 1 << 20

#: Letters A to Z become small, other ASCII characters than letters become blanks, bytes of other
#: characters stay: splitting at blanks then gives the runs of letters and non-ASCII characters.
LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def _terms(part: pa.RecordBatch) -> Iterator[list[bytes]]:
    for raw in part["text"].cast(pa.binary()).to_pylist():
        yield raw.translate(LETTERS).split()


class _Places(dict):
    """The bucket of each term; ``fresh`` collects, by bucket, what is new to it in one hash slice."""

    def __init__(self, buckets: int) -> None:
        self.buckets, self.fresh = buckets, [[] for _ in range(buckets)]

    def __missing__(self, term: bytes) -> int:
        hashed = zlib.crc32(term)
        self[term] = bucket = hashed % self.buckets
        if hashed // self.buckets % SLICES == 0:
            self.fresh[bucket].append(term)
        return bucket


def _bucketed(buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(gid, bucket, terms joined by blanks) of each document and bucket that it has terms in.

    Every term ends in the number of its language, after a character that no term holds. Rows of bucket
    -1 hold, with a bucket in place of gid, the distinct terms of a hash slice that a task has seen, to
    count distinct terms by.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places: dict[int, _Places] = {}

        def batch_of(gid: list, bucket: list, joined: list) -> pa.RecordBatch:
            terms = pa.array(joined, pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([pa.array(gid, pa.int64()), pa.array(bucket, pa.int32()), terms], ["gid", "bucket", "terms"])

        def seen() -> pa.RecordBatch:
            rows = [(at, b"\0%d" % n, fresh) for n, place in places.items() for at, fresh in enumerate(place.fresh) if fresh]
            places.clear()
            return batch_of([at for at, *_ in rows], [-1] * len(rows), [(tag + b" ").join(fresh) + tag for _, tag, fresh in rows])

        for batch in batches:
            for part in pieces(batch, STEP_BYTES):
                gid, bucket, joined = [], [], []
                for group, number, terms in zip(part["gid"].to_pylist(), part["number"].to_pylist(), _terms(part), strict=True):
                    place = places.get(number)
                    if place is None:
                        place = places[number] = _Places(buckets)
                    tag = b"\0%d" % number
                    of_bucket: list[list[bytes]] = [[] for _ in range(buckets)]
                    for term in terms:
                        of_bucket[place[term]].append(term)
                    for at, some in enumerate(of_bucket):
                        if some:
                            gid.append(group)
                            bucket.append(at)
                            joined.append((tag + b" ").join(some) + tag)
                yield batch_of(gid, bucket, joined)
                if sum(map(len, places.values())) > RANGE_TERMS:
                    yield seen()
        yield seen()

    return split


def _ranges(found: dict[int, int], range_terms: int) -> list[tuple[list[int], int, int]]:
    """(buckets, part, parts): neighbouring buckets while they fit, parts of a bucket that does not."""
    ranges: list[tuple[list[int], int, int]] = []
    held = 0
    for bucket, n in sorted(found.items()):
        parts = -(-n // range_terms)
        if parts > 1:
            ranges += [([bucket], part, parts) for part in range(parts)]
            held = range_terms
        elif ranges and held + n <= range_terms:
            ranges[-1][0].append(bucket)
            held += n
        else:
            ranges.append(([bucket], 0, 1))
            held = n
    return ranges


def _vector_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gid, at, n): the sparse vectors of a batch summed by group and place."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at, n = (batch[k].flatten().to_numpy() for k in ("at", "n"))
        if not len(at):
            continue
        groups, of = np.unique(batch["gid"].to_numpy(), return_inverse=True)
        width = int(at.max()) + 1
        key = np.repeat(of, np.diff(batch["at"].offsets.to_numpy())) * width + at
        order = np.argsort(key)
        key, n = key[order], n[order].astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        arrays = [pa.array(groups[key[first] // width]), pa.array((key[first] % width).astype(np.int32)), pa.array(np.add.reduceat(n, first))]
        yield pa.RecordBatch.from_arrays(arrays, ["gid", "at", "n"])


def _range_sums(stored: DataFrame, buckets: list[int], part: int, parts: int, min_docs: int) -> DataFrame:
    """(number, term, total, sums by group) of the kept terms of one range."""
    spark = stored.sparkSession
    terms = F.split("terms", " ")
    if parts > 1:
        terms = F.filter(terms, lambda t: F.pmod(F.xxhash64(t), F.lit(parts)) == part)
    # a range is one stretch of buckets; a document is a row for each bucket, and a term is in one of them
    docs = stored.where(F.col("bucket").between(buckets[0], buckets[-1])).select("gid", terms.alias("terms"))
    model = CountVectorizer(inputCol="terms", outputCol="vector", minDF=float(min_docs), vocabSize=MOST_TERMS).fit(docs)
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/vocabulary-{uuid.uuid4().hex}"
    model.write().save(path)
    vocabulary = spark.read.parquet(f"{path}/data").select(F.posexplode("vocabulary").alias("at", "tag"))
    vector = F.unwrap_udt("vector")
    sparse = model.transform(docs).select("gid", vector["indices"].alias("at"), vector["values"].alias("n"))
    partial = sparse.mapInArrow(_vector_sums, "gid long, at int, n long")
    sums = partial.groupBy("at", "gid").agg(F.sum("n").alias("n"))
    by_term = sums.groupBy("at").agg(
        F.sum("n").alias("total"), F.collect_list(F.struct("gid", "n")).alias("counts")
    )
    # the vocabulary is a row of an array: spread it over the tasks that hold the sums
    number = F.substring_index("tag", "\0", -1).cast("int")
    return by_term.join(vocabulary, "at").select(
        number.alias("number"), F.substring_index("tag", "\0", 1).alias("term"), "total", "counts"
    )


def term_sums(docs: DataFrame, min_docs: int = MIN_DOCS, range_terms: int = RANGE_TERMS) -> tuple[DataFrame, DataFrame]:
    """The groups (gid, number, lang, source) and, by kept term, (lang, term, total, counts of groups), stored.

    ``number`` numbers the languages. A group's sums come from partial sums of the tasks, spread by term,
    so a hot group is many tasks' work. A term's row has an entry per source that uses it. Groups are
    broadcast: the report holds a row for each pair of sources of a language, so they are far fewer.
    """
    spark = docs.sparkSession
    groups = docs.select("lang", "source").distinct()
    langs = materialize(groups.select("lang").distinct().select("lang", F.monotonically_increasing_id().alias("at")), "langs")
    langs = langs.select("lang", F.row_number().over(Window.orderBy("at")).alias("number"))
    groups = groups.join(F.broadcast(langs), "lang")
    groups = materialize(groups.select(F.monotonically_increasing_id().alias("gid"), "number", "lang", "source"), "groups")
    texts = docs.where("text <> ''").join(F.broadcast(groups), ["lang", "source"]).select("gid", "number", "text")
    # distinct terms grow by a power of about 0.6 of the text, so the buckets do
    n_bytes = texts.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    buckets = max(1, math.ceil((n_bytes / BUCKET_BYTES) ** 0.6))
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/terms-{uuid.uuid4().hex}"
    schema = "gid long, bucket int, terms string"
    bucketed = texts.mapInArrow(_bucketed(buckets), schema)
    bucketed.write.partitionBy("bucket").option("compression", "zstd").parquet(path)
    stored = spark.read.schema(schema).parquet(path)
    slices = stored.where("bucket = -1").select("gid", F.explode(F.split("terms", " ")).alias("term")).distinct()
    found = {r["gid"]: SLICES * r["count"] for r in slices.groupBy("gid").count().collect()}
    found = {at: found.get(at, 1) for at in range(buckets)} if n_bytes else {}
    kept = [
        materialize(_range_sums(stored, *one, min_docs), "term-sums") for one in _ranges(found, range_terms)
    ]
    none = spark.range(0).selectExpr("int(id) number", "'' term", "id total", "array(struct(id as gid, id as n)) counts")
    sums = reduce(DataFrame.unionByName, kept) if kept else none
    return groups, sums.join(F.broadcast(langs), "number").drop("number")


def _share(count: Column, held: Column, kept: Column) -> Column:
    """1 + floor(10^9 (count + 1) / (held + kept)), by long division in three steps so that no product overflows."""
    whole = held + kept
    rest, quotient = count + 1, F.lit(0).cast("long")
    for factor in (1, 1000, 1000, 1000):
        rest = rest * factor
        quotient = quotient * factor + F.call_function("div", rest, whole)
        rest = rest % whole
    return quotient + 1


def _shares(count: np.ndarray, whole: np.ndarray) -> np.ndarray:
    rest, quotient = count + 1, np.int64(0)
    for factor in (1, 1000, 1000, 1000):
        rest = rest * factor
        quotient = quotient * factor + rest // whole
        rest = rest % whole
    return quotient + 1


def _distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _pair_sums(sizes: dict) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(a, b, value, n_terms) summed over the terms that a or b has; ``sizes``: lang to (gids, N + V of each).

    Work grows with the entries of the terms times the sources of their language.
    """

    def evaluate(gids: np.ndarray, whole: np.ndarray, term: np.ndarray, group: np.ndarray, n: np.ndarray):
        sources = len(gids)
        none = _shares(np.zeros(sources, dtype=np.int64), whole)
        value = np.zeros((sources, sources), dtype=np.int64)
        terms = np.zeros((sources, sources), dtype=np.int64)
        at = 0
        while at < len(term):
            # whole terms, as many as fit a matrix of entries by sources
            stop = min(len(term), at + max(1, STEP_CELLS // sources))
            stop = int(np.searchsorted(term, term[stop - 1], side="right"))
            rows, g = term[at:stop] - term[at], group[at:stop]
            share = np.tile(none, (int(rows[-1]) + 1, 1))
            has = np.zeros(share.shape, dtype=bool)
            share[rows, g] = _shares(n[at:stop], whole[g])
            has[rows, g] = True
            order = np.argsort(g, kind="stable")
            rows, g = rows[order], g[order]
            first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
            own, others = share[rows, g][:, None], share[rows]
            # this source against all, then those without the term against it
            value[g[first]] += np.add.reduceat(_distance(own, others), first)
            terms[g[first]] += np.diff(np.concatenate([first, [len(g)]]))[:, None]
            alone = ~has[rows]
            value[:, g[first]] += np.add.reduceat(np.where(alone, _distance(none[None, :], own), 0), first).T
            terms[:, g[first]] += np.add.reduceat(alone.astype(np.int64), first).T
            at = stop
        return value, terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = batch["counts"]
            term = np.repeat(np.arange(batch.num_rows), np.diff(counts.offsets.to_numpy()))
            entries = counts.flatten()
            gid, n = (entries.field(k).to_numpy() for k in (0, 1))
            langs = batch["lang"].dictionary_encode()
            for i, lang in enumerate(langs.dictionary.to_pylist()):
                gids, whole = sizes[lang]
                own = np.flatnonzero(langs.indices.to_numpy()[term] == i)
                value, terms = evaluate(gids, whole, term[own], np.searchsorted(gids, gid[own]), n[own])
                a, b = np.nonzero(terms)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gids[a]), pa.array(gids[b]), pa.array(value[a, b]), pa.array(terms[a, b])],
                    ["a", "b", "value", "n_terms"],
                )

    return run


def source_divergence(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    top_terms: int = TOP_TERMS,
    range_terms: int = RANGE_TERMS,
    lang: str = "lang",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """(lang, source, part, item, value, rank): distances of the sources of a language, and their own terms.

    Part ``pair``: every other source of the language with the summed distance. Part ``term``: the terms
    that the source uses more than its language does, up to ``top_terms``. All arithmetic is on integers
    and exact. Null texts, languages and sources count as ''; a group without terms is compared as well;
    a language without kept terms has distances of 0; repeated rows count as often as they are there;
    texts are read whole whatever their length; other columns are ignored; no rows give no rows.
    """
    columns = {"lang": lang, "source": source, "text": text}
    docs = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(k) for k, c in columns.items()])
    groups, terms = term_sums(docs, min_docs, range_terms)

    by_lang = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("total").alias("lang_held"))
    entries = terms.select("lang", "term", "total", F.inline("counts"))
    held = entries.groupBy("gid").agg(F.sum("n").alias("held"))
    sized = groups.drop("number").join(held, "gid", "left").join(by_lang, "lang", "left").na.fill(0, ["held", "kept", "lang_held"])
    sized = materialize(sized, "groups-sized")

    # a row per group, as in the report's own pairs
    sizes: dict = {}
    for row in sized.orderBy("gid").collect():
        sizes.setdefault(row["lang"], []).append((row["gid"], row["held"] + row["kept"]))
    sizes = {k: tuple(np.array(c, dtype=np.int64) for c in zip(*v, strict=True)) for k, v in sizes.items()}
    sums = terms.select("lang", "counts").mapInArrow(_pair_sums(sizes), "a long, b long, value long, n_terms long")
    sums = sums.groupBy("a", "b").agg(F.sum("value").alias("summed"), F.sum("n_terms").alias("n_terms"))

    def side(name: str) -> DataFrame:
        empty = _share(F.lit(0).cast("long"), F.col("held"), F.col("kept"))
        zero = F.when(F.col("kept") > 0, empty).alias(f"{name}_zero")
        return sized.select("lang", "kept", F.col("gid").alias(name), F.col("source").alias(f"{name}_source"), zero)

    pairs = side("a").join(side("b").drop("kept"), "lang").where("a <> b").join(sums, ["a", "b"], "left")
    neither = F.expr("(kept - coalesce(n_terms, 0)) * ((a_zero - b_zero) * (a_zero - b_zero) div b_zero)")
    value = F.coalesce("summed", F.lit(0)) + F.coalesce(neither, F.lit(0))
    pairs = pairs.select("lang", F.col("a_source").alias("source"), F.lit("pair").alias("part"), F.col("b_source").alias("item"), value.alias("value"))

    group = F.broadcast(sized.drop("lang"))
    shared = entries.join(group, "gid").select(
        "lang", "source", "term",
        _share(F.col("n"), F.col("held"), F.col("kept")).alias("p"),
        _share(F.col("total"), F.col("lang_held"), F.col("kept")).alias("q"),
    )
    owned = shared.where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        F.expr("(p - q) * (p - q) div q").alias("value"),
    )
    ranked = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(ranked).alias("rank")
    top = owned.select("*", rank).where(F.col("rank") <= top_terms)
    return pairs.select("*", rank).unionByName(top)
