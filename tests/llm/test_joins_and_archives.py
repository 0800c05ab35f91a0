"""Overlap join, neighbours, archives and the pipeline against plain Python."""

import base64
import hashlib
import random

import numpy as np
import plain
import pytest
from checks.compare import connect
from checks.compare import rows as comparable
from pyspark.sql import functions as F

import corpus_pipeline
import gridcensus.llm.hilbert_neighbours as neighbours
import gridcensus.llm.overlap_join as joins
from gridcensus.llm.components import connected_components
from gridcensus.llm.oracle import ORACLE
from gridcensus.llm.queries import QUERIES
from gridcensus.llm.warc_revisits import round_trip

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    df = QUERIES[name](spark, SF)
    result = connect(SF).execute(ORACLE[name])
    assert comparable(df.columns, df.collect()) == comparable([d[0] for d in result.description], result.fetchall())


def joined(spark, rows, extra=""):
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumns({n: F.lit(1) for n in ("n", "cid", "root", "node", "links")})
    found = joins.overlap_join(table).collect()
    expected = plain.overlap_join(rows)
    assert sorted(map(repr, [(r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in found])) == sorted(
        map(repr, [(i, *e) for (i, _), e in zip(rows, expected, strict=True)])
    )


def planted(rng, n_bases, copies, length=80):
    passage = " ".join(f"p{i}" for i in range(30))
    rows = []
    for b in range(n_bases):
        base = [f"w{rng.randrange(400)}" for _ in range(length)]
        for c in range(copies):
            text = list(base)
            for _ in range(rng.randrange(4)):
                text[rng.randrange(length)] = f"edit{rng.randrange(50)}"
            rows.append((1000 * b + c, " ".join(text) + (" " + passage if b % 2 else "")))
    return rows


def test_overlap_join_finds_every_link(spark):
    rng = random.Random(3)
    rows = planted(rng, 6, 25)
    rows += [(9000, None), (9001, ""), (9002, " \n"), (9003, "a b"), (9004, "A B"), (9005, "a b c d e"), (9006, "a b c d e")]
    rows += [(None, "a b"), rows[0], rows[0], (9007, " ".join(f"long{i}" for i in range(30_000)))]
    rng.shuffle(rows)
    joined(spark, rows)


def test_overlap_join_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(joins, "BLOCK", 4)
    monkeypatch.setattr(joins, "LEAST_RANGES", 3)
    joined(spark, planted(random.Random(5), 3, 40))


def test_overlap_join_with_heavy_shingles(spark, monkeypatch):
    monkeypatch.setattr(joins, "SLICE_BYTES", 3000)
    rng = random.Random(8)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, passage + " " + " ".join(f"u{i}.{j}" for j in range(rng.randrange(20)))) for i in range(300)]
    joined(spark, rows)


def test_overlap_join_of_given_documents_and_of_none(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    joined(spark, rows)
    assert joins.overlap_join(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_divide_skip_equals_counting():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 40))) for _ in range(60)]
    lists = {k: np.array([i for i, s in enumerate(sets) if k in s]) for k in range(60)}
    lists = {k: v for k, v in lists.items() if len(v)}
    for query in sets:
        for least in (1, 3, len(query)):
            expected = {(i, o) for i, s in enumerate(sets) if (o := len(np.intersect1d(query, s))) >= least}
            assert set(joins.divide_skip(query, least, lists, sets)) == expected


def test_components_of_chains_and_stars(spark):
    edges = [(i + 1, i) for i in range(40)] + [(100, 200 + i) for i in range(50)] + [(300, 300)]
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {100: 100} | {200 + i: 100 for i in range(50)} | {300: 300}


def nearest(vectors, query, k):
    x = dict(vectors)
    scored = sorted(((-float(np.dot(np.float64(x[query]), np.float64(v))), i) for i, v in vectors if i != query))
    return [i for _, i in scored[:k]]


def test_neighbours_are_exact_within_a_block_and_handle_odd_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).astype(float).tolist()) for i in range(200)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)]
    odd = [(500, None), (501, [0.0] * 6), (502, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (503, [float("nan")] * 6), (504, [float("inf")] + [1.0] * 5), (None, [1.0] * 6)]
    table = spark.createDataFrame([*rows, *odd, rows[3]], "vec_id long, embedding array<double>")
    table = table.withColumns({n: F.lit(1) for n in ("id", "v", "q", "c", "score", "block")})
    found = neighbours.hilbert_neighbours(table, F.col("vec_id") % 20 == 0, k=20, curves=3)
    lists = {}
    for r in found.orderBy("query_id", "rank").collect():
        lists.setdefault(r.query_id, []).append(r.vec_id)
        assert r["rank"] == len(lists[r.query_id])
    asked = {i for i, _ in rows if i % 20 == 0}
    assert set(lists) == asked
    for q in asked:
        assert lists[q] == nearest(rows, q, 20)
    few = spark.createDataFrame(rows[:5], "vec_id long, embedding array<double>")
    assert neighbours.hilbert_neighbours(few, F.lit(True)).count() == 20
    assert neighbours.hilbert_neighbours(few.where("false"), F.lit(True)).count() == 0


def test_neighbours_recall_through_small_blocks(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 16))
    x = centres[rng.integers(0, 40, 3000)] + 0.3 * rng.normal(size=(3000, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbours.hilbert_neighbours(table, F.col("vec_id") % 100 == 0, k=10, curves=12, block=128).collect()
    hits = 0
    for q in range(0, 3000, 100):
        order = np.lexsort((np.arange(3000), -(x @ x[q])))
        hits += len(set(order[order != q][:10]) & {r.vec_id for r in found if r.query_id == q})
    assert hits >= 0.9 * 300


@pytest.mark.parametrize("lengths", [1.0, 5.0])
def test_neighbours_outside_all_windows_are_found(spark, monkeypatch, lengths):
    monkeypatch.setattr(neighbours, "CHUNK", 100)
    monkeypatch.setattr(neighbours, "ROUND_BYTES", 8 * 24 * 30)
    rng = np.random.default_rng(6)
    x = rng.normal(size=(3000, 24)) * rng.uniform(1, lengths, size=(3000, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    # windows of twelve candidates are fewer than k
    for block, curves in ((4, 1), (64, 2)):
        found = neighbours.hilbert_neighbours(table, F.col("vec_id") % 50 == 0, k=20, curves=curves, block=block)
        lists = {}
        for r in found.orderBy("query_id", "rank").collect():
            lists.setdefault(r.query_id, []).append(r.vec_id)
        assert lists == {q: nearest(rows, q, 20) for q in range(0, 3000, 50)}


def test_hilbert_curve_moves_one_step_at_a_time():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    keys = neighbours.hilbert_key(cells, 3)
    assert sorted(keys) == list(range(512))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_archives_return_every_page(spark):
    rows = [(1, "http://a", "<p>x\r\n\r\ny</p>"), (2, "http://b\r\nInjected: 1", "<p>x\r\n\r\ny</p>"), (3, None, "é漢\x00"), (4, "u", None), (5, "u", "")]
    rows += [(6, "u", "WARC/1.1\r\n\r\n"), (6, "u", "WARC/1.1\r\n\r\n"), (None, "u", "z"), (7, "u", "z"), (8, "v", "l" * 300_000)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({n: F.lit(1) for n in ("digest", "record", "of", "body")})
    for least in (0, 5):
        expected = []
        for page, _, html in rows:
            data = (html or "").encode()
            same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
            original = max(same, default=None)
            revisit = len(data) >= least and original is not None and original != page
            digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
            expected.append((page, len(data), digest, "revisit" if revisit else "response", original if revisit else None, None if revisit else data))
        found = round_trip(table, min_bytes=least).collect()
        names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
        got = [(*[r[n] for n in names], None if r.payload is None else bytes(r.payload)) for r in found]
        assert sorted(map(repr, got)) == sorted(map(repr, expected))
    assert round_trip(table.where("false")).count() == 0


def test_pipeline_stages_do_what_they_say(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    rules, classifier, duplicates, mix, encode = (f for _, f in corpus_pipeline.STAGES)

    rows = docs.collect()
    kept = plain.host_verdicts([(r.text, r.source) for r in rows])
    ruled = rules(spark, docs, SF)
    assert ruled.columns == names
    assert sorted(r.doc_id for r in ruled.collect()) == sorted(r.doc_id for r, ok in zip(rows, kept, strict=True) if ok)

    good = classifier(spark, ruled, SF)
    assert good.columns == names and good.count() <= ruled.count()

    rows = [(r.doc_id, r.text) for r in ruled.collect()]
    again = ruled.unionByName(ruled.limit(5))
    single = duplicates(spark, again, SF)
    expected = {i for (i, _), (_, least, _) in zip(rows, plain.overlap_join(rows), strict=True) if i == least}
    assert single.columns == names
    assert sorted(r.doc_id for r in single.collect()) == sorted(expected)

    mixed = mix(spark, single, SF)
    assert mixed.columns == names
    taken, sizes = {}, {}
    for r in single.collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(plain.words(r.text))
    for r in mixed.collect():
        taken[r.source] = taken.get(r.source, 0) + len(plain.words(r.text))
    for source, target in plain.mix_targets(sizes).items():
        assert taken.get(source, 0) <= 2 * sizes[source]
        assert abs(taken.get(source, 0) - target) <= 4000
    assert encode(spark, mixed, SF).count() == mixed.count()


def test_pipeline_runs_on_odd_and_empty_tables(spark):
    clean = " ".join(f"word{i}" for i in range(90))
    rows = [(1, clean, "en", "a", 1), (1, clean, "en", "a", 1), (None, clean + " x", None, None, None), (2, None, "en", "a", 1), (3, "", "en", None, 0)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    table = table.withColumns({n: F.lit(1) for n in ("size", "row", "host", "taken", "copy")})
    for docs in (table, table.where("false")):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns
            docs = out
        corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()


def test_one_row_of_each_group_stays_without_ids_and_with_repeated_ones(spark):
    one, two, three, four = (" ".join(f"{w}{i}" for i in range(90)) for w in "abcd")
    rows = [(None, one), (None, one + " x"), (None, one + " y")]
    # a group with a known id, its null-id copies, and a group whose least id is repeated
    rows += [(5, two), (None, two + " x"), (None, two)]
    rows += [(7, three), (7, three + " x"), (7, three), (8, three + " y"), (7, four), (9, four)]
    rows += [(None, None), (11, None), (12, "")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.near_duplicates(spark, table, SF).collect()
    groups = sorted((r.text or "-")[:1] for r in kept)
    assert groups == ["-", "-", "-", "a", "b", "c", "d"]
    assert {r.text[:1]: r.doc_id for r in kept if r.text} == {"a": None, "b": 5, "c": 7, "d": 7}
