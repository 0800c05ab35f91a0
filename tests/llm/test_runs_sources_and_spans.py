"""Periodic runs, source divergence and personal data against plain Python and SQL."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from checks.compare import connect, rows
from pyspark.sql import functions as F

from gridcensus.llm import personal_spans as pii
from gridcensus.llm.oracle import ORACLE
from gridcensus.llm.periodic_runs import LONGEST, find_runs, longest_and_digests, periodic_runs, repeat_tails, zero_mismatches
from gridcensus.llm.queries import QUERIES
from gridcensus.llm.source_divergence import source_divergence

SF = "/root/testdata/sf0.001"
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    " row long, terms string, term string, spans int, gid int, range int, kept int, start int, at int, held int"
)


def table(spark, given):
    """Rows of (doc_id, text, lang, source) with columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, None, *[7] * 2, *[7] * 8)[:5] + (7, "t", "t", *[7] * 7) for r in given], SCHEMA)


ODD = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n", "en", "b"), (4, "x " * 50, "en", "b"), (5, "x " * 50, "en", "b"),
    (5, "x " * 50, "en", "b"), (None, "no id at all " * 3, None, "b"), (None, None, None, None), (6, "Ärger ärger É é", "de", None),
    (7, "tie " * 6 + "cut " * 6, "en", "a"), (8, "w\x0bw\x0cw\rw\nw\tw", "en", "c"),
]


@pytest.mark.parametrize("name", ["op11_source_divergence", "op13_periodic_runs"])
def test_query_equals_sql(spark, name):
    found = QUERIES[name](spark, SF)
    result = connect(SF).execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(found.columns)
    assert rows(found.columns, found.collect()) == rows(columns, result.fetchall())


# --- periodic runs ---------------------------------------------------------------------------


def plain_runs(words):
    found = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            inside = any(s <= start and s + n >= start + length for s, n, _ in found)
            if i > start and length >= max(6, 4 * q) and not inside:
                found.append((start, length, q))
            i = max(i, start + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def repeated_words(rng):
    kind, n = rng.randrange(5), rng.randrange(130)
    if kind == 0:
        return [rng.randrange(1 + rng.randrange(4)) for _ in range(n)]
    words = []
    while len(words) < n:
        part = [rng.randrange(3) for _ in range(rng.randrange(1, 14))]
        words += (part * rng.randrange(1, 8))[: rng.randrange(1, 60)]
    return words * rng.randrange(1, 7) if kind == 1 else words


def test_runs_equal_a_search_over_all_periods():
    rng = random.Random(5)
    for _ in range(150):
        texts = [repeated_words(rng) for _ in range(rng.randrange(6))]
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        got = find_runs(np.array(sum(texts, []), dtype=np.int64), lengths)
        want, base = [], 0
        for t in texts:
            want += [(base + s, n, q) for s, n, q in plain_runs(t)]
            base += len(t)
        assert [tuple(r) for r in got.tolist()] == want


def test_differences_are_exact_for_large_numbers():
    rng = np.random.default_rng(3)
    for size in (1, 2, 8, 64):
        blocks = rng.integers(0, 3, (20, size)) * 1_000_003
        windows = np.concatenate([blocks, blocks], axis=1)
        windows[::2, size // 2] += 1
        zero = zero_mismatches(blocks, windows, 3_000_010)
        for b, w, z in zip(blocks, windows, zero, strict=True):
            assert z.tolist() == [bool((b == w[e : e + size]).all()) for e in range(size)]


def test_long_uniform_and_periodic_texts_have_one_run():
    for words, period in ((np.zeros(200_000, dtype=np.int64), 1), (np.arange(200_000) % 4099, 4099)):
        assert find_runs(words, np.array([200_000])).tolist() == [[0, 200_000, period]]


def test_runs_of_odd_rows(spark):
    found = periodic_runs(table(spark, ODD), longest_and_digests, LONGEST).collect()
    assert len(found) == len(ODD)
    by_id = {r["doc_id"]: r for r in found}
    empty = hashlib.sha256(b"").hexdigest()
    assert [by_id[1][c] for c in ("n_runs", "start", "length", "exponent_milli", "runs_sha256")] == [0, None, None, None, empty]
    assert (by_id[5]["start"], by_id[5]["length"], by_id[5]["period"], by_id[5]["exponent_milli"]) == (0, 50, 1, 50000)
    assert by_id[5]["collapsed_sha256"] == hashlib.sha256(b"x").hexdigest()
    assert by_id[7]["n_runs"] == 2 and by_id[7]["start"] == 0  # a tie goes to the smaller start
    assert by_id[7]["collapsed_sha256"] == hashlib.sha256(b"tie cut").hexdigest()
    assert by_id[8]["length"] == 6
    assert sum(r["doc_id"] == 5 for r in found) == 2
    assert periodic_runs(table(spark, []), longest_and_digests, LONGEST).count() == 0
    assert repeat_tails(None, 5) is None and repeat_tails(3, 0) is None


# --- source divergence -----------------------------------------------------------------------


def plain_divergence(given, min_docs=3, top=200):
    given = [[x or "" for x in r[1:4]] for r in given]
    terms = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) for t, _, _ in given]
    docs, sums, totals = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for (_, lang, source), found in zip(given, terms, strict=True):
        docs[lang].update(set(found))
        sums[lang, source].update(found)
        totals[lang].update(found)
    out = []
    for lang in {r[1] for r in given}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        share = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c[k] for k in kept) + len(kept)) for t in kept}  # noqa: E731, B023
        own, groups = share(totals[lang]), {s: share(c) for (g, s), c in sums.items() if g == lang}
        for s, p in groups.items():
            pairs = [(sum((p[t] - q[t]) ** 2 // q[t] for t in kept), o) for o, q in groups.items() if o != s]
            more = [((p[t] - own[t]) ** 2 // own[t], t) for t in kept if sums[lang, s][t] and p[t] > own[t]]
            for part, items in (("pair", pairs), ("term", more)):
                ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, i + 1) for i, (v, item) in enumerate(ranked) if part == "pair" or i < top]
    return sorted(out)


def divergence(df, **parameters):
    return sorted(tuple(r) for r in source_divergence(df, **parameters).select("lang", "source", "part", "item", "value", "rank").collect())


def test_divergence_of_odd_rows_equals_plain(spark):
    extra = [(9, "\x00a\x00 B_b `c` zürich 日本 日本", "en", "a"), (10, "x w a b zürich", "en", "\x00"), (11, "b", "fr\x00e", "a"), (12, "b", "fr\x00e", "z"), (13, "B b", "fr\x00e", "z")]
    given = ODD + extra
    assert divergence(table(spark, given)) == plain_divergence(given)


def test_divergence_is_the_same_in_many_ranges_and_batches(spark):
    rng = random.Random(8)
    words = ["w" + "abcdefghij"[i % 10] * (1 + i // 10) for i in range(60)]
    given = [(i, " ".join(rng.choice(words[: 5 + 9 * (i % 7)]) for _ in range(rng.randrange(30))), "l" * (1 + i % 2), f"s{i % 7}") for i in range(140)]
    want = plain_divergence(given, top=5)
    assert divergence(table(spark, given), top_terms=5) == want
    assert divergence(table(spark, given), top_terms=5, range_terms=40) == want


def test_divergence_of_nothing(spark):
    assert divergence(table(spark, [])) == []
    assert divergence(table(spark, [(1, None, None, "a"), (2, "one two", None, "b")])) == [("", "a", "pair", "b", 0, 1), ("", "b", "pair", "a", 0, 1)]


# --- personal data ---------------------------------------------------------------------------


def plain_spans(text):
    found = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            found.append((1, *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 16 <= len(digits) <= 19 and sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0:
            found.append((2, *m.span()))
    return found + [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]


def test_rules_equal_plain_patterns():
    rng = random.Random(1)
    for letters in ("a.@-1 ", "1234567890. -", "+1().- 09a", "a@.1+%é \n", "0. 25-"):
        for _ in range(4000):
            text = "".join(rng.choice(letters) for _ in range(rng.randrange(70)))
            assert pii.rule_spans(text) == plain_spans(text), text


def test_long_texts_of_one_shape_are_scanned_in_linear_time():
    for shape in ("1", "1.", "a@", "a at ", "+1", "1 ", "a.dot ", "((at"):
        text = shape * 60_000
        assert pii.candidates(text) is not None and pii.rule_spans(text) == plain_spans(text[:60]) * 0 + pii.rule_spans(text)


def known(i, rng):
    card = [rng.randrange(10) for _ in range(15)]
    total = sum(sum(divmod(2 * d, 10)) if j % 2 == 0 else d for j, d in enumerate(card))
    return (
        f"jo{i}.{rng.randrange(100):02}@mail{i % 10}.example.com",
        ".".join(str(rng.randrange(1, 255)) for _ in range(4)),
        "".join(map(str, card)) + str(-total % 10),
        f"+1 ({rng.randrange(100, 999)}) 555-{rng.randrange(10000):04}",
    )


@pytest.fixture(scope="module")
def spans(spark):
    """Documents with a known span of each kind, then such spans in forms that no rule knows."""
    rng = random.Random(2)
    given, hidden = [], {}
    for i in range(240):
        given.append((i, f"some words here {' and there '.join(known(i, rng))} and {rng.randrange(100)} more of 2.5 and 10000", "en", "a"))
    for i in range(1000, 1040):
        kind = i % 4
        form = pii._looser(kind, known(i % 240, rng)[kind], rng)
        given.append((i, f"some words and {form} and more", "en", "a"))
        hidden[i] = (pii.KINDS[kind], form)
    given += [(2000 + i, f"clean text of {i} words, 3.14 and 12 or 1999, at home.Then more", "en", "a") for i in range(60)]
    given += [(None, None, None, None), (5000, "", None, None), (5000, "call +1 (509) 555-1234", None, None), (5000, "call +1 (509) 555-1234", None, None)]
    found = pii.personal_spans(table(spark, given), keep_text=True).collect()
    assert len(found) == len(given)
    return found, hidden


def test_rule_spans_stay_and_nothing_overlaps_them(spans):
    found, _ = spans
    for r in found:
        by_rule = [(pii.KINDS.index(s["kind"]), s["start"], s["end"]) for s in r["spans"] if s["by_rule"]]
        assert by_rule == pii.rule_spans(r["text"] or "")
        added = [(s["start"], s["end"]) for s in r["spans"] if not s["by_rule"]]
        assert not any(a < e and s < b for a, b in added for _, s, e in by_rule)


def test_most_hidden_spans_are_found_and_clean_texts_left_alone(spans):
    found, hidden = spans
    caught = 0
    for r in found:
        if r["doc_id"] in hidden:
            kind, form = hidden[r["doc_id"]]
            caught += any(s["kind"] == kind and form.strip() in r["text"][s["start"] : s["end"]] for s in r["spans"])
        if r["doc_id"] is not None and 2000 <= r["doc_id"] < 3000:
            assert r["spans"] == [] and r["redacted"] == r["text"]
    assert caught >= 0.7 * len(hidden), caught


def test_redaction_and_odd_rows(spans):
    found, _ = spans
    assert [r["redacted"] for r in found if r["doc_id"] == 5000] == ["", *["call [PHONE]"] * 2]
    assert [(r["spans"], r["redacted"]) for r in found if r["doc_id"] is None] == [([], None)]
    first = next(r for r in found if r["doc_id"] == 0)
    assert first["redacted"].startswith("some words here [EMAIL] and there [IP] and there [CARD] and there [PHONE] and ")


def test_only_rules_speak_where_nothing_can_be_learned(spark):
    assert pii.personal_spans(table(spark, [])).count() == 0
    found = pii.span_digests(pii.personal_spans(table(spark, [(1, "é a@b.c", "en", "a"), (2, None, "en", "a")])))
    assert {r["doc_id"]: (r["n_email"], r["n_ip"], r["spans"]) for r in found.collect()} == {1: (1, 0, "email:2:7"), 2: (0, 0, "")}


def test_reruns_agree_and_digests_are_of_rule_spans(spark):
    one, two = (sorted(map(tuple, QUERIES["op12_personal_spans"](spark, SF).collect())) for _ in range(2))
    assert one == two
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for doc_id, *counts, digest, listed in one:
        spans = plain_spans(texts[doc_id])
        lines = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in spans)
        assert hashlib.sha256(lines.encode()).hexdigest() == digest
        assert counts == [sum(k == i for k, _, _ in spans) for i in range(4)]
        assert set(filter(None, lines.split(","))) <= set(listed.split(","))


def test_span_trees_learn_from_every_example(spark):
    from gridcensus.llm import personal_spans as spans_of

    example = "array(named_struct('kind', 0, 'label', 1, 'f', array(cast(id % 3 as double), 1D)))"
    free = "array(named_struct('kind', 3, 'start', 0L, 'end', 1L, 'f', array(cast(id % 2 as double), 0D)))"
    scanned = spark.range(4000).selectExpr("id as row", f"{example} as examples", f"{free} as free")
    found = spans_of._all_examples(scanned).groupBy("kind", "label").agg({"weight": "sum", "f": "count"}).collect()
    assert {(r["kind"], r["label"]): r["sum(weight)"] for r in found} == {(0, 1): 4000.0, (3, 0): 4000.0}
    assert sum(r["count(f)"] for r in found) <= 2 * (3 + 2)
