"""Rules, sharding, mixing, encoding, classifiers and language models against plain Python."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import plain
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gridcensus.llm import kernel_language as language
from gridcensus.llm import passage_quality as quality
from gridcensus.llm.flow_mix import flow_mix, route
from gridcensus.llm.host_rules import host_verdicts
from gridcensus.llm.interpolated_lm import interpolated_lm, learn_weights
from gridcensus.llm.kd_shards import kd_shards
from gridcensus.llm.prefix_bpe import DIGESTS, TrieTokenizer, digests, prefix_bpe
from gridcensus.llm.queries import mixed, tokenizer_path

SF = "/root/testdata/sf0.001"
#: Column names that the operators use themselves.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    " size int, row int, n int, cid int, host int, kept int, score int, at int, base int, pattern int, slice int"
)


def odd_rows():
    rng = random.Random(4)
    long_text = " ".join(rng.choice("alpha beta gamma delta eta theta".split()) + str(rng.randrange(3000)) for _ in range(60_000))
    texts = [None, "", " \t\n", "one", "a\nb\na\n\na", "ABC é ß #|# x", "x " * 60, long_text, "tie tie", "tie tie", "\x0b\x0cw\r\nw"]
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 2}" if i % 4 else None, 1) for i, t in enumerate(texts)]
    rows += [rows[-1], (None, "no id", "de", "s0", None), (None, None, None, None, None)]
    return [r + (7,) * 11 for r in rows]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def test_host_rules_equal_plain_rules(spark, odd, none, docs):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for table in (odd, docs):
        rows = host_verdicts(table, carry=["doc_id", "text", "source"]).collect()
        assert len(rows) == table.count()
        verdicts = plain.host_verdicts([(r.row.text, r.row.source) for r in rows])
        for r, kept in zip(rows, verdicts, strict=True):
            counts = plain.base_counts(r.row.text)
            assert [r[n] for n in names] == [counts[n] for n in names], r.row.doc_id
            assert r.kept == kept
    assert host_verdicts(none).count() == 0


def test_a_bad_host_takes_its_clean_documents_along(spark):
    clean = " ".join(f"w{i}" for i in range(60))
    rows = [(i, clean + f" {i}", "good") for i in range(40)] + [(100 + i, "short", "bad") for i in range(40)]
    rows += [(200, clean, "bad"), (201, "short", "good")]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.row.doc_id for r in host_verdicts(table).where("kept").collect()}
    assert kept == set(range(40))


def test_shards_are_even_and_slots_gapless(spark, odd, none, docs):
    rows = kd_shards(docs, shards=5).collect()
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r.shard].append(r)
    largest = max(r["size"] for r in rows)
    mean = sum(r["size"] for r in rows) / 5
    assert sorted(by_shard) == list(range(5))
    for members in by_shard.values():
        assert sorted(r.slot for r in members) == list(range(len(members)))
        assert abs(sum(r["size"] for r in members) - mean) <= 2 * largest
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32) == (len(data) + 16, zlib.crc32(data))
    found = kd_shards(odd, shards=3).collect()
    assert len(found) == odd.count()
    assert kd_shards(none, shards=3).count() == 0
    assert {r.shard for r in kd_shards(docs, target_bytes=100_000).collect()} == set(range(math.ceil(mean * 5 / 100_000)))


def test_one_source_with_most_rows_is_split(spark):
    rows = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.lit("same text").alias("text"),
        F.lit("en").alias("lang"),
        F.when(F.col("id") % 20 == 0, "rare").otherwise("hot").alias("source"),
    )
    sizes = [r["count"] for r in kd_shards(rows, shards=8).groupBy("shard").count().collect()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 3


def test_mix_meets_targets(spark, odd, none, docs):
    for table in (docs, odd):
        mix, held, targets = mixed(table)
        rows = mix.collect()
        assert len(rows) == table.count()
        sizes = Counter()
        for r in table.collect():
            sizes[r.source] += len(plain.words(r.text))
        assert held == dict(sizes)
        expected = plain.mix_targets(dict(sizes))
        taken, largest = Counter(), Counter()
        for r in rows:
            source = r.sources[0]
            taken[source] += r.taken
            largest[source] = max(largest[source], r["size"])
            assert r.taken % max(1, r["size"]) == 0 and r.taken <= 2 * r["size"]
        for s in sizes:
            assert targets[s] == pytest.approx(expected[s])
            assert abs(taken[s] - targets[s]) <= largest[s]
        assert sorted(map(str, rows)) == sorted(map(str, mixed(table)[0].collect()))
    assert mixed(none)[0].count() == 0


def test_flow_routes_overlapping_patterns_at_least_cost():
    patterns = {("a",): 10, ("a", "b"): 10, ("b",): 1}
    flows = route(patterns, {"a": 12, "b": 9}, 2)
    # the shared pattern lends b what it lacks before anything repeats
    assert flows[("a",), "a"] + flows[("a", "b"), "a"] == 12
    assert flows[("b",), "b"] + flows[("a", "b"), "b"] == 9
    assert flows[("b",), "b"] == 1 and sum(f for (p, _), f in flows.items() if p == ("a", "b")) == 10
    # convex costs: a quota beyond all words repeats every pattern before any third copy
    flows = route({("a",): 5, ("a", "b"): 5}, {"a": 18, "b": 0}, 3)
    assert sum(flows.values()) == 18 and all(f <= 10 for f in flows.values())


def test_overlapping_sources_are_charged(spark):
    rows = [(i, "w " * (1 + i % 7), ["a", "b"] if i % 2 else ["a"]) for i in range(400)] + [(900, "w", []), (901, "w", [None])]
    table = spark.createDataFrame(rows, "doc_id long, text string, of array<string>")
    mix = flow_mix(table, lambda held: {"a": held["a"] * 0.5, "b": held["b"] * 0.5}, F.col("of")).collect()
    charged = Counter()
    for r in mix:
        charged[r.charged_to] += r.taken
    total = sum(len(t.split()) for _, t, s in rows if s and s[0])
    b = sum(len(t.split()) for _, t, s in rows if "b" in s)
    assert sum(r.taken for r in mix) == pytest.approx(total * 0.5 + b * 0.5, abs=14)
    assert charged["b"] == pytest.approx(b * 0.5, abs=14)
    assert {r.doc_id: r.taken for r in mix}[900] == 0


def odd_texts():
    rng = random.Random(5)
    texts = ["", "a<|endoftext|>b<|startoftext|>", "it's WE'LL 12½ Ⅷ", "ΑΣ İ ﬁ ß", "漢字かな 🙂 \x00\x1c", "<|endoftext", None]
    texts += ["".join(rng.choice("abé'ΣİÅ \n\t1½<|>漢́") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    return texts + ["".join(rng.choice("etaoinshr") for _ in range(rng.randint(1, 25))) for _ in range(500)]


def test_encoding_equals_the_library(spark, odd, none, docs):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    rows = [(i, t) for i, t in enumerate(odd_texts())]
    for table in (docs.select("doc_id", "text"), spark.createDataFrame(rows, "doc_id long, text string"), odd):
        texts = defaultdict(set)
        for r in table.collect():
            ids = library.encode(r.text or "", add_special_tokens=False).ids
            packed = np.array(ids, "<u4").tobytes()
            decoded = library.decode(ids, skip_special_tokens=False)
            texts[r.doc_id].add((len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
        found = prefix_bpe(table, tokenizer_path(), digests, DIGESTS).collect()
        assert len(found) == table.count()
        for r in found:
            assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) in texts[r.doc_id]
    assert prefix_bpe(none, tokenizer_path(), digests, DIGESTS).count() == 0


def test_trie_starts_afresh_with_equal_results(monkeypatch):
    import gridcensus.llm.prefix_bpe as module

    with open(tokenizer_path(), encoding="utf-8") as f:
        definition = f.read()
    texts = [t or "" for t in odd_texts()]
    whole = TrieTokenizer(definition).encode_decode(texts)
    monkeypatch.setattr(module, "MAX_WORDS", 50)
    small = TrieTokenizer(definition)
    assert [small.encode_decode([t])[0] for t in texts] == whole


def auc(labels, scores):
    order = np.argsort(scores, kind="stable")
    rank = np.empty(len(scores))
    rank[order] = np.arange(1, len(scores) + 1)
    good = np.array(labels) == 1
    return (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())


def test_quality_scores_held_out_documents(spark, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality.passage_quality(docs, labels).select("row.doc_id", "held_out", "score", "predicted")
    rows = rows.join(labels, "doc_id").where("held_out").collect()
    assert all(plain.fold(r.doc_id) == 0 and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert auc([r.quality for r in rows], [r.score for r in rows]) > 0.97
    assert sum(r.predicted == 1 for r in rows if r.quality == 1) >= 0.98 * sum(r.quality == 1 for r in rows)
    found = quality.passage_quality(odd, labels).collect()
    assert len(found) == odd.count() and all(0 <= r.score <= 1 for r in found)
    without = labels.where("false")
    assert {r.score for r in quality.passage_quality(odd, without).collect()} == {0.5}
    assert quality.passage_quality(none, labels).count() == 0


def test_labels_of_absent_documents_take_no_training_place(spark):
    docs = spark.range(1, 40).select(F.col("id").alias("doc_id"), F.concat(F.lit("some text "), F.col("id").cast("string")).alias("text"))
    labels = spark.range(1, 20_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    scores = [r.score for r in quality.passage_quality(docs, labels, train_rows=10).collect()]
    # fitted on ten good documents, not on none
    assert len(scores) == 39 and all(s > 0.9 for s in scores)


def test_attention_gradients_are_right():
    rng = np.random.default_rng(1)
    x, counts, y = rng.normal(size=(12, quality.N_FEATURES)), np.array([1, 4, 7]), np.array([1.0, 0.0, 1.0])
    model = quality.fit(x, counts, y)
    model.p["a"] = rng.normal(size=quality.ATTENTION)

    def loss():
        p = model.forward(x, counts)["y"]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    for name, g in model.gradients(x, counts, y).items():
        at = tuple(0 for _ in model.p[name].shape)
        old = np.array(model.p[name])
        ends = []
        for step in (1e-5, -1e-5):
            model.p[name] = np.array(old)
            model.p[name][at] += step
            ends.append(loss())
        model.p[name] = old
        assert g[at] == pytest.approx((ends[0] - ends[1]) / 2e-5, abs=1e-6)


def test_passage_features_see_every_word():
    x, counts = quality.passage_features(["w " * 129, "", "A!! B!!"])
    assert counts.tolist() == [3, 1, 1] and x.shape == (5, quality.N_FEATURES)
    assert x[2, quality.N_CLASSES + 5] == pytest.approx(math.log(2) / 4)
    assert not x[3].any() and x[0, quality.N_CLASSES] == pytest.approx(63 / 64)


def test_language_of_held_out_documents(spark, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language.kernel_language(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    texts = {r.doc_id: r.text for r in odd.collect() if r.doc_id is not None}
    found = language.kernel_language(odd).collect()
    assert len(found) == odd.count()
    for r in found:
        assert 0 <= r.score <= 1
        if r.doc_id is not None:
            assert (r.lang_pred == "und") == (not any(c.isalpha() for c in texts[r.doc_id] or ""))
    assert language.kernel_language(none).count() == 0


def language_rows(texts):
    table, seen = language.letters(), np.zeros(language.GRAMS, bool)
    return [(language.presence(t, table, seen), lang) for t, lang in texts]


def test_rare_scripts_are_told_apart_beside_a_frequent_one():
    rng = random.Random(12)
    latin = "".join(c for c in map(chr, range(0x61, 0x180)) if c.isalpha() and c == c.lower())[:60]
    scripts = {"en": latin, "ja": "".join(map(chr, range(0x4E00, 0x4F00))), "zh": "".join(map(chr, range(0x5E00, 0x5F00)))}

    def text(lang):
        return "".join(rng.choice(scripts[lang] + " ") for _ in range(6000))

    rows = [(text(lang), lang) for lang, n in (("en", 40), ("ja", 6), ("zh", 6)) for _ in range(n)]
    model = language.fit(language_rows(rows))
    held_out = [lang for lang in scripts for _ in range(10)]
    assert model.predict([text(lang) for lang in held_out])[0] == held_out


def test_ngrams_are_the_same_by_scratch_array_and_by_sorting(monkeypatch):
    table, seen = language.letters(), np.zeros(language.GRAMS, bool)
    for text in ("Ab, c ab1 漢字かな x", "a", "😀 b𠀀", "  ö?! ö"):
        grams = language.presence(text, table, seen)
        codes = [ord(c) if c.isalpha() else 0 for c in text.lower()]
        codes = [c for i, c in enumerate(codes) if c or not i or codes[i - 1]]
        expected = {c for c in codes if c}
        expected |= {language.FIRST[1] + a * language.LETTERS + b for a, b in zip(codes, codes[1:])}
        expected |= {language.FIRST[2] + (a * language.LETTERS + b) * language.LETTERS + c for a, b, c in zip(codes, codes[1:], codes[2:])}
        assert grams.tolist() == sorted(expected) and not seen.any()
        with monkeypatch.context() as patch:
            patch.setattr(language, "CLASSES", 0)
            patch.setattr(language, "SORT_LETTERS", 4)
            assert language.presence(text, table, seen).tolist() == grams.tolist()


def test_a_repeated_id_takes_one_place_in_training(spark):
    ids = spark.range(1, 60).select(F.col("id").alias("doc_id")).where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    hot = ids.orderBy(F.xxhash64(F.lit(10), "doc_id"), "doc_id").first()[0]
    table = ids.unionByName(spark.range(500).select(F.lit(hot).alias("doc_id")))
    table = table.select("doc_id", F.concat(F.lit("text "), F.col("doc_id").cast("string")).alias("text"), F.lit("en").alias("lang"))
    assert len(language.training_rows(table, "doc_id", "text", "lang", 20)) == 20


def test_kernel_scores_equal_the_definition():
    texts = [("the cat and the hat", "x"), ("das ist ein haus", "y"), ("and then the end", "x"), ("ein und zwei", "y")]
    model = language.fit(language_rows(texts), landmarks=3)
    seen = np.zeros(language.GRAMS, bool)
    grams = [set(language.presence(t, model.table, seen).tolist()) for t, _ in texts]

    def kernel(a, b):
        return len(a & b) / math.sqrt(len(a) * len(b))

    marks = [grams[0], grams[1], grams[2]]
    values, vectors = np.linalg.eigh(np.array([[kernel(a, b) for b in marks] for a in marks]))
    root = vectors / np.sqrt(values)
    x = np.array([[kernel(g, m) for m in marks] for g in grams]) @ root
    y = np.array([[lang == one for one in "xy"] for _, lang in texts], float)
    centred = x - x.mean(0)
    w = np.linalg.solve(centred.T @ centred + language.RIDGE * 4 * np.eye(3), centred.T @ (y - y.mean(0)))
    expected = centred @ w + y.mean(0)
    langs, scores = model.predict([t for t, _ in texts])
    assert langs == ["x", "y", "x", "y"]
    assert scores == pytest.approx(np.clip(expected.max(1), 0, 1), abs=1e-5)


def test_language_model_equals_plain_counts(spark, odd, none, docs):
    for table in (docs, odd):
        rows = table.select("doc_id", "text").collect()
        tokens = [(r.doc_id, [*plain.words(plain.lower(r.text)), None]) for r in rows]
        train = [(i, t) for i, t in tokens if plain.fold(i) != 1]
        counts = Counter(w for _, t in train for w in t)
        n, v = sum(counts.values()), len(counts)
        pairs = Counter(p for _, t in train for p in zip(["<", *t], t))
        part = Counter(w for i, t in train if plain.fold(i) == 4 for w in t)
        part_pairs = Counter(p for i, t in train if plain.fold(i) == 4 for p in zip(["<", *t], t))
        starts, part_starts = counts[None], part[None]

        def bucket(c):
            return min(31, int(math.log2(max(c, 0.5)) + 1))

        cells = Counter()
        for i, t in train:
            if plain.fold(i) == 4:
                for a, w in zip(["<", *t], t):
                    context = starts - part_starts if a == "<" else counts[a] - part[a]
                    p2 = (pairs[a, w] - part_pairs[a, w]) / context if context else 0
                    p1 = (counts[w] - part[w]) / (n - sum(part.values()))
                    cells[bucket(context), *(round(4 * math.log2(p)) if p else 9999 for p in (p2, p1))] += 1
        weights = learn_weights([(*k, c) for k, c in sorted(cells.items())], v)
        expected = defaultdict(list)
        for i, t in tokens:
            base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
            score = 0.0
            for a, w in zip(["<", *t], t):
                context = starts if a == "<" else counts[a]
                two, one, rest = weights[bucket(context)]
                score += math.log10(two * (pairs[a, w] / context if context else 0) + one * counts[w] / n + rest / (v + 1))
            expected[i].append((len(t), sum(counts[w] > 0 for w in t), base, score))
        found = interpolated_lm(table).collect()
        assert len(found) == len(rows)
        for r in found:
            assert r.train_tokens == n and r.held_out == (plain.fold(r.doc_id) == 1)
            assert any(
                (r.n_tokens, r.n_known) == e[:2] and r.base_score == pytest.approx(e[2]) and r.score == pytest.approx(e[3], rel=1e-6)
                for e in expected[r.doc_id]
            )
    assert interpolated_lm(none).count() == 0
