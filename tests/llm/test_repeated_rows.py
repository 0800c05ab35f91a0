"""Rows that share an id, have none or are exact repeats, and labelled texts of any length."""

import random
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F

from gridcensus.llm import kernel_language as language
from gridcensus.llm import warc_revisits as warc
from gridcensus.llm.flow_mix import flow_mix
from gridcensus.llm.kd_shards import kd_shards
from gridcensus.llm.queries import mixed

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_mix_stage_takes_the_words_of_the_flow_from_rows_without_ids(spark):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randrange(1, 90), "en", "a", 1) for i in range(300)]
    rows += [(None, f"null {i} " * 30, "en", "b", 1) for i in range(60)]
    rows += [(7, f"shared {i} " * rng.randrange(1, 40), "en", "c", 1) for i in range(80)]
    rows += [(None, "same text " * 20, "en", "c", 1)] * 50
    docs = spark.createDataFrame(rows, DOCS)
    mix, _, targets = mixed(docs)
    of_flow, of_stage, largest = Counter(), Counter(), Counter()
    for r in mix.collect():
        of_flow[r.sources[0]] += r.taken
    kept = corpus_pipeline.mix_sources(spark, docs, "").collect()
    for r in kept:
        n = len(r.text.split())
        of_stage[r.source] += n
        largest[r.source] = max(largest[r.source], n)
    for s in "abc":
        assert abs(of_stage[s] - targets[s]) <= largest[s] and abs(of_flow[s] - targets[s]) <= largest[s]
    copies, there = Counter(map(tuple, kept)), Counter(tuple(r) for r in docs.collect())
    assert all(n <= 2 * there[r] for r, n in copies.items())


def test_repeated_rows_are_chosen_one_by_one(spark):
    rows = [(None, "one two three four", ["a"])] * 1000
    mix = flow_mix(spark.createDataFrame(rows, "doc_id long, text string, of array<string>"), lambda held: {"a": held["a"] * 0.25}, F.col("of"))
    assert Counter(r.taken for r in mix.collect()) == {0: 750, 4: 250}


def test_shards_of_repeated_rows_are_even(spark):
    rows = spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 2 == 0, F.format_string("%08d", "id")).otherwise(F.lit("repeated")).alias("text"),
        F.lit("en").alias("lang"), F.lit("s").alias("source"),
    )
    found = kd_shards(rows, shards=8).collect()
    sizes, slots = Counter(r.shard for r in found), defaultdict(list)
    assert len(sizes) == 8 and max(sizes.values()) - min(sizes.values()) <= 4
    for r in found:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_each_record_has_an_id_of_its_own_and_revisits_name_one(spark, tmp_path):
    rows = [(1, "u", "x"), (1, "u", "y"), (None, "u", "p"), (None, "u", "q"), (2, "u", "x"), (3, "v", "z"), (3, "v", "z"), (3, "v", "z"), (4, "v", "z"), (None, None, None), (None, None, None), (0, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(2)
    warc.write_archives(pages, str(tmp_path / "warc"))
    records = warc.read_archives(spark, str(tmp_path / "warc")).collect()
    ids = [r.record_id for r in records]
    assert len(ids) == len(rows) == len(set(ids))
    lines = spark.read.text(str(tmp_path / "warc"), wholetext=True).collect()
    named = [part.split("\r\n")[0] for row in lines for part in row.value.split("WARC-Refers-To: ")[1:]]
    by_id = {r.record_id: r for r in records}
    revisits = [r for r in records if r.record_type == "revisit"]
    assert len(named) == len(revisits) == 6
    assert all(by_id[n].record_type == "response" for n in named)
    assert {(r.page_id, r.refers_to) for r in revisits} == {(1, 2), (3, 4), (None, 0)}


def test_a_language_that_only_long_texts_have_is_learned(spark):
    rng = random.Random(2)
    of = {"en": "the of and to in is that it was for".split(), "de": "der und die das ist nicht ein zu mit sich".split()}
    rows = [(i, " ".join(rng.choice(of["en"]) for _ in range(60)), "en", "s", 1) for i in range(60)]
    rows += [(i, " ".join(rng.choice(of["de"]) for _ in range(20_000)), "de", "s", 1) for i in range(60, 75)]
    docs = spark.createDataFrame(rows, DOCS)
    found = {r.doc_id: r.lang_pred for r in language.kernel_language(docs).collect()}
    assert all(found[i] == lang for i, _, lang, *_ in rows)


def test_rare_languages_keep_places_in_training(spark):
    rows = [(i, "abc def ghi", "en", "s", 1) for i in range(400)] + [(i, "xyz uvw", "xx", "s", 1) for i in range(400, 410)]
    docs = spark.createDataFrame(rows, DOCS)
    chosen = Counter(lang for _, lang in language.training_rows(docs, "doc_id", "text", "lang", 20))
    assert sum(chosen.values()) == 20 and chosen["xx"] >= 5
    grams = np.arange(1, 5000, dtype=np.int64)
    few = language.thinned(grams, 100)
    assert len(few) == 100 and set(few) <= set(grams.tolist())
    assert set(language.thinned(grams[:2500], 100)) >= set(few) & set(grams[:2500].tolist())
