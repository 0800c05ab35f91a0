"""One query per operator of this subpackage, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcensus.llm.common import local_table
from gridcensus.llm.flow_mix import flow_mix, water_fill
from gridcensus.llm.hilbert_neighbours import hilbert_neighbours
from gridcensus.llm.host_rules import host_verdicts
from gridcensus.llm.interpolated_lm import interpolated_lm
from gridcensus.llm.kd_shards import kd_shards
from gridcensus.llm.kernel_language import kernel_language
from gridcensus.llm.overlap_join import overlap_join
from gridcensus.llm.passage_quality import passage_quality
from gridcensus.llm.periodic_runs import LONGEST, longest_and_digests, periodic_runs, repeat_tails
from gridcensus.llm.personal_spans import personal_spans, span_digests
from gridcensus.llm.prefix_bpe import DIGESTS, digests, prefix_bpe
from gridcensus.llm.source_divergence import source_divergence
from gridcensus.llm.warc_revisits import round_trip

Query = Callable[[SparkSession, str], DataFrame]

SOURCE_WEIGHTS = (5, 2, 1)
#: Words of the mix as a share of all words.
MIX_SHARE = 1.5
MIX_REPEATS = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def source_targets(held: dict) -> dict:
    """Words wanted of each source: weights 5, 2, 1 by code point (null last), 150 % of all words."""
    names = sorted(held, key=lambda s: (s is None, s or ""))
    sizes = [held[s] for s in names]
    weights = [SOURCE_WEIGHTS[i % len(SOURCE_WEIGHTS)] for i in range(len(names))]
    return dict(zip(names, water_fill(sizes, weights, MIX_SHARE * sum(sizes), [MIX_REPEATS * s for s in sizes]), strict=True))


def mixed(docs: DataFrame) -> tuple[DataFrame, dict, dict]:
    """The mix of a documents table by source, the words each source holds and its target."""
    seen: dict = {}

    def quotas(held: dict) -> dict:
        seen.update(held)
        return source_targets(held)

    mix = flow_mix(docs, quotas, F.array(F.col("source").cast("string")), max_repeats=MIX_REPEATS)
    return mix, seen, source_targets(seen)


def op1_flow_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix, held, targets = mixed(table(spark, sf_dir, "documents"))
    sources = [{"of": s, "source_size": held[s], "target": float(targets[s])} for s in held]
    per_source = local_table(spark, sources, "of string, source_size long, target double")
    source = F.get("sources", F.lit(0))
    joined = mix.join(per_source, source.eqNullSafe(F.col("of")), "left")
    return joined.select("doc_id", "size", "source_size", "target", "taken", source.alias("source"))


def op2_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = kd_shards(table(spark, sf_dir, "documents"), shards=40)
    return shards.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op3_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = host_verdicts(table(spark, sf_dir, "documents"))
    return verdicts.select(
        "row.doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op4_overlap_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap_join(table(spark, sf_dir, "documents"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op5_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_bpe(table(spark, sf_dir, "documents"), tokenizer_path(), digests, DIGESTS)


def op6_passage_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = passage_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("row.doc_id", "held_out", "score", "predicted")


def op7_interpolated_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolated_lm(table(spark, sf_dir, "documents"))


def op8_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = round_trip(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_kernel_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kernel_language(table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


def op12_personal_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_digests(personal_spans(table(spark, sf_dir, "documents")))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(table(spark, sf_dir, "documents"), longest_and_digests, LONGEST, repeat_tails)


QUERIES: dict[str, Query] = {
    "op1_flow_mix": op1_flow_mix,
    "op2_kd_shards": op2_kd_shards,
    "op3_host_rules": op3_host_rules,
    "op4_overlap_join": op4_overlap_join,
    "op5_prefix_bpe": op5_prefix_bpe,
    "op6_passage_quality": op6_passage_quality,
    "op7_interpolated_lm": op7_interpolated_lm,
    "op8_hilbert_neighbours": op8_hilbert_neighbours,
    "op9_warc_revisits": op9_warc_revisits,
    "op10_kernel_language": op10_kernel_language,
    "op11_source_divergence": op11_source_divergence,
    "op12_personal_spans": op12_personal_spans,
    "op13_periodic_runs": op13_periodic_runs,
}
