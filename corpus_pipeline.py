"""From raw documents to token ids: rules, classifier, near duplicates, mix, encoding.

Every stage takes (spark, docs, sf_dir) and works on all that the one before it kept; all but the last
return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcensus.llm import host_rules, passage_quality
from gridcensus.llm.common import materialize
from gridcensus.llm.overlap_join import overlap_join
from gridcensus.llm.prefix_bpe import DIGESTS, digests, prefix_bpe
from gridcensus.llm.queries import mixed, table, tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose host is not rejected."""
    return host_rules.keep_documents(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels of those that are left, predicts as good."""
    return passage_quality.keep_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component, of the least id and then text hash; whole repeats of it go as well.

    The key of a row is its id with a hash of its text, known ids first, so rows that share an id, or
    have none, are told apart. The join names a component by the least key of its rows.
    """
    # the hash only separates rows of one id; should two agree, both stay
    parts = [F.col("doc_id").isNull().alias("unknown"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash")]
    keyed = docs.select(F.struct(*parts).alias("key"), "text")
    found = overlap_join(keyed, "key").where(F.col("doc_id") == F.col("component_id"))
    kept = found.select(F.col("doc_id.id").alias("_kept_id"), F.col("doc_id.hash").alias("_kept_hash")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_kept_id")) & (F.xxhash64("text") == F.col("_kept_hash"))
    return docs.join(kept, same, "left_semi").dropDuplicates(["doc_id", "text"])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: rows that it takes twice are there twice.

    Rows are numbered once and mixed by number, so rows that share an id or have none are told apart.
    """
    numbered = materialize(docs.withColumn("_number", F.monotonically_increasing_id()), "numbered")
    mix, _, _ = mixed(numbered.drop("doc_id").withColumnRenamed("_number", "doc_id"))
    copies = mix.where("taken > 0").select(F.col("doc_id").alias("_number"), F.expr("int(taken div size)").alias("_copies"))
    taken = numbered.join(copies, "_number")
    each = F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy")
    return taken.select(*docs.columns, each).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every row of the mix."""
    return prefix_bpe(docs, tokenizer_path(), digests, DIGESTS)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

#: The classifier, the join and the encoder are beyond SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
