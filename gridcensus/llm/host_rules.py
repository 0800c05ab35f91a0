"""Quality rules by host: document rules, host failure rates and a verdict for each document.

Everything is DataFrame functions. A text is read once; its counts are built from its array of words
inside the row, so no word is ever shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcensus.llm.common import SPACES, bind, materialize, text_or_empty

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Further rules whose failures count against a host.
MAX_SYMBOL_PERCENT = 20
MAX_DUP_LINE_PERCENT = 50
HOST_LIMIT = 0.5


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def _repeat_words(words: Column) -> Column:
    """Words that lie in a 3-word window which the text has twice or more.

    Windows are compared by a 64-bit hash. Equal ones become neighbours by sorting, so a text of n
    words takes n log n steps whatever it repeats. Texts without equal windows skip the sort.
    """
    hashes = F.transform(
        F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)),
    )

    def covered(ordered: Column) -> Column:
        def twin(x: Column, k: Column) -> Column:
            same_before = F.get(ordered, k - 1)["h"] == x["h"]
            same_after = F.get(ordered, k + 1)["h"] == x["h"]
            return F.coalesce(same_before, F.lit(False)) | F.coalesce(same_after, F.lit(False))

        starts = F.sort_array(F.transform(F.filter(ordered, twin), lambda x: x["i"]))
        return bind(
            starts,
            lambda s: F.aggregate(
                F.transform(s, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(s, k + 1) - x, F.lit(3)))),
                F.lit(0),
                lambda total, x: total + x,
            ),
        )

    def count(h: Column) -> Column:
        pairs = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(bind(F.sort_array(pairs), covered))

    return bind(hashes, count)


def text_counts(text: Column) -> Column:
    """A struct of the counts that the rules use: words, their characters, symbols, lines, repeats."""
    text = text_or_empty(text)
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")

    def counts(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            _repeat_words(words).cast("long").alias("n_repeat_words"),
        )

    of_lines = bind(
        lines,
        lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        ),
    )
    symbols = F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long")
    return F.struct(bind(_words(text), counts).alias("w"), of_lines.alias("l"), symbols.alias("n_symbols"))


def document_rules(docs: DataFrame, text: str, host: str, carry: list[str]) -> DataFrame:
    """Counts of each document, ``base_failed`` and ``rule_failed`` (the base or a further rule)."""
    counted = docs.select(
        F.struct(*[F.col(c) for c in carry]).alias("row"),
        F.col(host).cast("string").alias("host"),
        text_counts(F.col(text)).alias("c"),
    )
    flat = counted.select(
        "row",
        "host",
        "c.w.n_words",
        "c.w.word_chars",
        "c.n_symbols",
        "c.l.n_lines",
        "c.l.n_dup_lines",
        "c.w.n_repeat_words",
    )
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    further = (100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("word_chars")) | (
        100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("n_lines")
    )
    return flat.withColumn("base_failed", base).withColumn("rule_failed", base | further)


def host_rates(ruled: DataFrame) -> DataFrame:
    """One row per host: documents, failures and the failure rate shrunk towards all hosts.

    The prior is a beta distribution with the mean and variance of the hosts' raw rates (moments).
    Hosts that do not vary leave a prior worth one document. A null host is a host of its own.
    """
    hosts = ruled.groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("rule_failed").cast("long")).alias("n_failed")
    )
    moments = hosts.agg(
        F.avg(F.col("n_failed") / F.col("n_docs")).alias("m"),
        F.var_pop(F.col("n_failed") / F.col("n_docs")).alias("v"),
    )
    spread = F.when(F.col("v") > 1e-12, F.greatest(F.col("m") * (1 - F.col("m")) / F.col("v") - 1, F.lit(0.0)))
    prior = moments.select(
        (F.col("m") * F.coalesce(spread, F.lit(1.0))).alias("alpha"),
        ((1 - F.col("m")) * F.coalesce(spread, F.lit(1.0))).alias("beta"),
    )
    # one row of sums, so the broadcast has a fixed size
    return hosts.join(F.broadcast(prior), F.lit(True), "left").select(
        "host",
        "n_docs",
        "n_failed",
        ((F.col("n_failed") + F.col("alpha")) / (F.col("n_docs") + F.col("alpha") + F.col("beta"))).alias("host_rate"),
    )


def host_verdicts(
    docs: DataFrame,
    text: str = "text",
    host: str = "source",
    carry: list[str] | None = None,
    host_limit: float = HOST_LIMIT,
) -> DataFrame:
    """``carry`` columns of each document as ``row``, its counts, its host's rate and ``kept``.

    A document is kept unless it fails the base rules or its host's shrunk rate is above
    ``host_limit``. Null and empty texts have no words and fail. Repeated rows are judged alike and
    each counts for its host. Other columns of ``docs`` are ignored, so their names cannot clash.
    The counts are written once to the shared folder; the verdicts of hosts are joined to that
    table, on which a host with a third of all rows is split by adaptive execution.
    """
    ruled = materialize(document_rules(docs, text, host, carry or ["doc_id"]), "rules")
    hosts = materialize(host_rates(ruled), "hosts").withColumnRenamed("host", "of_host")
    joined = ruled.join(hosts, F.col("host").eqNullSafe(F.col("of_host")), "left")
    return joined.withColumn("kept", ~F.col("base_failed") & (F.col("host_rate") <= host_limit)).drop("of_host")


def keep_documents(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    return host_verdicts(docs, carry=docs.columns).where("kept").select("row.*")
