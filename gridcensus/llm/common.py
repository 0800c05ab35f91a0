"""Column expressions and helpers that several operators of this subpackage use."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word is a run of characters other than these, in every contract of this subpackage.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it.

    A local session without one gets a temporary folder; any other session must name one.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="gridcensus-shared-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Unlike checkpoint() this computes the rows once. A lost executor costs only its own tasks.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def local_table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A few rows of the driver as a table, parsed from one literal, so that no Python runs for them."""
    parsed = F.from_json(F.lit(json.dumps(rows)), T.ArrayType(T.StructType.fromDDL(schema)))
    return spark.range(1).select(F.inline(parsed))


#: What tasks of one kind keep in their worker for the next of that kind.
KEPT: list[dict] = []


def release_kept() -> None:
    """Give a worker's memory back before a task of another kind that needs much of it."""
    for kept in KEPT:
        kept.clear()


def pieces(batch: pa.RecordBatch, most_bytes: int, texts: pa.Array | None = None) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of so many bytes of text at most, or of one row; every row counts 64 more."""
    texts = batch["text"] if texts is None else texts
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    upto, at = np.cumsum(size + 64), 0
    while at < batch.num_rows:
        base = upto[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(upto, base + most_bytes, side="right")))
        yield batch.slice(at, stop - at)
        at = stop


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def fold(doc_id: Column, parts: int = 5) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts).cast("int")


def unit_hash(*cols: Column, seed: int = 0) -> Column:
    """A seeded hash of the columns as a number from 0 up to 1."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11).cast("double") * F.lit(2.0**-53)


def bind(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body``, which may use it many times per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running_total(
    df: DataFrame, group: str, place: str, ties: list[str], value: Column, buckets: Column, out: str
) -> DataFrame:
    """Add ``out``: the sum of ``value`` over earlier rows of the same group.

    Rows are ordered by ``place`` (0 up to 1) and ``ties``. A group is cut at equal steps of
    ``place`` into ``buckets`` parts; only the parts' sums are ordered as a whole, so a group with a
    third of all rows is spread over as many tasks as it has parts.
    """
    df = df.withColumn("_value", value).withColumn("_part", F.floor(F.col(place) * buckets).cast("long"))
    whole = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        df.groupBy(group, "_part")
        .agg(F.sum("_value").alias("_sum"))
        .select(group, "_part", F.coalesce(F.sum("_sum").over(whole), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy(group, "_part").orderBy(place, *ties).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_value").over(inside), F.lit(0))
    return (
        df.withColumn("_before", before)
        .join(starts, [group, "_part"])
        .withColumn(out, F.col("_start") + F.col("_before"))
        .drop("_value", "_part", "_before", "_start")
    )
