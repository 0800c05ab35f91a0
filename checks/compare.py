"""Runs queries in Spark and their SQL in DuckDB and compares the rows.

    python -m checks.compare [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {name} as select * from '{path}'")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(record[i]) for i in order) for record in records)


def compare(spark: SparkSession, con, sf_dir: str, name: str) -> str | None:
    """None where both sides agree, otherwise what differs."""
    df = QUERIES[name](spark, sf_dir)
    ours = rows(df.columns, df.collect())
    result = con.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(columns)}"
    theirs = rows(columns, result.fetchall())
    if ours == theirs:
        return None
    a, b = set(ours) - set(theirs), set(theirs) - set(ours)
    return f"{len(ours)} and {len(theirs)} rows; only Spark {list(a)[:2]}, only SQL {list(b)[:2]}"


def main() -> None:
    sf_dir = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = []
    for name in sys.argv[1:] or QUERIES:
        start = time.time()
        try:
            if name in ORACLE:
                problem = compare(spark, con, sf_dir, name)
            else:
                problem = None
                print(name, QUERIES[name](spark, sf_dir).count(), "rows, no SQL")
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'FAIL' if problem else 'ok':4} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
        if problem:
            failed.append(name)
    print("failed:", failed)
    spark.stop()
    sys.exit(bool(failed))


if __name__ == "__main__":
    main()
