"""Compare registered queries with their SQL run by another engine."""

from __future__ import annotations

import duckdb
from pyspark.sql import SparkSession

import __spark_entry__ as entry_point

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


# Column types of the SQL engine and what they are called in Spark.
SPARK_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "FLOAT": "float", "VARCHAR": "string",
               "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz"}


def in_name_order(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def difference(spark: SparkSession, name: str, sf_dir: str) -> str | None:
    """What differs between the query and its SQL; None if nothing does."""
    got = entry_point.queries()[name](spark, sf_dir)
    want = connect(sf_dir).execute(entry_point.oracle_sql()[name])
    got_types = sorted(got.dtypes)
    want_types = sorted((c[0], SPARK_TYPES.get(str(c[1]), str(c[1]))) for c in want.description)
    if got_types != want_types:
        return f"columns {got_types} against {want_types}"
    a = in_name_order(got.columns, [tuple(r) for r in got.collect()])
    b = in_name_order([c[0] for c in want.description], want.fetchall())
    if len(a) != len(b):
        return f"{len(a)} rows against {len(b)}"
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None
