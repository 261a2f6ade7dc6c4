"""The log of processed files, kept as parquet tables next to the claims of running loads.

Every batch is logged into a folder of its own. Once there are many, they are folded into a table of buckets with Bloom
filters, of which a load reads only the buckets that may hold a file it asks for. The folded tables are few: a
fold also takes in those that are not much larger than itself. A commit says which tables and folders are live.

A load first claims its files in numbered chunks, then writes each chunk's data and logs the
chunk's files. A claimed file that is not logged belongs to a load that was cut off. Claims lie in a
folder per source and load, which goes when the load has ended, so that a later load reads
no claims but those of loads that were cut off.
"""

from __future__ import annotations

import time
from datetime import datetime
from functools import reduce
from urllib.parse import quote
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placelake.operators.joins import pending_files
from placelake.sources.buckets import NAMES_PER_BUCKET, Buckets, write_buckets
from placelake.sources.commits import KEEP_SECONDS, CommitConflict, CommitLog

#: Folders of the log that a load reads before it folds them.
FOLD_AFTER = 64

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("file_name", T.StringType()),
        T.StructField("processed_at", T.TimestampType()),
        T.StructField("source_name", T.StringType()),
    ]
)

CLAIM_SCHEMA = T.StructType([T.StructField("file_name", T.StringType()), T.StructField("chunk", T.IntegerType())])
_LOAD_ID = T.StructField("load_id", T.StringType())


def ledger_rows(spark: SparkSession, path: str) -> DataFrame:
    """All log entries; none if nothing was logged yet."""
    _, live = _log(spark, path).latest()
    return reduce(DataFrame.unionByName, [t.rows(spark, LEDGER_SCHEMA) for t in _tables(live)], _recent(spark, path, live))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The distinct names of all processed files, whatever their source."""
    return ledger_rows(spark, path).select("file_name").distinct()


def unlogged(files: DataFrame, path: str) -> DataFrame:
    """The rows whose ``file_name`` is not logged, read from those buckets of the log that may hold some of them.

    The names are gone through once per folded table and once more, so give a frame that is cheap to read again.
    """
    spark = files.sparkSession
    _, live = _log(spark, path).latest()
    parts = [t.rows_for(files, "file_name", LEDGER_SCHEMA) for t in _tables(live)]
    known = reduce(DataFrame.unionByName, parts, _recent(spark, path, live))
    return pending_files(files, known)


def append_ledger(files: DataFrame, path: str, source_name: str, at: datetime) -> None:
    """Log a batch of files under one shared time."""
    files.select(
        F.col("file_name"),
        F.lit(at).cast("timestamp").alias("processed_at"),
        F.lit(source_name).alias("source_name"),
    ).write.parquet(f"{path}/processed/{uuid4().hex}")


def fold_ledger(spark: SparkSession, path: str, at_least: int = FOLD_AFTER, names_per_bucket: int = NAMES_PER_BUCKET,
                keep_seconds: float = KEEP_SECONDS) -> int:
    """Fold the log's finished folders into a table of buckets if there are ``at_least`` so many; returns how many it folded.

    Tables of at most twice the rows are taken in as well, so an entry is written again only a logarithmic number
    of times. What is replaced stays for ``keep_seconds``, for loads that began before. Of two folds at once, one is
    given up and leaves the log as it was.
    """
    log = _log(spark, path)
    number, live = log.latest()
    taken = [name for name in _unfolded(spark, path, live) if _finished(spark, f"{path}/processed/{name}")]
    if len(taken) < max(1, at_least):
        return 0
    rows = spark.read.schema(LEDGER_SCHEMA).parquet(*[f"{path}/processed/{name}" for name in taken])
    kept, merged, n = sorted(_tables(live), key=lambda t: -t.names), [], rows.count()
    while kept and kept[-1].names <= 2 * n:
        merged.append(kept.pop())
        n += merged[-1].names
    rows = reduce(DataFrame.unionByName, [t.rows(spark, LEDGER_SCHEMA) for t in merged], rows)
    target = f"{path}/folded/{uuid4().hex}"
    made = write_buckets(rows.where("file_name IS NOT NULL").distinct(), "file_name", target, names_per_bucket)
    now, replaced = time.time(), []
    for old, since in live.get("replaced", []):
        if now - since < keep_seconds:
            replaced.append((old, since))
        else:
            _delete(spark, f"{path}/{old}")
    replaced += [(f"processed/{name}", now) for name in taken] + [(f"folded/{t.path.rsplit('/', 1)[1]}", now) for t in merged]
    try:
        log.commit(number + 1, {"tables": [t.entry() for t in [*kept, made]], "replaced": replaced})
    except CommitConflict:
        _delete(spark, target)
        return 0
    log.prune()
    return len(taken)


def claim_files(files: DataFrame, path: str, source_name: str, load_id: str, chunks: int) -> None:
    """Record which files a load is about to process, spread over its chunks by file name."""
    files.select(
        F.col("file_name"), F.pmod(F.xxhash64("file_name"), F.lit(chunks)).cast("int").alias("chunk")
    ).write.mode("overwrite").parquet(_claims(path, source_name, load_id))


def open_chunks(spark: SparkSession, path: str, source_name: str) -> list[tuple[str, int]]:
    """Chunks with a claimed file that is not logged yet."""
    claimed = _table(spark, _claims(path, source_name), T.StructType([*CLAIM_SCHEMA.fields, _LOAD_ID]))
    rows = unlogged(claimed, path).select("load_id", "chunk").distinct()
    return sorted((r.load_id, r.chunk) for r in rows.toLocalIterator())


def chunk_files(spark: SparkSession, path: str, source_name: str, load_id: str, chunk: int) -> DataFrame:
    claimed = _table(spark, _claims(path, source_name, load_id), CLAIM_SCHEMA)
    return claimed.where(F.col("chunk") == chunk).select("file_name").distinct()


def end_load(spark: SparkSession, path: str, source_name: str, load_id: str) -> None:
    """Drop the claims of a load all of whose files are logged."""
    _delete(spark, _claims(path, source_name, load_id))


def lease_path(path: str, source_name: str) -> str:
    """Where the lease of a source's load lies."""
    return f"{path}/leases/source_name={quote(source_name, safe='')}"


def _claims(path: str, source_name: str, load_id: str | None = None) -> str:
    source = f"{path}/claimed/source_name={quote(source_name, safe='')}"
    return source if load_id is None else f"{source}/load_id={load_id}"


def _table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _log(spark: SparkSession, path: str) -> CommitLog:
    return CommitLog(spark, f"{path}/live")


def _tables(live: dict) -> list[Buckets]:
    return [Buckets(**entry) for entry in live.get("tables", [])]


def _recent(spark: SparkSession, path: str, live: dict) -> DataFrame:
    """The entries that are in no folded table."""
    paths = [f"{path}/processed/{name}" for name in _unfolded(spark, path, live)]
    return spark.read.schema(LEDGER_SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], LEDGER_SCHEMA)


def _unfolded(spark: SparkSession, path: str, live: dict) -> list[str]:
    """Names of the log's folders that no fold has taken in, running ones included."""
    folder, fs = _at(spark, f"{path}/processed")
    if not fs.exists(folder):
        return []
    replaced = {old for old, _ in live.get("replaced", [])}
    names = sorted(status.getPath().getName() for status in fs.listStatus(folder))
    return [n for n in names if n[0] not in "_." and f"processed/{n}" not in replaced]


def _finished(spark: SparkSession, folder: str) -> bool:
    file, fs = _at(spark, f"{folder}/_SUCCESS")
    return fs.exists(file)


def _delete(spark: SparkSession, folder: str) -> None:
    found, fs = _at(spark, folder)
    fs.delete(found, True)


def _at(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())
