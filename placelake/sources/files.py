"""Landing files: listing, batch reads, and the newest lookup file."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placelake.sources.schemas import as_schema, schema_groups, widest_schema, with_values

# How Spark names the part files of one write.
_PART = r"/part-\d+-([0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})[^/]*$"


def list_files(spark: SparkSession, path: str, pattern: str | None = None, recursive: bool = False) -> DataFrame:
    """One row per file: ``file_name`` (full URI), ``modified_at``, ``n_bytes``.

    Every file counts but hidden ones, whatever its suffix, unless a pattern is given. The content column is
    never selected, so no file is opened.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select(
        F.col("path").alias("file_name"), F.col("modificationTime").alias("modified_at"), F.col("length").alias("n_bytes")
    )


def read_landing(spark: SparkSession, paths: Iterable[str], schema: T.StructType | None = None, file_column: str | None = None) -> DataFrame:
    """Read many parquet files as one table, keeping columns that only some of them have.

    Files are read by the schema they have and cast to the widest common type of each column, see
    :func:`widest_schema`; types without one are refused with file and column. Passing ``schema`` saves the pass over the
    footers. ``file_column`` adds each row's file.
    """
    groups = [(schema, list(paths))] if schema is not None else schema_groups(spark, list(paths))
    if not groups:
        raise FileNotFoundError("no parquet file in the given paths")
    sensitive = spark.conf.get("spark.sql.caseSensitive", "false") == "true"
    wide = widest_schema([(own, files[0]) for own, files in groups], sensitive) if schema is None else schema
    parts = []
    for own, files in groups:
        rows = spark.read.schema(with_values(own) if len(groups) > 1 else wide).parquet(*files)
        where = [] if file_column is None else [F.col("_metadata.file_path").alias(file_column)]
        if len(groups) == 1:
            parts.append(rows.select("*", *where))
            continue
        target = T.StructType([*wide.fields, *([T.StructField(file_column, T.StringType())] if where else [])])
        parts.append(as_schema(rows.select("*", *where), target))
    return reduce(DataFrame.unionByName, parts)


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Read the newest lookup table of a folder.

    A table is a single file, or the part files of one write, which share an id in their names and
    may lie in the folder or in one below it. The table with the newest change counts, whatever its kind.
    """
    folder = F.regexp_extract("file_name", r"^(.*)/[^/]*$", 1)
    write_id = F.regexp_extract("file_name", _PART, 1)
    single = F.when(write_id == "", F.col("file_name"))
    files = list_files(spark, path, recursive=True).withColumns({"folder": folder, "write_id": write_id, "single": single})
    tables = files.groupBy("folder", "write_id", "single").agg(F.max("modified_at").alias("newest"))
    found = tables.orderBy(F.desc("newest"), F.desc("folder"), F.desc("write_id"), F.desc("single")).first()
    if found is None:
        raise FileNotFoundError(f"no lookup file in {path}")
    return spark.read.parquet(found.single or f"{found.folder}/part-*{found.write_id}*")
