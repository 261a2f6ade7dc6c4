"""The registry of sources: what lands where and which table it feeds."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The fields of a registry document.
REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("format", T.StringType()),
        T.StructField("source_path", T.StringType()),
        T.StructField("dest_path_landing_temp", T.StringType()),
        T.StructField("dest_path_landing", T.StringType()),
        T.StructField("group_regex", T.StringType()),
        T.StructField("dest_table", T.StringType()),
    ]
)

_JSON_SPACE = " \t\r\n"
_BYTE_ORDER_MARK = "\ufeff"


@dataclass(frozen=True)
class Source:
    """What a load needs to know of one registry entry."""

    name: str
    landing_path: str
    table: str


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the registry's JSON files, each of which holds a list, a document, or documents line by line.

    A file that is neither, or a document that is no object, fails the read with the file's name. Files are read whole.
    """
    files = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    lines = F.filter(F.split("value", "\n"), lambda x: F.trim(x, F.lit(_JSON_SPACE)) != "")
    found = F.coalesce(_documents(F.ltrim("value", F.lit(_BYTE_ORDER_MARK))), _documents(F.concat_ws(",", lines)))
    listed = F.coalesce(found, F.raise_error(F.concat(F.lit("no JSON documents: "), "file")).cast("array<variant>"))
    each = files.select("file", F.explode(listed).alias("document"))
    kind = F.schema_of_variant("document")
    flat = F.when(kind.startswith("ARRAY"), F.try_variant_get("document", "$", "array<variant>")).otherwise(F.array("document"))
    documents = each.select("file", F.explode(flat).alias("document"))
    is_object = F.schema_of_variant("document").startswith("OBJECT")
    wrong = F.raise_error(F.concat(F.lit("a registry entry is no object: "), "file"))
    checked = documents.select(F.when(is_object, F.col("document")).otherwise(wrong.cast("variant")).alias("document"))
    return checked.select(*[F.variant_get("document", f"$.{f.name}", "string").alias(f.name) for f in REGISTRY_SCHEMA.fields])


def _documents(text: Column) -> Column:
    """The documents of comma-separated JSON; null if it is malformed. The parser stops after one value, so a last field shows that all was read."""
    whole = F.try_parse_json(F.concat(F.lit('{"documents":['), text, F.lit('],"end":true}')))
    return F.when(F.try_variant_get(whole, "$.end", "boolean"), F.try_variant_get(whole, "$.documents", "array<variant>"))


def select_sources(registry: DataFrame, names: Iterable[str]) -> DataFrame:
    """The registry entries with one of the given names."""
    return registry.where(F.col("name").isin(list(names)))


def sources_of(registry: DataFrame) -> list[Source]:
    """Registry entries as values, ordered by name; the registry is configuration, not data."""
    rows = registry.select("name", "dest_path_landing", "dest_table").orderBy("name")
    return [Source(r.name, r.dest_path_landing, r.dest_table) for r in rows.toLocalIterator()]


def source_named(registry: DataFrame, name: str) -> Source:
    found = sources_of(select_sources(registry, [name]))
    if not found:
        raise KeyError(f"no source named {name!r} in the registry")
    return found[0]
