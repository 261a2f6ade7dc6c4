"""The corpus pipeline: every stage takes what its predecessor kept of ``documents``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from placelake.llm import decontamination, lsh_forest, packing, quality_rules, suffix_dedup
from placelake.llm.common import Scratch, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without the lines that too many documents of their source share."""
    return quality_rules.keep_good(docs, Scratch(spark, "quality"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, at a similarity of 0.8 on shingles of five words."""
    return lsh_forest.keep_one(docs, Scratch(spark, "near"))


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of long strings that occur earlier."""
    return suffix_dedup.without_repeats(docs, Scratch(spark, "repeats"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences."""
    return packing.pack_documents(docs, Scratch(spark, "pack"), public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality), ("near_duplicates", near_duplicates), ("suffix_dedup", repeats),
    ("decontamination", decontaminate), ("packing", pack),
]
#: Suffix removal, edit distances and tokens are beyond SQL; the tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Each stage is written as Parquet and read again by the next one."""
    scratch, docs = Scratch(spark, "pipeline"), table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return docs
