"""Streams of text messages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The fields of a price message, in order, for ingest and for scoring.
PRICE_MESSAGE = T.StructType(
    [
        T.StructField("date", T.TimestampType()),
        T.StructField("neighborhood", T.StringType()),
        T.StructField("price", T.IntegerType()),
    ]
)
SCORED_MESSAGE = T.StructType(
    [
        T.StructField("date", T.TimestampType()),
        T.StructField("neighborhood_id", T.StringType()),
        T.StructField("price", T.DoubleType()),
    ]
)


def read_messages(spark: SparkSession, source: str, options: Mapping[str, str]) -> DataFrame:
    """A stream with one text column ``value``, from "kafka", "text" or any source that has it.

    For Kafka pass ``kafka.bootstrap.servers`` and ``subscribe``; ``maxOffsetsPerTrigger``
    bounds a batch and ``minPartitions`` splits busy topic partitions over more tasks.
    """
    return spark.readStream.format(source).options(**options).load().selectExpr("CAST(value AS STRING)")
