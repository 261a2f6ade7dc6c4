"""The two stream jobs: store price messages, and score them with the price model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from placelake.functions.columns import is_bad, split_message, with_error
from placelake.operators.price_model import PriceModel, predict
from placelake.plans import names
from placelake.sources.tables import Tables
from placelake.streaming.messages import PRICE_MESSAGE, SCORED_MESSAGE
from placelake.streaming.sinks import stream_to_routes, stream_to_table


def ingest_prices(stream: DataFrame, tables: Tables, checkpoint: str, table: str = names.MESSAGES_TABLE,
                  fields: T.StructType = PRICE_MESSAGE, available_now: bool = False, bad_table: str | None = None) -> StreamingQuery:
    """Split messages into typed columns and append them, text included, to a table.

    Messages that lost a part stand there with nulls, or go to ``bad_table`` if one is given.
    """
    rows = split_message(stream, fields)
    if bad_table is None:
        return stream_to_table(rows, tables, table, checkpoint, available_now)
    bad = is_bad(fields)
    routes = {table: lambda batch: batch.where(~bad), bad_table: lambda batch: batch.where(bad)}
    return stream_to_routes(rows, tables, routes, checkpoint, available_now)


def score_stream(stream: DataFrame, model: PriceModel, fields: T.StructType = SCORED_MESSAGE,
                 label: str = "price") -> DataFrame:
    """Message fields with the model's prediction and the error of it.

    Messages whose category is null or was not seen in training are left out.
    """
    scored = predict(model, split_message(stream, fields))
    return with_error(scored.select(*fields.fieldNames(), "prediction"), label)
