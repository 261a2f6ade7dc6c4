"""Stream sinks and the life of a query."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import Future

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from placelake.sources.tables import Tables, write_table

Route = Callable[[DataFrame], DataFrame]


def stream_to_table(df: DataFrame, tables: Tables, table: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Append a stream to a table, batch by batch.

    A parquet table keeps each batch in a part named by the query's id, which lives in the
    checkpoint, and the batch number: a repeated batch replaces itself, and a query started on
    a new checkpoint never touches the parts of an older one. A database gets each batch at
    least once.
    """
    return stream_to_routes(df, tables, {table: lambda batch: batch}, checkpoint, available_now)


def stream_to_routes(df: DataFrame, tables: Tables, routes: Mapping[str, Route], checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Append a stream to several tables: each batch is read once and goes, as each route picks, to all tables under one batch number.

    A batch counts as done when its last table is written. One that was cut off between two tables is repeated
    from the checkpoint and replaces what it has written, see :func:`stream_to_table`.
    """
    started: Future[str] = Future()

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        part = {"stream_id": started.result(), "batch_id": batch_id}
        if len(routes) > 1:
            batch.persist(StorageLevel.DISK_ONLY)
        try:
            for table, pick in routes.items():
                write_table(pick(batch), tables, table, "append", part)
        finally:
            if len(routes) > 1:
                batch.unpersist()

    writer = df.writeStream.outputMode("append").foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    query = _triggered(writer, available_now).start()
    started.set_result(query.id)
    return query


def stream_to_console(df: DataFrame, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Print each batch of a stream."""
    writer = df.writeStream.outputMode("append").format("console").option("checkpointLocation", checkpoint)
    return _triggered(writer, available_now).start()


def stream_to_memory(df: DataFrame, name: str, available_now: bool = False) -> StreamingQuery:
    """Keep a stream's rows in the driver under a view name, for looking at small streams."""
    writer = df.writeStream.outputMode("append").format("memory").queryName(name)
    return _triggered(writer, available_now).start()


def run_available(query: StreamingQuery, timeout: float | None = None) -> StreamingQuery:
    """Wait until a query that takes what is there has ended; stop it if ``timeout`` runs out."""
    ended = query.awaitTermination(timeout) if timeout is not None else query.awaitTermination() or True
    if not ended:
        query.stop()
        raise TimeoutError(f"stream did not end within {timeout} seconds")
    return query


def _triggered(writer: DataStreamWriter, available_now: bool) -> DataStreamWriter:
    return writer.trigger(availableNow=True) if available_now else writer
