"""What streams did: a row per batch and per end of a query, for tables that outlive the session."""

from __future__ import annotations

import logging

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from placelake.sources.tables import Tables, write_table

_LOG = logging.getLogger(__name__)
HISTORY_SCHEMA = ("stream_id string, run_id string, name string, batch_id long, at string, input_rows long, rows_per_second double, "
                  "batch_ms long, behind string, failure string")


class StreamHistory(StreamingQueryListener):
    """Writes a row per batch with its input rows, duration and the source's newest lag metrics, and one per query that ends.

    A batch's row is a part named by stream and batch number, so a repeated batch replaces its row, and
    :func:`placelake.sources.compaction.compact` folds the parts. Register by ``spark.streams.addListener``. A row that can't
    be written is reported and does not disturb the stream.
    """

    def __init__(self, spark: SparkSession, tables: Tables, table: str = "stream_history"):
        self.spark, self.tables, self.table = spark, tables, table

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.numInputRows == 0:
            return  # an idle trigger, reported under the number of the batch to come
        lags = [str(dict(s.metrics)) for s in p.sources if s.metrics]
        row = (str(p.id), str(p.runId), p.name, p.batchId, p.timestamp, p.numInputRows, p.processedRowsPerSecond, p.batchDuration, ", ".join(lags) or None, None)
        self._write(row, {"stream_id": p.id, "batch_id": p.batchId})

    def onQueryTerminated(self, event) -> None:
        row = (str(event.id), str(event.runId), None, None, None, None, None, None, None, event.exception)
        self._write(row, {"ended": event.runId})

    def _write(self, row: tuple, part: dict[str, object]) -> None:
        try:
            frame = self.spark.createDataFrame([row], HISTORY_SCHEMA).coalesce(1)
            write_table(frame, self.tables, self.table, "append", part)
        except Exception:  # noqa: BLE001 - whatever it is, the stream goes on
            _LOG.exception("could not write the history of stream %s", row[0])
