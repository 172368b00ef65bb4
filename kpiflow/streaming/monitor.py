"""O4 for running jobs: a listener that keeps the progress of streaming queries."""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = (
    "query string, batch_id bigint, trigger_time string, input_rows bigint, input_rows_per_second double, "
    "processed_rows_per_second double, trigger_ms bigint, watermark string, state_rows bigint, dropped_rows bigint"
)


class ProgressLog(StreamingQueryListener):
    """Rows of the last ``keep`` triggers of all queries, and the failures seen."""

    def __init__(self, keep: int = 1000):
        self.rows: deque[tuple] = deque(maxlen=keep)
        self.failures: deque[str] = deque(maxlen=keep)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.rows.append((
            p.name or str(p.id), p.batchId, p.timestamp, p.numInputRows, float(p.inputRowsPerSecond), float(p.processedRowsPerSecond),
            p.durationMs.get("triggerExecution"), p.eventTime.get("watermark"), sum(s.numRowsTotal for s in p.stateOperators),
            sum(s.numRowsDroppedByWatermark for s in p.stateOperators),  # M11 on the running job
        ))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.failures.append(event.exception)

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.rows), SCHEMA)
