"""What running queries report, as a table: a row per micro-batch."""

from __future__ import annotations

import json
import threading
from collections import deque
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from millrace.schemas import LONG, STRING, TIMESTAMP, record

PROGRESS = record(query_id=STRING, run_id=STRING, name=STRING, batch_id=LONG, started=TIMESTAMP, trigger_millis=LONG,
                  input_rows=LONG, state_rows=LONG, observed=STRING)
ENDED = record(run_id=STRING, error=STRING)


class ProgressLog(StreamingQueryListener):
    """Listens to a session's queries; the newest ``keep`` micro-batches stay in the driver's memory."""

    def __init__(self, keep: int = 10_000):
        self.batches: deque[tuple] = deque(maxlen=keep)
        self.ended: dict[str, str | None] = {}
        self.change = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        done = event.progress
        observed = {name: row.asDict() for name, row in done.observedMetrics.items()}
        started = datetime.fromisoformat(done.timestamp.replace("Z", "+00:00"))
        with self.change:
            self.batches.append((str(done.id), str(done.runId), done.name, done.batchId, started,
                                 done.durationMs.get("triggerExecution"), done.numInputRows,
                                 sum(state.numRowsTotal for state in done.stateOperators),
                                 json.dumps(observed, default=str) if observed else None))

    def onQueryTerminated(self, event) -> None:
        with self.change:
            self.ended[str(event.runId)] = event.exception
            self.change.notify_all()

    def wait_for(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until all of an ended query's reports are here; they come after it has ended, its end as the last."""
        with self.change:
            if not self.change.wait_for(lambda: str(query.runId) in self.ended, seconds):
                raise TimeoutError(f"no word of the end of query {query.name}")

    def table(self, spark: SparkSession) -> DataFrame:
        with self.change:
            return spark.createDataFrame(list(self.batches), PROGRESS)

    def failures(self, spark: SparkSession) -> DataFrame:
        """Runs that ended with an error."""
        with self.change:
            return spark.createDataFrame([(run, error) for run, error in self.ended.items() if error], ENDED)
