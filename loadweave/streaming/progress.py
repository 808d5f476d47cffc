"""What streams did, in the run log: a listener that writes each micro-batch of the session's named streams."""

from __future__ import annotations

import datetime as dt
import threading

from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from loadweave.operators.quality import RunLog


class ProgressLog(StreamingQueryListener):
    """Add it with ``spark.streams.addListener``.

    A batch is a run of its stream: its number, input rows, start and end, and the rows and bytes of state it left. The
    stream itself is a run, too, from its start to its end, with the error that ended it. Spark tells of these events
    some time after they happened; ``wait`` returns once a query's end is in the log.
    """

    def __init__(self, log: RunLog):
        self.log = log
        self._started: dict[str, tuple[str, dt.datetime]] = {}
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _end_of(self, run_id: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event) -> None:
        run_id, start = str(event.runId), dt.datetime.now()
        self._started[run_id] = event.name or str(event.id), start
        self.log.append({
            "pipeline_name": event.name or str(event.id), "run_id": run_id, "start_time": start, "status": "RUNNING",
            "refresh_action": "STREAM",
        })

    def onQueryProgress(self, event) -> None:
        p = event.progress
        start = dt.datetime.fromisoformat(p.timestamp.replace("Z", "+00:00")).astimezone().replace(tzinfo=None)
        self.log.append({
            "pipeline_name": p.name or str(p.id), "run_id": f"{p.runId}/{p.batchId}", "start_time": start,
            "end_time": start + dt.timedelta(milliseconds=p.batchDuration), "status": "SUCCESS", "error_count": 0,
            "rows_processed": p.numInputRows, "refresh_action": "BATCH", "batch_id": p.batchId,
            "state_rows": sum(s.numRowsTotal for s in p.stateOperators),
            "state_bytes": sum(s.memoryUsedBytes for s in p.stateOperators),
        })

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        run_id = str(event.runId)
        name, start = self._started.pop(run_id, (str(event.id), None))
        failed = event.exception is not None
        self.log.append({
            "pipeline_name": name, "run_id": run_id, "start_time": start, "end_time": dt.datetime.now(),
            "status": "FAILED" if failed else "SUCCESS", "error_count": int(failed), "message": event.exception,
            "refresh_action": "STREAM",
        })
        self._end_of(run_id).set()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        if not self._end_of(str(query.runId)).wait(seconds):
            raise TimeoutError(f"no end of {query.name} within {seconds} s")
