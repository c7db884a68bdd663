"""A running job: restart, control, status and metrics."""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Callable, Iterable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryProgress

from tidemark import files
from tidemark.session import shared_dir
from tidemark.streaming import savepoints
from tidemark.streaming.settings import JobSettings

# Job states that will not change any more (fixed values); an unknown job is NONE.
FINAL = ("NONE", "FAILED", "CANCELED", "FINISHED")

METRICS = (
    "job string, part string, run_id string, batch_id long, started string, duration_ms long, "
    "rows_in long, rows_per_second double, state_rows long, late_rows long, watermark string, "
    "delay_seconds double, rows_out long, bytes_out long"
)

#: Reports of micro-batches held in memory; beyond that the older ones go to files.
REPORTS_HELD = 1000

Starter = Callable[[], StreamingQuery]


class JobHandle:
    """The streaming queries of one job, each watched by a thread of its own.

    A query that fails is started again from its checkpoint, ``restarts`` times with
    ``restart_delay`` between; then the whole job has failed.
    """

    def __init__(self, session: SparkSession, settings: JobSettings, checkpoint: str, parts: Mapping[str, Starter]):
        self.session, self.settings, self.checkpoint = session, settings, checkpoint
        self.run_id = uuid.uuid4().hex
        self.error: Exception | None = None
        self._parts = dict(parts)
        self._queries: dict[str, StreamingQuery] = {}
        self._progress: dict[tuple, tuple] = {}
        self._reports: str | None = None  # folder of the reports that are no longer held
        self._report_files = 0
        self._out: dict[tuple, list] = {}  # by part and batch: rows and bytes written
        self._reported: dict[tuple, int] = {}  # by part and run of its query: the last batch in those files
        self._noting = threading.Lock()
        self._threads: list[threading.Thread] = []
        self._halt = threading.Event()
        self._waiting: set[str] = set()
        self._end: str | None = None
        self._lock = threading.RLock()

    # -- life ---------------------------------------------------------------

    def start(self) -> "JobHandle":
        self._halt.clear()
        # First starts happen here, so that a query Spark refuses is the caller's error.
        for name, starter in self._parts.items():
            self._queries[name] = starter()
        self._threads = [
            threading.Thread(target=self._watch, args=(name,), name=f"{self.settings.name}.{name}", daemon=True)
            for name in self._parts
        ]
        for thread in self._threads:
            thread.start()
        return self

    def _watch(self, name: str) -> None:
        left = self.settings.restarts
        while True:
            query = self._queries[name]
            try:
                query.awaitTermination()
                self._note(name, query.recentProgress)
                return
            except Exception as error:  # noqa: BLE001 - any failure of the query counts
                self._note(name, query.recentProgress)
                if self._halt.is_set():
                    return
                while True:
                    if left == 0:
                        self._fail(error)
                        return
                    left -= 1
                    self._waiting.add(name)
                    stopped = self._halt.wait(self.settings.restart_delay.total_seconds())
                    self._waiting.discard(name)
                    if stopped:
                        return
                    try:
                        self._queries[name] = self._parts[name]()
                        break
                    except Exception as again:  # noqa: BLE001
                        error = again

    def _fail(self, error: Exception) -> None:
        with self._lock:
            self.error = self.error or error
        self._halt.set()
        for query in self._queries.values():
            query.stop()

    def wait(self, timeout: float | None = None) -> str:
        """Block until the job ends; raise its error if it failed."""
        for thread in self._threads:
            thread.join(timeout)
        if self.error is not None:
            raise self.error
        return self.status()

    def _stop_queries(self, drain: bool = False) -> None:
        if drain:
            for query in self._queries.values():
                if query.isActive:
                    query.processAllAvailable()
        self._halt.set()
        for query in self._queries.values():
            query.stop()
        for thread in self._threads:
            thread.join()

    # -- control ------------------------------------------------------------

    def savepoint(self, directory: str | None = None) -> str:
        """Halt at a batch boundary, copy the checkpoint, go on. Returns the copy's folder."""
        self._stop_queries()
        target = savepoints.save(
            self.session, self.checkpoint, directory or self.settings.savepoint_dir, self.settings.name
        )
        if self._end is None and self.error is None:
            self.start()
        return target

    def stop(self, directory: str | None = None, drain: bool = False) -> str:
        """End the job with a savepoint; ``drain`` first processes what has arrived."""
        self._stop_queries(drain)
        self._end = "FINISHED"
        return savepoints.save(
            self.session, self.checkpoint, directory or self.settings.savepoint_dir, self.settings.name
        )

    def cancel(self, directory: str | None = None) -> str | None:
        """End the job; take a savepoint only if a folder is given."""
        self._stop_queries()
        self._end = "CANCELED"
        if directory and directory.strip():
            return savepoints.save(self.session, self.checkpoint, directory, self.settings.name)
        return None

    # -- reports ------------------------------------------------------------

    def status(self) -> str:
        if self.error is not None:
            return "FAILED"
        if self._end is not None:
            return self._end
        if self._waiting:
            return "RESTARTING"
        if any(t.is_alive() for t in self._threads):
            return "RUNNING"
        return "FINISHED" if self._threads else "CREATED"

    def note_last(self, name: str) -> None:
        """Keep the report of the batch before the running one; Spark forgets old reports."""
        query = self._queries.get(name)
        report = query.lastProgress if query else None
        if report is not None:
            self._note(name, [report])

    def note_out(self, name: str, batch_id: int, written: Iterable[tuple[int, int | None]]) -> None:
        """Keep the (rows, bytes) that a batch has written into its sinks; a replay takes their place."""
        counts = list(written)
        known = [size for _, size in counts if size is not None]
        with self._noting:
            self._out[name, batch_id] = [sum(n for n, _ in counts), sum(known) if known else None]

    def _note(self, name: str, reports: Iterable[StreamingQueryProgress]) -> None:
        for p in reports:
            operators, times = p["stateOperators"] or [], p["eventTime"] or {}
            row = (
                self.settings.name,
                name,
                self.run_id,
                int(p["batchId"]),
                p["timestamp"],
                int(p["batchDuration"]),
                int(p["numInputRows"]),
                float(p["processedRowsPerSecond"]) if p["numInputRows"] else 0.0,
                sum(int(o["numRowsTotal"]) for o in operators),
                sum(int(o["numRowsDroppedByWatermark"]) for o in operators),
                times.get("watermark"),
                _seconds_between(times.get("max"), p["timestamp"]),
            )
            with self._noting:
                row += tuple(self._out.get((name, row[3]), (None, None)))
                if row[3] > self._reported.get((name, str(p["runId"])), -1):
                    self._progress[(name, str(p["runId"]), row[3])] = row
        with self._noting:
            if len(self._progress) > REPORTS_HELD:
                self._put_away()

    def _put_away(self) -> None:
        """Write the reports held, but for the newest of each query, which may still change."""
        newest: dict[tuple, int] = {}
        for part, run, batch in self._progress:
            newest[part, run] = max(batch, newest.get((part, run), -1))
        done = [k for k in self._progress if k[2] < newest[k[0], k[1]]]
        if not done:
            return
        self._reports = self._reports or shared_dir(self.session, "reports")
        names = [field.split()[0] for field in METRICS.split(", ")]
        lines = "".join(json.dumps(dict(zip(names, self._progress[k]))) + "\n" for k in done)
        files.write_text(self.session, f"{self._reports}/{self._report_files:08d}.json", lines)
        self._report_files += 1
        for part, run, batch in done:
            del self._progress[part, run, batch]
            self._out.pop((part, batch), None)
            self._reported[part, run] = max(batch, self._reported.get((part, run), -1))

    def metrics(self) -> DataFrame:
        """One row per micro-batch and part since the start; older ones come from files.

        ``delay_seconds`` is how far the newest event of the batch was behind its start;
        it needs a watermark. ``rows_out`` counts the rows handed to the sinks of the part, but for
        batches that a ledger has already; ``bytes_out`` is the size of their files, null without files.
        """
        for name, query in self._queries.items():
            self._note(name, query.recentProgress)
        with self._noting:
            held, folder = list(self._progress.values()), self._reports
            # The files are listed here, so that what is put away from now on does not count twice.
            written = [f"{folder}/{n:08d}.json" for n in range(self._report_files)]
        rows = self.session.createDataFrame(held, METRICS)
        return rows.unionByName(self.session.read.schema(METRICS).json(written)) if written else rows

    def append_metrics(self, path: str) -> None:
        """Add the rows of this run to a metrics table in files; again is the same as once."""
        self.metrics().write.mode("overwrite").parquet(f"{path}/run_id={self.run_id}")


def _seconds_between(earlier: str | None, later: str | None) -> float | None:
    if not earlier or not later:
        return None
    return (datetime.fromisoformat(later) - datetime.fromisoformat(earlier)).total_seconds()


def job_status(session: SparkSession, handles: Mapping[str, JobHandle], names: list[str]) -> DataFrame:
    """Status of the jobs asked for; names match exactly, unknown ones are ``NONE``."""
    rows = []
    for name in names:
        handle = handles.get(name)
        status = handle.status() if handle else "NONE"
        rows.append((name, handle.run_id if handle else None, status, status in FINAL))
    return session.createDataFrame(rows, "job string, run_id string, status string, is_final boolean")
