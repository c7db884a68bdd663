"""Reports of a job's micro-batches: memory stays bounded, and none is lost or counted twice."""

from tidemark.streaming import handle
from tidemark.streaming.handle import JobHandle
from tidemark.streaming.settings import JobSettings


def report(batch, rows, run="r1"):
    return {
        "batchId": batch, "timestamp": "2024-01-01T00:00:00.000Z", "batchDuration": 5, "numInputRows": rows,
        "processedRowsPerSecond": 2.0, "stateOperators": [], "eventTime": {}, "runId": run,
    }


def test_old_reports_go_to_files(spark):
    job = JobHandle(spark, JobSettings("many"), "none", {})
    most = 0
    for batch in range(10_000):
        # Spark tells of the running batch more than once, and repeats old reports.
        job._note("part", [report(max(0, batch - 900), 1), report(batch, 0), report(batch, 1)])
        most = max(most, len(job._progress))
    assert most <= handle.REPORTS_HELD + 1 and len(job._reported) == 1
    found = job.metrics().collect()
    assert sorted(r.batch_id for r in found) == list(range(10_000))
    assert {(r.job, r.part, r.rows_in, r.run_id) for r in found} == {("many", "part", 1, job.run_id)}
    assert {(r.watermark, r.rows_per_second) for r in found} == {(None, 2.0)}


def test_reports_of_a_query_started_again(spark, monkeypatch):
    monkeypatch.setattr(handle, "REPORTS_HELD", 3)
    job = JobHandle(spark, JobSettings("again"), "none", {})
    for run in ("r1", "r2"):
        job._note("a", [report(b, 1, run) for b in range(5)])
        job._note("b", [report(7, 2, run)])
    assert job.metrics().groupBy("part").sum("rows_in").orderBy("part").collect() == [("a", 10), ("b", 4)]
