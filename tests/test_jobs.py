"""Jobs: order, errors, savepoints, restarts, status, previews."""

import time
from datetime import timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

import feeds
from tidemark.functions import register
from tidemark.operators import pv_uv, pv_uv_running
from tidemark.plans import Insert, Job, View, is_cut, page, preview, preview_statement
from tidemark.queries.inputs import as_user_log
from tidemark.sources import Table, read_back
from tidemark.streaming.handle import JobHandle, job_status
from tidemark.streaming.settings import JobSettings

PV_UV = "category_id string, pv bigint, uv bigint"
SECOND = timedelta(seconds=1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def settings(tmp_path, name="job", **more):
    more = {"bounded": True, "attached": True, "restarts": 0, "checkpoint": str(tmp_path / "checkpoint"), **more}
    return JobSettings(name, **more)


def sink(tmp_path, schema, keys=(), name="out"):
    return Table(name, schema, "parquet", path=str(tmp_path / name), keys=keys, role="sink")


def visits(tmp_path, out):
    return [
        feeds.source(tmp_path / "in"),
        View("user_log", lambda s: as_user_log(s.table("events"))),
        out,
        Insert("out", lambda s: pv_uv_running(s.table("user_log"), "category_id", "user_id"), "update"),
    ]


def copies(tmp_path, out):
    return [feeds.source(tmp_path / "in"), out, Insert("out", "SELECT event_id FROM events")]


@pytest.fixture
def whole(spark, data):
    return spark.read.parquet(f"{data}/events.parquet")


# -- what a job is made of ----------------------------------------------------------------


def test_view_with_fewer_names_feeds_an_insert(spark, data, tmp_path, whole):
    out = sink(tmp_path, "user_id string, item_id string, category_id string")
    Job(
        JobSettings("copy", streaming=False),
        [
            Table("events", "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
                  "parquet", path=f"{data}/events.parquet"),
            View("user_log", lambda s: as_user_log(s.table("events"))),
            View("cdcView", "SELECT user_id, item_id, category_id, behavior FROM user_log"),
            out,
            Insert("out", "SELECT user_id, item_id, category_id FROM cdcView"),
        ],
    ).run(spark)
    assert rows(read_back(spark, out)) == rows(as_user_log(whole).select("user_id", "item_id", "category_id"))


def test_same_statements_as_batch_and_stream(spark, data, tmp_path, whole):
    feeds.in_files(tmp_path / "in", feeds.events(data), 3)
    once, more = sink(tmp_path / "b", PV_UV, ("category_id",)), sink(tmp_path / "s", PV_UV, ("category_id",))
    Job(settings(tmp_path, streaming=False), visits(tmp_path, once)).run(spark)
    Job(settings(tmp_path), visits(tmp_path, more)).run(spark)
    assert rows(read_back(spark, once)) == rows(read_back(spark, more)) != []


def test_running_a_batch_twice_inserts_twice(spark, data, tmp_path):
    feeds.in_files(tmp_path / "in", feeds.events(data), 1)
    out = sink(tmp_path, "event_id bigint")
    job = Job(settings(tmp_path, streaming=False), copies(tmp_path, out))
    job.run(spark)
    job.run(spark)
    assert read_back(spark, out).count() == 2 * feeds.events(data).num_rows


def test_staged_views_are_computed_once(spark, data, tmp_path, whole):
    feeds.in_files(tmp_path / "in", feeds.events(data), 1)
    a, b = sink(tmp_path, "user_id string", name="a"), sink(tmp_path, "user_id string", name="b")
    calls = spark.sparkContext.accumulator(0)

    def counted(session):
        def same(ids: pd.Series) -> pd.Series:
            calls.add(len(ids))
            return ids

        register(session, "same", same, "scalar", "string")
        return session.sql("SELECT same(cast(user_id AS string)) AS user_id, event_type FROM events")

    statements = [
        feeds.source(tmp_path / "in"), View("log", counted), a, b,
        Insert("a", "SELECT user_id FROM log WHERE event_type = 'view'"),
        Insert("b", "SELECT user_id FROM log WHERE event_type <> 'view'"),
    ]
    Job(settings(tmp_path, streaming=False), statements, staged=["log"]).run(spark)
    assert calls.value == whole.count()
    assert read_back(spark, a).count() + read_back(spark, b).count() == whole.count()


def test_a_stream_reads_tables_that_are_folders(spark, data, tmp_path):
    feeds.in_files(tmp_path / "events.parquet", feeds.events(data), 3)
    out = sink(tmp_path, "event_id bigint")
    table = Table("events", feeds.EVENTS, "parquet", path=str(tmp_path / "event[s].parquet"))
    Job(settings(tmp_path), [table, out, Insert("out", "SELECT event_id FROM events")]).run(spark)
    assert read_back(spark, out).count() == feeds.events(data).num_rows


def test_a_job_needs_inserts_into_its_own_sinks(spark, tmp_path):
    table = feeds.source(tmp_path / "in")
    with pytest.raises(ValueError, match="no insert"):
        Job(JobSettings("j"), [table]).run(spark)
    with pytest.raises(TypeError, match="preview"):
        Job(JobSettings("j"), [table, "SELECT 1"]).run(spark)
    with pytest.raises(ValueError, match="not a sink"):
        Job(JobSettings("j"), [table, Insert("events", "SELECT 1")]).run(spark)
    with pytest.raises(ValueError, match="table with keys"):
        Job(JobSettings("j"), [table, sink(tmp_path, "n bigint"), Insert("out", "SELECT 1", "update")]).run(spark)
    with pytest.raises(ValueError, match="mode"):
        Insert("out", "SELECT 1", "complete")


def test_statements_see_only_earlier_ones(spark, data, tmp_path):
    feeds.in_files(tmp_path / "in", feeds.events(data), 1)
    out = sink(tmp_path, "event_id bigint")
    late = [feeds.source(tmp_path / "in"), View("a", "SELECT * FROM b"), View("b", "SELECT event_id FROM events"), out,
            Insert("out", "SELECT * FROM a")]
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        Job(settings(tmp_path, streaming=False), late).run(spark)


def test_arity_is_checked_before_a_stream_starts(spark, data, tmp_path):
    feeds.in_files(tmp_path / "in", feeds.events(data), 1)
    out = sink(tmp_path, "event_id bigint")
    bad = [feeds.source(tmp_path / "in"), out, Insert("out", "SELECT event_id, user_id FROM events")]
    with pytest.raises(ValueError, match="2 columns into 1"):
        Job(settings(tmp_path), bad).run(spark)


def test_settings():
    assert JobSettings("j").trigger() == {"processingTime": "600000 milliseconds"}
    assert JobSettings("j", checkpoint_interval=timedelta(0)).trigger() == {"processingTime": "600000 milliseconds"}
    assert JobSettings("j", checkpoint_interval=SECOND).trigger() == {"processingTime": "1000 milliseconds"}
    assert JobSettings("j", bounded=True).trigger() == {"availableNow": True}
    with pytest.raises(ValueError):
        JobSettings("j", on_mismatch="ignore")


def test_artifacts_and_parameters_of_a_job(spark, data, tmp_path):
    feeds.in_files(tmp_path / "in", feeds.events(data), 1)
    (tmp_path / "only_here.py").write_text("def mark(values):\n    return values + 1000000\n")
    out = sink(tmp_path, "event_id bigint, day string")

    def query(session):
        def marked(ids: pd.Series) -> pd.Series:
            import only_here

            return only_here.mark(ids)

        register(session, "marked", marked, "scalar", "long")
        return session.sql(f"SELECT marked(event_id), '{session.conf.get('job.day')}' FROM events")

    own = dict(streaming=False, artifacts=[str(tmp_path / "only_here.py")], params={"day": "monday"}, catalog="spark_catalog")
    Job(settings(tmp_path, **own), [feeds.source(tmp_path / "in"), out, Insert("out", query)]).run(spark)
    got = read_back(spark, out).selectExpr("min(event_id) >= 1000000", "min(day)").first()
    assert tuple(got) == (True, "monday")


# -- life of a job --------------------------------------------------------------------------


def wait_for(check, seconds=60):
    end = time.time() + seconds
    while time.time() < end:
        if check():
            return
        time.sleep(0.2)
    raise AssertionError("did not happen in time")


def test_stop_with_savepoint_and_restore(spark, data, tmp_path, whole):
    parts = feeds.slices(feeds.events(data), 4)
    for number in (0, 1):
        feeds.add_file(tmp_path / "in", parts[number], number)
    out = sink(tmp_path, PV_UV, ("category_id",))
    live = dict(bounded=False, attached=False, checkpoint_interval=SECOND)
    handle = Job(settings(tmp_path, **live), visits(tmp_path, out)).run(spark)
    assert handle.status() == "RUNNING"
    saved = handle.stop(str(tmp_path / "saves"), drain=True)
    assert handle.status() == "FINISHED" and saved.startswith(str(tmp_path / "saves"))
    read = handle.metrics().agg({"rows_in": "sum"}).first()[0]
    for number in (2, 3):
        feeds.add_file(tmp_path / "in", parts[number], number)
    again = Job(
        settings(tmp_path, checkpoint=str(tmp_path / "second"), restore_from=saved), visits(tmp_path, out)
    ).run(spark)
    assert rows(read_back(spark, out)) == rows(pv_uv(as_user_log(whole), "category_id", "user_id"))
    more = again.metrics().agg({"rows_in": "sum"}).first()[0]
    assert more <= read * (parts[2].num_rows + parts[3].num_rows) / (parts[0].num_rows + parts[1].num_rows)


def test_savepoint_of_a_running_job_goes_on(spark, data, tmp_path):
    parts = feeds.slices(feeds.events(data), 3)
    feeds.add_file(tmp_path / "in", parts[0], 0)
    out = sink(tmp_path, "event_id bigint")
    live = dict(bounded=False, attached=False, checkpoint_interval=SECOND)
    handle = Job(settings(tmp_path, **live), copies(tmp_path, out)).run(spark)
    wait_for(lambda: read_back(spark, out).count() == parts[0].num_rows)
    saved = handle.savepoint(str(tmp_path / "saves"))
    assert handle.status() == "RUNNING"
    feeds.add_file(tmp_path / "in", parts[1], 1)
    wait_for(lambda: read_back(spark, out).count() == parts[0].num_rows + parts[1].num_rows)
    assert handle.cancel() is None
    assert handle.status() == "CANCELED"
    # The savepoint knows the first file only.
    other = sink(tmp_path, "event_id bigint", name="other")
    statements = [feeds.source(tmp_path / "in"), other, Insert("other", "SELECT event_id FROM events")]
    Job(settings(tmp_path, checkpoint=str(tmp_path / "second"), restore_from=saved), statements).run(spark)
    assert read_back(spark, other).count() == parts[1].num_rows


def test_restore_beside_the_run_it_comes_from(spark, data, tmp_path):
    """The original runs on after its savepoint; the restored run writes the same sink, and no row counts twice."""
    parts = feeds.slices(feeds.events(data), 3)
    feeds.add_file(tmp_path / "in", parts[0], 0)
    out = sink(tmp_path, "event_id bigint")
    live = dict(bounded=False, attached=False, checkpoint_interval=SECOND)
    handle = Job(settings(tmp_path, **live), copies(tmp_path, out)).run(spark)
    wait_for(lambda: read_back(spark, out).count() == parts[0].num_rows)
    saved = handle.savepoint(str(tmp_path / "saves"))
    for number in (1, 2):
        feeds.add_file(tmp_path / "in", parts[number], number)
        wait_for(lambda n=number: read_back(spark, out).count() == sum(p.num_rows for p in parts[: n + 1]))
    handle.cancel()
    second = settings(tmp_path, checkpoint=str(tmp_path / "second"), restore_from=saved)
    Job(second, copies(tmp_path, out)).run(spark)
    ids = sorted(r.event_id for r in read_back(spark, out).collect())
    assert ids == sorted(i for p in parts for i in p.column("event_id").to_pylist())
    # Started again it goes on; another savepoint, or one for a checkpoint begun without it, is refused.
    Job(second, copies(tmp_path, out)).run(spark)
    assert read_back(spark, out).count() == len(ids)
    with pytest.raises(ValueError, match="already"):
        Job(settings(tmp_path, restore_from=saved), copies(tmp_path, out)).run(spark)


@pytest.mark.parametrize(
    "query",
    [
        "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS n FROM events",
        "SELECT event_id, 1 AS n FROM events ORDER BY event_id",
        "SELECT event_id, 1 AS n FROM events LIMIT 100000 OFFSET 1",
        "SELECT event_id, 1 AS n FROM events INTERSECT SELECT event_id, 1 FROM events",
        "SELECT event_id, 1 AS n FROM events EXCEPT SELECT event_id, 2 FROM events",
        "SELECT event_id, 1 AS n FROM events WHERE event_id IN (SELECT max(event_id) FROM events)",
    ],
)
@pytest.mark.parametrize("each_batch", [False, True])
def test_no_query_runs_per_batch_unless_it_is_row_wise(spark, data, tmp_path, query, each_batch):
    feeds.in_files(tmp_path / "in", feeds.events(data), 3)
    out = sink(tmp_path, "event_id bigint, n bigint")
    more = sink(tmp_path, "event_id bigint", name="more")
    statements = [
        feeds.source(tmp_path / "in"), out, more,
        Insert("out", query, each_batch=each_batch), Insert("more", "SELECT event_id FROM events"),
    ]
    with pytest.raises(Exception):  # noqa: B017 - by us, or by Spark
        Job(settings(tmp_path), statements).run(spark)
    assert read_back(spark, out).count() == 0


def test_two_tables_of_one_name_are_refused(tmp_path):
    with pytest.raises(ValueError, match="two tables"):
        Job(settings(tmp_path), [sink(tmp_path, "a int"), sink(tmp_path, "b int")])


def test_cancel_with_savepoint(spark, data, tmp_path):
    feeds.in_files(tmp_path / "in", feeds.events(data), 1)
    out = sink(tmp_path, "event_id bigint")
    live = dict(bounded=False, attached=False, checkpoint_interval=SECOND)
    handle = Job(settings(tmp_path, **live), copies(tmp_path, out)).run(spark)
    assert handle.cancel(str(tmp_path / "saves")).startswith(str(tmp_path / "saves"))
    assert handle.cancel("  ") is None


def test_state_that_does_not_map(spark, data, tmp_path):
    parts = feeds.slices(feeds.events(data), 2)
    feeds.add_file(tmp_path / "in", parts[0], 0)
    out = sink(tmp_path, "event_type string, n bigint", ("event_type",))
    counted = [feeds.source(tmp_path / "in"), out, Insert("out", "SELECT event_type, count(*) FROM events GROUP BY event_type", "update")]
    saved = Job(settings(tmp_path), counted).run(spark).stop(str(tmp_path / "saves"))
    feeds.add_file(tmp_path / "in", parts[1], 1)
    plain = sink(tmp_path, "event_id bigint", name="plain")
    changed = [feeds.source(tmp_path / "in"), plain, Insert("plain", "SELECT event_id FROM events")]
    strict = settings(tmp_path, checkpoint=str(tmp_path / "two"), restore_from=saved)
    with pytest.raises(ValueError, match="does not have"):
        Job(strict, changed).run(spark)
    loose = settings(tmp_path, checkpoint=str(tmp_path / "three"), restore_from=saved, on_mismatch="drop_state")
    Job(loose, changed).run(spark)
    assert read_back(spark, plain).count() == parts[0].num_rows + parts[1].num_rows  # a new part reads from the start
    with pytest.raises(FileNotFoundError):
        Job(settings(tmp_path, checkpoint=str(tmp_path / "four"), restore_from=str(tmp_path / "none")), changed).run(spark)


def test_dropped_state_goes_on_from_the_offsets(spark, data, tmp_path):
    from tidemark.streaming import savepoints

    parts = feeds.slices(feeds.events(data), 2)
    feeds.add_file(tmp_path / "in", parts[0], 0)
    out = sink(tmp_path, "event_type string, n bigint", ("event_type",))
    counted = [feeds.source(tmp_path / "in"), out, Insert("out", "SELECT event_type, count(*) FROM events GROUP BY event_type", "update")]
    saved = Job(settings(tmp_path), counted).run(spark).stop(str(tmp_path / "saves"))
    feeds.add_file(tmp_path / "in", parts[1], 1)
    with pytest.raises(ValueError, match="does not use"):
        savepoints.restore(spark, saved, str(tmp_path / "two"), {"insert-0": False}, "fail")
    savepoints.restore(spark, saved, str(tmp_path / "two"), {"insert-0": False}, "drop_state")
    seen = []
    query = (
        spark.readStream.schema(feeds.EVENTS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        .writeStream.option("checkpointLocation", str(tmp_path / "two" / "insert-0")).trigger(availableNow=True)
        .foreachBatch(lambda batch, _: seen.append(batch.count())).start()
    )
    query.awaitTermination()
    assert seen == [parts[1].num_rows]


def test_restart_after_failures(spark, data, tmp_path):
    feeds.in_files(tmp_path / "in", feeds.events(data), 2)
    out = sink(tmp_path, "event_id bigint")
    failures = []

    def shaky(s):
        if not s.table("events").isStreaming and len(failures) < 2:
            failures.append(1)
            raise RuntimeError("not yet")
        return s.table("events").select("event_id")

    statements = [feeds.source(tmp_path / "in"), out, Insert("out", shaky, each_batch=True)]
    handle = Job(settings(tmp_path, restarts=3, restart_delay=SECOND / 10), statements).run(spark)
    assert handle.status() == "FINISHED" and len(failures) == 2
    assert read_back(spark, out).count() == feeds.events(data).num_rows


def test_a_job_fails_when_restarts_are_used_up(spark, data, tmp_path):
    feeds.in_files(tmp_path / "in", feeds.events(data), 1)
    out = sink(tmp_path, "event_id bigint")
    tries = []

    def broken(s):
        if s.table("events").isStreaming:
            return s.table("events").select("event_id")
        tries.append(1)
        raise RuntimeError("always")

    statements = [feeds.source(tmp_path / "in"), out, Insert("out", broken, each_batch=True)]
    job = Job(settings(tmp_path, attached=False, restarts=2, restart_delay=SECOND / 10), statements)
    handle = job.run(spark)
    with pytest.raises(Exception, match="always"):
        handle.wait()
    assert handle.status() == "FAILED" and len(tries) == 3
    status = job_status(spark, {"job": handle}, ["job", "JOB"])
    assert rows(status.select("job", "status", "is_final")) == [("JOB", "NONE", True), ("job", "FAILED", True)]


def test_metrics_table(spark, data, tmp_path):
    feeds.in_files(tmp_path / "in", feeds.events(data), 3)
    handle = Job(settings(tmp_path), copies(tmp_path, sink(tmp_path, "event_id bigint"))).run(spark)
    handle.append_metrics(str(tmp_path / "metrics"))
    handle.append_metrics(str(tmp_path / "metrics"))
    back = spark.read.parquet(str(tmp_path / "metrics"))
    assert back.count() == 3
    assert back.agg(F.sum("rows_in")).first()[0] == feeds.events(data).num_rows
    assert job_status(spark, {"job": handle}, ["job"]).first().status == "FINISHED"
    written = sum(f.stat().st_size for f in (tmp_path / "out").rglob("*.parquet"))
    assert back.agg(F.sum("rows_out")).first()[0] == feeds.events(data).num_rows
    assert written <= back.agg(F.sum("bytes_out")).first()[0] <= written + 10_000  # and small marks beside them


def test_rows_out_of_each_part(spark, data, tmp_path):
    """A shared pass over two sinks, one of which gets nothing, and a part with state of its own."""
    feeds.in_files(tmp_path / "in", feeds.events(data), 2)
    views, none, per_type = sink(tmp_path, "event_id bigint", name="views"), sink(tmp_path, "event_id bigint", name="none"), sink(
        tmp_path, "event_type string, n bigint", ("event_type",), "per_type"
    )
    statements = [
        feeds.source(tmp_path / "in"), views, none, per_type,
        Insert("views", "SELECT event_id FROM events WHERE event_type = 'view'"),
        Insert("none", "SELECT event_id FROM events WHERE 1 = 0"),
        Insert("per_type", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type", "update"),
    ]
    handle = Job(settings(tmp_path), statements).run(spark)
    report = {r.part: r for r in handle.metrics().groupBy("part").agg(F.sum("rows_in").alias("i"), F.sum("rows_out").alias("o")).collect()}
    kinds = feeds.events(data)["event_type"].to_pylist()
    assert report["shared"].o == kinds.count("view") and report["insert-2"].o == 2 * len(set(kinds))
    assert read_back(spark, none).count() == 0


def test_created_before_started(spark, tmp_path):
    assert JobHandle(spark, settings(tmp_path), "", {}).status() == "CREATED"


# -- previews ----------------------------------------------------------------------------------


def test_pages_cover_all_rows_once(spark):
    df = spark.createDataFrame([(i % 3, i) for i in range(11)], "a int, b int")
    wanted = sorted((i % 3, i) for i in range(11))
    pages = [[tuple(r) for r in page(df, ["a"], n, 4).collect()] for n in range(1, 5)]
    assert [r for p in pages for r in p] == wanted
    assert [len(p) for p in pages] == [4, 4, 3, 0]
    with pytest.raises(ValueError):
        page(df, ["a"], 0, 4)


def test_preview_is_capped(spark):
    assert preview(spark.range(100), cap=7).count() == 7
    assert is_cut(spark.range(100), 7) and not is_cut(spark.range(7), 7)
    assert preview(spark.range(1_500_000)).count() == 1_500_000
    assert [r.id for r in page(spark.range(1_500_000), ["id"], 700_001, 2).collect()] == [1_400_000, 1_400_001]


def test_preview_takes_one_statement():
    insert = Insert("t", "SELECT 1")
    assert preview_statement([View("v", "SELECT 2"), insert]) == "SELECT 1"
    assert preview_statement(["SELECT 3"]) == "SELECT 3"
    for bad, word in [([insert, "SELECT 1"], "either"), ([], "nothing"), ([insert, insert], "one statement")]:
        with pytest.raises(ValueError, match=word):
            preview_statement(bad)


def test_preview_of_a_job(spark, data, tmp_path):
    feeds.in_files(tmp_path / "in", feeds.events(data), 1)
    out = sink(tmp_path, "event_id bigint")
    got = Job(settings(tmp_path), copies(tmp_path, out)).preview(spark, cap=5)
    assert got.count() == 5 and not (tmp_path / "out").exists()
