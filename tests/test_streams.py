"""Stream results against their batch twins, over several micro-batches."""

import dataclasses
import time
from datetime import timedelta

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import feeds
from tidemark.operators import (
    as_of_join,
    interval_join,
    pv_uv,
    pv_uv_running,
    session,
    slide,
    tumble,
    uv_running,
)
from tidemark.plans import Insert, Job, View
from tidemark.queries.inputs import as_user_log
from tidemark.sources import Table, read_back
from tidemark.sources.changes import read_batches
from tidemark.streaming.inspect import is_row_wise
from tidemark.streaming.settings import JobSettings

HOUR, DAY = timedelta(hours=1), timedelta(days=1)
COUNT = {"n": ("count", "*"), "low": ("min", "value")}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def run(spark, tmp_path, statements, name="job", **settings):
    job = Job(
        JobSettings(name, bounded=True, attached=True, checkpoint=str(tmp_path / "checkpoint"), restarts=0, **settings),
        statements,
    )
    return job.run(spark)


def sink(tmp_path, schema, keys=(), name="out"):
    return Table(name, schema, "parquet", path=str(tmp_path / name), keys=keys, role="sink")


@pytest.fixture
def whole(spark, data):
    return spark.read.parquet(f"{data}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


PV_UV = "category_id string, pv bigint, uv bigint"


@pytest.mark.parametrize("form", ["pairs", "retained", "slack"])
def test_pv_uv_over_batches_and_a_restart(spark, data, tmp_path, whole, form):
    options = {"pairs": {}, "retained": {"retention": DAY, "buckets": 3}, "slack": {"retention": (DAY, 2 * DAY)}}[form]
    out = sink(tmp_path, PV_UV, ("category_id",))
    statements = [
        feeds.source(tmp_path / "in"),
        View("user_log", lambda s: as_user_log(s.table("events"))),
        out,
        Insert("out", lambda s: pv_uv_running(s.table("user_log"), "category_id", "user_id", **options), "update"),
    ]
    parts = feeds.slices(feeds.events(data), 4)
    for number in (0, 1):
        feeds.add_file(tmp_path / "in", parts[number], number)
    first = run(spark, tmp_path, statements)
    assert first.status() == "FINISHED"
    seen = whole.where(F.col("event_id").isin([*parts[0]["event_id"].to_pylist(), *parts[1]["event_id"].to_pylist()]))
    assert rows(read_back(spark, out)) == rows(pv_uv(as_user_log(seen), "category_id", "user_id"))
    for number in (2, 3):
        feeds.add_file(tmp_path / "in", parts[number], number)
    second = run(spark, tmp_path, statements)
    assert rows(read_back(spark, out)) == rows(pv_uv(as_user_log(whole), "category_id", "user_id"))
    assert {r.batch_id for r in second.metrics().collect()} == {2, 3}
    assert second.metrics().agg({"rows_in": "sum"}).first()[0] >= parts[2].num_rows + parts[3].num_rows
    stamps = read_batches(spark, out.path, "parquet", PV_UV).select("writer", "batch_id").distinct().collect()
    assert len({s.writer for s in stamps}) == 1 and {s.batch_id for s in stamps} == {0, 1, 2, 3}


def test_visitors_silent_for_the_retention_are_forgotten(spark, data, tmp_path):
    part = feeds.events(data).slice(0, 200)
    users = len(set(part["user_id"].to_pylist()))
    out = sink(tmp_path, "place string, pv bigint, uv bigint", ("place",))
    keep = (timedelta(seconds=3), timedelta(seconds=4))
    statements = [
        feeds.source(tmp_path / "in"), out,
        Insert("out", lambda s: pv_uv_running(
            s.sql("SELECT 'all' AS place, user_id FROM events"), "place", "user_id", retention=keep, buckets=2), "update"),
    ]
    for number, pause in enumerate((6, 0)):
        feeds.add_file(tmp_path / "in", part, number)
        run(spark, tmp_path, statements)
        time.sleep(pause)
    assert rows(read_back(spark, out)) == [("all", 400, 2 * users)]


def test_rows_are_combined_before_the_shuffle(spark):
    from tidemark.streaming.combine import count_within_task

    df = spark.range(0, 3000, numPartitions=3).select(
        F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 7 > 0, F.col("id").cast("string")).alias("u"), F.lit(1).alias("k")
    )
    for hold in (500_000, 50):
        folded = count_within_task(df, ["k", "u"], "n", hold)
        wanted = rows(df.groupBy("k", "u").count())
        assert rows(folded.groupBy("k", "u").agg(F.sum("n"))) == wanted
        assert folded.where("u = 'hot'").count() < 130
    assert count_within_task(df.limit(0), ["k", "u"], "n").count() == 0


def test_uv_alone(spark, data, tmp_path, whole):
    feeds.in_files(tmp_path / "in", feeds.events(data))
    out = sink(tmp_path, "event_type string, uv bigint", ("event_type",))
    run(spark, tmp_path, [
        feeds.source(tmp_path / "in"), out,
        Insert("out", lambda s: uv_running(s.table("events"), "event_type", "user_id"), "update"),
    ])
    assert rows(read_back(spark, out)) == rows(pv_uv(whole, "event_type", "user_id").drop("pv"))


WINDOW = "window_start timestamp, window_end timestamp, event_type string, n bigint, low double"


@pytest.mark.parametrize("order", [None, [2, 0, 3, 1]])
def test_windows_in_update_mode(spark, data, tmp_path, whole, order):
    feeds.in_files(tmp_path / "in", feeds.events(data), 4, order)
    tumbled = sink(tmp_path, WINDOW, ("window_start", "event_type"), "tumbled")
    slid = sink(tmp_path, WINDOW, ("window_start", "event_type"), "slid")
    keys = ["event_type"]
    run(spark, tmp_path, [
        feeds.source(tmp_path / "in"), tumbled, slid,
        Insert("tumbled", lambda s: tumble(s.table("events"), "ts", HOUR, keys, COUNT), "update"),
        Insert("slid", lambda s: slide(s.table("events"), "ts", HOUR, HOUR / 4, keys, COUNT), "update"),
    ])
    assert rows(read_back(spark, tumbled)) == rows(tumble(whole, "ts", HOUR, keys, COUNT))
    assert rows(read_back(spark, slid)) == rows(slide(whole, "ts", HOUR, HOUR / 4, keys, COUNT))


def test_closed_windows_in_append_mode(spark, data, tmp_path, whole):
    feeds.in_files(tmp_path / "in", feeds.events(data))
    out = sink(tmp_path, WINDOW)
    handle = run(spark, tmp_path, [
        feeds.source(tmp_path / "in", lateness=HOUR), out,
        Insert("out", lambda s: tumble(s.table("events"), "ts", DAY, ["event_type"], COUNT)),
    ])
    found, batch = rows(read_back(spark, out)), rows(tumble(whole, "ts", DAY, ["event_type"], COUNT))
    assert set(found) < set(batch)
    assert len({r[0] for r in batch}) - len({r[0] for r in found}) <= 9  # the last file's days are still open
    report = handle.metrics()
    assert report.agg({"late_rows": "sum"}).first()[0] == 0
    assert report.where("rows_in > 0").agg({"delay_seconds": "min"}).first()[0] > 86400  # the events are of 2024


def test_closed_sessions_in_append_mode(spark, data, tmp_path, whole):
    feeds.in_files(tmp_path / "in", feeds.events(data))
    schema = "session_start timestamp, session_end timestamp, user_id bigint, n bigint, low double"
    out = sink(tmp_path, schema)
    run(spark, tmp_path, [
        feeds.source(tmp_path / "in", lateness=HOUR), out,
        Insert("out", lambda s: session(s.table("events"), "ts", 6 * HOUR, ["user_id"], COUNT)),
    ])
    found, batch = rows(read_back(spark, out)), rows(session(whole, "ts", 6 * HOUR, ["user_id"], COUNT))
    assert set(found) <= set(batch)
    last_start = max(r[0] for r in found)
    assert {r for r in batch if r[1] < last_start - DAY} <= set(found)


def test_late_rows_are_dropped_and_counted(spark, data, tmp_path):
    feeds.in_files(tmp_path / "in", feeds.events(data), 4, order=[0, 3, 1, 2])
    out = sink(tmp_path, WINDOW, ("window_start", "event_type"))
    handle = run(spark, tmp_path, [
        feeds.source(tmp_path / "in", lateness=HOUR), out,
        Insert("out", lambda s: tumble(s.table("events"), "ts", HOUR, ["event_type"], COUNT), "update"),
    ])
    assert handle.metrics().agg({"late_rows": "sum"}).first()[0] > 100


def pairs(s_or_df):
    views = s_or_df.where("event_type = 'view'").select("user_id", F.col("event_id").alias("view_id"), "ts")
    clicks = s_or_df.where("event_type = 'click'").select("user_id", F.col("event_id").alias("click_id"), "ts")
    return interval_join(
        views, clicks, ["user_id"], "ts", "ts", HOUR, 6 * HOUR, {"click_id": "click_id", "click_ts": "ts"}
    )


def test_interval_join_and_its_state(spark, data, tmp_path, whole):
    feeds.in_files(tmp_path / "in", feeds.events(data), 6)
    out = sink(tmp_path, "user_id bigint, view_id bigint, ts timestamp, click_id bigint, click_ts timestamp")
    handle = run(spark, tmp_path, [
        feeds.source(tmp_path / "in", lateness=HOUR), out,
        Insert("out", lambda s: pairs(s.table("events"))),
    ])
    assert rows(read_back(spark, out)) == rows(pairs(whole))
    assert rows(pairs(whole)) != []
    report = {r.batch_id: r for r in handle.metrics().collect()}
    # Rows that can no longer match leave the state: it holds far less than all rows read.
    assert report[max(report)].state_rows < 0.6 * whole.where("event_type IN ('view', 'click')").count()


def test_each_batch_joins_history_as_of_its_rows(spark, data, tmp_path, whole):
    feeds.in_files(tmp_path / "in", feeds.events(data))
    history = Table("history", feeds.EVENTS, "parquet", path=str(tmp_path / "in"))
    take = {"view_id": "event_id"}

    def enrich(probes, views):
        probes = probes.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
        return as_of_join(probes, views.where("event_type = 'view'"), ["user_id"], "ts", "ts", take)

    out = sink(tmp_path, "event_id bigint, user_id bigint, ts timestamp, view_id bigint")
    job = Job(
        JobSettings("enrich", bounded=True, attached=True, checkpoint=str(tmp_path / "checkpoint"), restarts=0),
        [
            feeds.source(tmp_path / "in"), history, out,
            Insert("out", lambda s: enrich(s.table("events"), s.table("history")), each_batch=True),
        ],
        static=["history"],
    )
    job.run(spark)
    assert rows(read_back(spark, out)) == rows(enrich(whole, whole))


FEED_SINK = "messageKey binary, message binary"


def test_inserts_without_state_share_one_query(spark, data, tmp_path, whole):
    feeds.in_files(tmp_path / "in", feeds.events(data))
    a, b = sink(tmp_path, FEED_SINK, name="a"), sink(tmp_path, FEED_SINK, name="b")
    statements = [
        feeds.source(tmp_path / "in"), a, b,
        View("feed", "SELECT cast(event_id AS string) AS key, props AS ums, event_type AS `table` FROM events"),
        Insert("a", "SELECT cast(key AS binary), cast(ums AS binary) FROM feed WHERE `table` IN ('view')"),
        Insert("b", "SELECT cast(key AS binary), cast(ums AS binary) FROM feed WHERE `table` IN ('click', 'error')"),
    ]
    handle = run(spark, tmp_path, statements)
    assert {r.part for r in handle.metrics().collect()} == {"shared"}
    assert read_back(spark, a).count() == whole.where("event_type = 'view'").count()
    assert read_back(spark, b).count() == whole.where("event_type IN ('click', 'error')").count()


def test_two_inserts_into_one_table(spark, data, tmp_path, whole):
    feeds.in_files(tmp_path / "in", feeds.events(data), 2)
    out = sink(tmp_path, "event_id bigint")
    run(spark, tmp_path, [
        feeds.source(tmp_path / "in"), out,
        Insert("out", "SELECT event_id FROM events WHERE event_type = 'view'"),
        Insert("out", "SELECT event_id FROM events WHERE event_type <> 'view'"),
    ])
    assert rows(read_back(spark, out)) == rows(whole.select("event_id"))


def test_undecoded_messages_go_to_the_side(spark, tmp_path):
    texts = [['{"k": "a", "n": 1}', "junk"], ['{"k": "b", "n": 2}', '{"k": 1'], ["{"]]
    for number, part in enumerate(texts):
        values = pa.array([t.encode() for t in part], pa.binary())
        feeds.add_file(tmp_path / "in", pa.table({"key": pa.nulls(len(part), pa.binary()), "value": values}), number)
    topic = Table(
        "topic", "k string, n bigint", "parquet", {"maxFilesPerTrigger": "1"}, path=str(tmp_path / "in"),
        encoding="json", undecoded=str(tmp_path / "bad"),
    )
    out = sink(tmp_path, "k string, n bigint")
    run(spark, tmp_path, [topic, out, Insert("out", "SELECT * FROM topic")])
    assert rows(read_back(spark, out)) == [("a", 1), ("b", 2)]
    bad = read_batches(spark, str(tmp_path / "bad"), "parquet", "value string")
    assert sorted(r.value for r in bad.collect()) == ["junk", "{", '{"k": 1']
    # The same beside an insert that keeps state.
    counts = sink(tmp_path, "k string, n bigint", ("k",), name="counts")
    topic = dataclasses.replace(topic, undecoded=str(tmp_path / "bad-2"))
    run(spark, tmp_path / "two", [
        topic, counts, Insert("counts", "SELECT k, count(*) AS n FROM topic GROUP BY k", "update")])
    assert rows(read_back(spark, counts)) == [("a", 1), ("b", 1)]
    bad = read_batches(spark, str(tmp_path / "bad-2"), "parquet", "value string")
    assert sorted(r.value for r in bad.collect()) == ["junk", "{", '{"k": 1']


def test_state_is_recognised(spark, data, tmp_path):
    feeds.in_files(tmp_path / "in", feeds.events(data), 1)
    stream = spark.readStream.schema(feeds.EVENTS).parquet(str(tmp_path / "in"))
    static = spark.read.schema(feeds.EVENTS).parquet(str(tmp_path / "in"))
    assert is_row_wise(stream.where("value > 0").select("event_id"))
    assert is_row_wise(stream.join(static, "event_id"))
    assert is_row_wise(stream.join(static.groupBy("event_id").count(), "event_id"))
    assert not is_row_wise(stream.groupBy("event_type").count())
    assert not is_row_wise(stream.dropDuplicates(["event_id"]))
    assert not is_row_wise(stream.join(stream.select("event_id"), "event_id"))
    assert not is_row_wise(pv_uv_running(stream, "event_type", "user_id", retention=DAY))
