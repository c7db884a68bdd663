"""Operators with state on streams: versions, expiry by event time, late rows, state carried over."""

import random
from datetime import datetime, timedelta, timezone

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

import feeds
from tidemark.operators import as_of_join, pv_uv_running
from tidemark.plans import Insert, Job
from tidemark.queries.relational import Mean
from tidemark.queries.stateful import Count, CountAndLargest, asof_join_stream
from tidemark.queries.timeline import asof_left
from tidemark.sources import Table, read_back
from tidemark.sources.changes import read_batches
from tidemark.streaming.aggregate import aggregate_running, carried_states
from tidemark.streaming.asof import as_of_join_stream
from tidemark.streaming.late import LATE_BY, Watermark, split_late
from tidemark.streaming.settings import JobSettings

MINUTE, HOUR = timedelta(minutes=1), timedelta(hours=1)
START = datetime(2024, 1, 1, tzinfo=timezone.utc)
ROW = pa.schema([("n", pa.int64()), ("ts", pa.timestamp("us", "UTC")), ("user", pa.int64()), ("kind", pa.string()), ("value", pa.float64())])
TEXT = "n bigint, ts timestamp, user bigint, kind string, value double"


def rows(df):
    plain = lambda v: "nan" if v != v else v
    return sorted((tuple(plain(v) for v in r) for r in df.collect()), key=repr)


def add(folder, number, entries):
    """Entries (n, minutes from the start or None, user, kind, value) as one file."""
    data = [(n, None if m is None else START + timedelta(minutes=m), u, k, v) for n, m, u, k, v in entries]
    columns = list(zip(*data)) if data else [[] for _ in ROW]
    feeds.add_file(folder, pa.table([pa.array(c, f.type) for c, f in zip(columns, ROW)], schema=ROW), number)


def source(tmp_path, lateness, name="events", **more):
    return Table(name, TEXT, "parquet", {"maxFilesPerTrigger": "1"}, path=str(tmp_path / "in"), event_time="ts", lateness=lateness, **more)


def sink(tmp_path, schema, keys=(), name="out"):
    return Table(name, schema, "parquet", path=str(tmp_path / name), keys=keys, role="sink")


def run(spark, tmp_path, statements, name="job", **settings):
    options = {"bounded": True, "attached": True, "checkpoint": str(tmp_path / name), "restarts": 0} | settings
    return Job(JobSettings(name, **options), statements).run(spark)


def shuffled_feed(tmp_path, seed, count, jitter):
    """Entries out of order by up to ``jitter`` minutes, in four files; then two files that close the time."""
    draw = random.Random(seed)
    entries = [
        (n, draw.randrange(600), draw.choice([1, 1, 1, 2, 3, None]), draw.choice(["ask", "set"]), draw.choice([1.5, None, float("nan")]))
        for n in range(count)
    ]
    entries.sort(key=lambda e: e[1] + draw.random() * jitter)
    size = -(-count // 4)
    for number in range(4):
        add(tmp_path / "in", number, entries[number * size : number * size + size])
    for number in (4, 5):
        add(tmp_path / "in", number, [(-1, 5_000 + number, -1, kind, None) for kind in ("ask", "set")])
    return entries


@pytest.mark.parametrize("how, shares", [("left", 1), ("inner", 3)])
def test_versions_of_a_stream_that_is_out_of_order(spark, tmp_path, how, shares):
    jitter = 40
    shuffled_feed(tmp_path, 1, 120, jitter)
    add(tmp_path / "in", 6, [(900, None, 1, "ask", 2.0), (901, None, 1, "set", 2.0)])
    take = {"set_n": "n", "set_value": "value", "set_ts": "ts"}
    out = sink(tmp_path, f"{TEXT}, set_n bigint, set_value double, set_ts timestamp")
    joined = lambda join, s, **more: join(
        s.table("events").where("kind = 'ask'"), s.table("events").where("kind = 'set'"), ["user"], "ts", "ts", take, how=how, **more
    )
    handle = run(spark, tmp_path, [
        source(tmp_path, timedelta(minutes=jitter)), out, Insert("out", lambda s: joined(as_of_join_stream, s, shares=shares)),
    ])
    metrics = {r.batch_id: r for r in handle.metrics().collect()}
    assert all(r.late_rows == 0 for r in metrics.values())
    found = read_back(spark, out).where("user IS NULL OR user <> -1")
    spark.read.schema(TEXT).parquet(str(tmp_path / "in")).where("user IS NULL OR user <> -1").createOrReplaceTempView("events")
    assert rows(found) == rows(joined(as_of_join, spark))
    assert metrics[max(metrics)].state_rows <= 8 * shares  # a version and a timer for each key


def test_many_keys_with_versions_share_values_of_state(spark, tmp_path):
    for number in range(2):
        add(tmp_path / "in", number, [(n, number * 100 + n % 7, n // 2, ("set", "ask")[n % 2], float(number)) for n in range(200)])
    add(tmp_path / "in", 2, [(-1, 5_000, -1, kind, None) for kind in ("ask", "set")])
    add(tmp_path / "in", 3, [(-1, 9_000, -1, kind, None) for kind in ("ask", "set")])
    out = sink(tmp_path, "n bigint, user bigint, ts timestamp, set_n bigint")
    asked = lambda df: df.where("kind = 'ask'").select("n", "user", "ts")
    joined = lambda join, s, **more: join(asked(s.table("events")), s.table("events").where("kind = 'set'"), ["user"], "ts", "ts", {"set_n": "n"}, **more)
    handle = run(spark, tmp_path, [source(tmp_path, MINUTE), out, Insert("out", lambda s: joined(as_of_join_stream, s, buckets=4))])
    spark.read.schema(TEXT).parquet(str(tmp_path / "in")).createOrReplaceTempView("events")
    wanted = rows(joined(as_of_join, spark).where("user <> -1"))
    assert len(wanted) == 200 and rows(read_back(spark, out).where("user <> -1")) == wanted
    assert max(r.state_rows for r in handle.metrics().collect()) <= 20  # a value and a few timers for each bucket


def test_the_last_probes_are_answered_however_many_files_there_are(spark, data, tmp_path):
    """With eight files a slice the last rows and both rows that close the time came in one batch."""
    events = spark.read.parquet(f"{data}/events.parquet")
    events.repartition(8).write.parquet(str(tmp_path / "events.parquet"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "4096")
    found = asof_join_stream(spark, str(tmp_path)).select("event_id", "view_id")
    assert rows(found) == rows(asof_left(spark, data).select("event_id", "view_id"))


def test_versions_need_two_streams_and_new_names(spark):
    df = spark.createDataFrame([], TEXT)
    for options in ({"how": "full"}, {}):
        with pytest.raises(ValueError):
            as_of_join_stream(df, df, ["user"], "ts", "ts", {"v": "value"}, **options)


def test_state_goes_once_no_probe_can_ask(spark, tmp_path):
    for number in range(5):
        add(tmp_path / "in", number, [(n, number * 100 + n % 90, n % 3, "set", 1.0) for n in range(90)] + [(99, number * 100 + 95, 0, "ask", 0.0)])
    out = sink(tmp_path, "n bigint, v double")
    query = lambda s: as_of_join_stream(
        s.table("events").where("kind = 'ask'").select("n", "user", "ts"), s.table("events").where("kind = 'set'"), ["user"], "ts", "ts", {"v": "value"}
    ).select("n", "v")
    handle = run(spark, tmp_path, [source(tmp_path, MINUTE), out, Insert("out", query)])
    assert max(r.state_rows for r in handle.metrics().collect()) <= 12


def visits(entries, pause):
    """Per place and user: how often a visit comes after no other for ``pause`` minutes."""
    out = {}
    for place in ("ask", "set"):
        times = {}
        for _, m, u, k, _ in entries:
            if k == place and u is not None:
                times.setdefault(u, set()).add(m)
        new = sum(1 for ms in times.values() for a, b in zip([None, *sorted(ms)], sorted(ms)) if a is None or b - a >= pause)
        out[place] = (sum(k == place for _, _, _, k, _ in entries), new)
    return sorted((k, *v) for k, v in out.items())


def test_visitors_forgotten_by_event_time_in_any_order(spark, tmp_path):
    jitter, pause = 30, 20
    entries = shuffled_feed(tmp_path, 2, 160, jitter)
    out = sink(tmp_path, "kind string, pv bigint, uv bigint", ("kind",))
    query = lambda s: pv_uv_running(
        s.table("events"), "kind", "user", retention=timedelta(minutes=pause), buckets=2, by="ts"
    )
    handle = run(spark, tmp_path, [source(tmp_path, timedelta(minutes=jitter)), out, Insert("out", query, "update")])
    closers = [(-1, 5_000 + n, -1, kind, None) for n in (4, 5) for kind in ("ask", "set")]
    assert rows(read_back(spark, out)) == visits(entries + closers, pause)
    states = [r.state_rows for r in handle.metrics().orderBy("batch_id").collect()]
    assert states[-1] < max(states)  # only the last visitor is left


def test_visitors_of_a_bucket_share_a_value_of_state(spark, tmp_path):
    """A visitor costs no calls to the store: of 300 with a place, buckets keep a value, a time to wake and a timer."""
    for number in range(2):
        add(tmp_path / "in", number, [(n, number * 10 + n % 5, n, "ask", None) for n in range(300)])
    out = sink(tmp_path, "kind string, pv bigint, uv bigint", ("kind",))
    query = lambda s: pv_uv_running(s.table("events"), "kind", "user", retention=HOUR, buckets=1, by="ts")
    handle = run(spark, tmp_path, [source(tmp_path, HOUR), out, Insert("out", query, "update")])
    assert rows(read_back(spark, out)) == [("ask", 600, 300)]
    assert max(r.state_rows for r in handle.metrics().collect()) < 100


def test_retention_by_time_needs_a_stream_and_a_time(spark):
    df = spark.createDataFrame([("a", 1)], "k string, u long")
    with pytest.raises(ValueError):
        pv_uv_running(df, "k", "u", retention=HOUR)
    assert rows(pv_uv_running(df, "k", "u")) == [("a", 1, 1)]


def test_exact_counts_read_the_source_once(spark, data, tmp_path):
    feeds.in_files(tmp_path / "in", feeds.events(data), 3)
    out = sink(tmp_path, "event_type string, pv bigint, uv bigint", ("event_type",))
    handle = run(spark, tmp_path, [
        feeds.source(tmp_path / "in"), out,
        Insert("out", lambda s: pv_uv_running(s.table("events"), "event_type", "user_id"), "update"),
    ])
    assert handle.metrics().agg(F.sum("rows_in")).first()[0] == feeds.events(data).num_rows


def test_late_rows_go_to_a_table_of_their_own(spark, tmp_path):
    late, taken = str(tmp_path / "late"), sink(tmp_path, TEXT)
    events = source(tmp_path, 10 * MINUTE, late=late, late_width=HOUR)
    statements = [events, taken, Insert("out", "SELECT * FROM events")]
    add(tmp_path / "in", 0, [(0, 10, 1, "a", 0.0), (1, 200, 1, "a", 0.0), (2, None, 1, "a", 0.0)])
    add(tmp_path / "in", 1, [(3, 119, 1, "a", 0.0), (4, 185, 1, "a", 0.0), (5, 400, 1, "a", 0.0)])
    run(spark, tmp_path, statements)
    add(tmp_path / "in", 2, [(6, 300, 1, "a", 0.0), (7, 389, 1, "a", 0.0)])
    run(spark, tmp_path, statements)  # the watermark outlives the run
    found = read_batches(spark, late, "parquet", f"{TEXT}, {LATE_BY} double").select("n", LATE_BY)
    assert rows(found) == sorted([(2, None), (3, 71 * 60.0), (6, 90 * 60.0)], key=repr)
    assert [r[0] for r in rows(read_back(spark, taken).select("n"))] == [0, 1, 4, 5, 7]


def test_late_rows_need_a_pass_row_by_row(spark, tmp_path):
    add(tmp_path / "in", 0, [(0, 10, 1, "a", 0.0)])
    out = sink(tmp_path, "kind string, n bigint", ("kind",))
    with pytest.raises(ValueError, match="row by row"):
        run(spark, tmp_path, [
            source(tmp_path, MINUTE, late=str(tmp_path / "late")), out, Insert("out", "SELECT kind, count(*) FROM events GROUP BY kind", "update"),
        ])
    with pytest.raises(ValueError):
        Table("t", TEXT, "parquet", late="x")


def test_a_replayed_batch_finds_its_watermark(spark, tmp_path):
    mark = Watermark(spark, str(tmp_path / "mark"), MINUTE)
    assert mark.before(0) is None
    mark.after(0, None)
    assert mark.before(1) is None
    mark.after(1, 90_000_000)
    for _ in range(2):  # once more, as after a crash
        assert mark.before(2) == 30_000_000
        mark.after(2, 80_000_000)
    assert mark.before(3) == 30_000_000
    with pytest.raises(ValueError):
        mark.before(2 + 10)


def test_split_late_on_a_table(spark):
    df = spark.createDataFrame([(0, None), (1, START), (2, START + HOUR)], "n long, ts timestamp")
    mark = int((START + HOUR / 2).timestamp() * 1_000_000)
    for width, late in ((None, [0, 1]), (HOUR, [0]), (HOUR / 4, [0, 1])):
        in_time, behind = split_late(df, "ts", mark, width)
        assert sorted(r.n for r in behind.collect()) == late and in_time.count() == 3 - len(late)
    in_time, behind = split_late(df, "ts", None)
    assert [r.n for r in behind.collect()] == [0]


def counted(s, aggregate=Count, initial=None, returns=None):
    return aggregate_running(s.table("events"), ["kind"], "value", aggregate(), "n", returns or DoubleType(), initial)


def test_user_aggregates_over_batches_and_a_restart(spark, tmp_path):
    out = sink(tmp_path, "user bigint, mean double", ("user",))
    query = lambda s: aggregate_running(s.table("events"), ["user"], "value", Mean(), "mean", DoubleType())
    draw = random.Random(3)
    entries = [(n, n, draw.choice([1, 1, 2, None]), "a", draw.choice([None, 2.0, 4.0, 8.0])) for n in range(60)]
    for number in range(3):
        add(tmp_path / "in", number, entries[number * 20 : number * 20 + 20])
        run(spark, tmp_path, [source(tmp_path, MINUTE), out, Insert("out", query, "update")])
    wanted = spark.createDataFrame([(e[2], e[4]) for e in entries], "user long, value double").groupBy("user").agg(F.avg("value"))
    assert rows(read_back(spark, out)) == rows(wanted)


def test_many_keys_share_values_of_state(spark, tmp_path):
    out = sink(tmp_path, "user bigint, n double", ("user",))
    query = lambda s: aggregate_running(s.table("events"), ["user"], "value", Count(), "n", DoubleType(), buckets=4)
    for number in range(2):
        add(tmp_path / "in", number, [(n, n, n % 200, "a", 1.0) for n in range(300)])
    handle = run(spark, tmp_path, [source(tmp_path, MINUTE), out, Insert("out", query, "update")])
    assert rows(read_back(spark, out)) == sorted([(u, 4.0 if u < 100 else 2.0) for u in range(200)], key=repr)
    assert max(r.state_rows for r in handle.metrics().collect()) <= 4


def test_a_changed_job_goes_on_with_the_old_counts(spark, tmp_path):
    from pyspark.sql.types import ArrayType

    first, then = sink(tmp_path, "kind string, n double", ("kind",), "first"), sink(tmp_path, "kind string, n array<double>", ("kind",), "then")
    add(tmp_path / "in", 0, [(n, n, 1, "ab"[n % 2], float(n)) for n in range(10)] + [(1, 1, 1, None, 5.0)])
    handle = run(spark, tmp_path, [source(tmp_path, MINUTE), first, Insert("first", counted, "update")])
    savepoint = handle.stop(str(tmp_path / "saved"))
    add(tmp_path / "in", 1, [(20, 20, 1, "a", 1.0), (21, 21, 1, "c", 7.0), (22, 22, 1, None, None)])

    def changed(s):
        old = carried_states(s, s.conf.get("job.savepoint"), "insert-0", lambda n: (n, None))
        return counted(s, CountAndLargest, old, ArrayType(DoubleType()))

    statements = [source(tmp_path, MINUTE), then, Insert("then", changed, "update")]
    settings = {"name": "changed", "restore_from": savepoint, "on_mismatch": "carry_state"}
    run(spark, tmp_path, statements, **settings)
    none = float("-inf")
    assert rows(read_back(spark, then)) == sorted([("a", [6.0, 1.0]), ("c", [1.0, 7.0]), (None, [1.0, none])], key=repr)
    # It goes on as usual from there: neither old files nor old states come twice.
    add(tmp_path / "in", 2, [(30, 30, 1, "a", 9.0), (31, 31, 1, "b", 9.0)])
    run(spark, tmp_path, statements, **settings)
    assert rows(read_back(spark, then).where("kind IN ('a', 'b')")) == [("a", [7.0, 9.0]), ("b", [6.0, 9.0])]


def test_state_is_not_carried_into_a_pass_without_state(spark, tmp_path):
    add(tmp_path / "in", 0, [(0, 0, 1, "a", 1.0)])
    first, out = sink(tmp_path, "kind string, n double", ("kind",), "first"), sink(tmp_path, "n bigint")
    savepoint = run(spark, tmp_path, [source(tmp_path, MINUTE), first, Insert("first", counted, "update")]).stop(str(tmp_path / "saved"))
    with pytest.raises(ValueError, match="with state only"):
        run(spark, tmp_path, [source(tmp_path, MINUTE), out, Insert("out", "SELECT n FROM events")], "other",
            restore_from=savepoint, on_mismatch="carry_state")
