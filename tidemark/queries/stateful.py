"""Stream jobs whose state is the point: late rows, versions, expiry, state carried over."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from tidemark.functions.registry import UserAggregate
from tidemark.operators import pv_uv_running, session, tumble
from tidemark.plans import Insert, Job, View
from tidemark.queries.feed import INSTANTS, LATENESS, SLICES, add_slices, slice_sql, sliced, source
from tidemark.queries.inputs import USER_LOG_SQL, as_user_log
from tidemark.queries.timeline import _ASOF, HOUR, MEASURES, SESSION_SQL
from tidemark.session import shared_dir
from tidemark.sources import Table, read_back
from tidemark.sources.changes import read_batches
from tidemark.streaming.aggregate import aggregate_running, carried_states
from tidemark.streaming.asof import as_of_join_stream
from tidemark.streaming.late import LATE_BY
from tidemark.streaming.settings import JobSettings

#: Every seventh event is held back until all others have passed.
HELD_BACK = "event_id % 7 = 0"


def _run(spark, name, out, statements, **settings):
    options = {"bounded": True, "attached": True, "checkpoint": f"{out}/{name}"} | settings
    return Job(JobSettings(name, **options), statements).run(spark)


def _sink(out, schema, keys=(), name="out", role="sink"):
    return Table(name, schema, "parquet", path=f"{out}/{name}", keys=keys, role=role)


def late_rows(spark, folder):
    """Rows of each hour that came in time, and that came late, from a stream with a late tail.

    The first job takes a slice a run and sets late rows apart; the second counts the windows
    of the rows in time, with state. Rows without a time are counted under no hour.
    """
    out = shared_dir(spark, "late")
    rows, _, _ = sliced(spark, folder, HELD_BACK)
    events = source(f"{out}/events", late=f"{out}/late", late_width=HOUR)
    taken = _sink(out, INSTANTS, name="taken", role="sink")
    for number in range(SLICES + 1):
        add_slices(rows, f"{out}/events", [number])
        _run(spark, "set-apart", out, [events, taken, Insert("taken", "SELECT * FROM events")])
    # Batches are folders of their own; the second job reads their files as they come.
    again = source(taken.path, {"recursiveFileLookup": "true", "maxBytesPerTrigger": str(2**40)})
    hours = _sink(out, "hour timestamp, taken bigint", ("hour",), "hours")
    counted = lambda s: tumble(s.table("events"), "ts", HOUR, [], {"taken": ("count", "*")}).select("window_start", "taken")
    _run(spark, "count", out, [again, hours, Insert("hours", counted, "update")])
    late = read_batches(spark, f"{out}/late", "parquet", f"{INSTANTS}, {LATE_BY} double")
    late = late.groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(F.count("*").alias("late"), F.max(LATE_BY).alias("latest"))
    t, x = read_back(spark, hours).alias("t"), late.alias("x")
    return t.join(x, F.expr("t.hour <=> x.hour"), "full").select(
        F.coalesce("t.hour", "x.hour").cast("timestamp_ntz").alias("hour"),
        F.coalesce("taken", F.lit(0)).alias("taken"),
        F.coalesce("late", F.lit(0)).alias("late"),
        F.round("latest", 3).alias("latest"),
    )


LATE_SQL = f"""
    WITH fed AS (SELECT * FROM {slice_sql(HELD_BACK)}),
    newest AS (SELECT slice, max(max(epoch_us(ts))) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
               FROM fed GROUP BY slice),
    judged AS (
        SELECT date_trunc('hour', ts) AS hour, seen - {LATENESS // timedelta(microseconds=1)} AS mark, epoch_us(ts) AS us,
               coalesce(epoch_us(date_trunc('hour', ts)) + 3600000000 <= mark, ts IS NULL) AS late
        FROM fed JOIN newest USING (slice))
    SELECT hour, count(*) FILTER (WHERE NOT late) AS taken, count(*) FILTER (WHERE late) AS late,
           round(max(CAST(mark - us AS DOUBLE) / 1000000) FILTER (WHERE late), 3) AS latest
    FROM judged GROUP BY hour"""

NOBODY = -1


def _closed(spark, path, most, kinds, ahead=(1, 2)):
    """Rows days ahead, so that the watermark passes all others; they are of nobody."""
    for days in ahead:
        at = F.timestamp_micros(F.lit(most + days * 86_400_000_000))
        rows = spark.createDataFrame([(k,) for k in kinds], "event_type string").coalesce(1)
        rows.select(
            F.lit(None).cast("long").alias("event_id"), at.alias("ts"), F.lit(NOBODY).cast("long").alias("user_id"), "event_type",
            F.lit(None).cast("double").alias("value"), F.lit(None).cast("string").alias("props"),
        ).write.mode("append").parquet(path)


def asof_join_stream(spark, folder):
    """Each purchase with the user's newest view by then; both are streams, and run by run a slice comes."""
    out = shared_dir(spark, "asof")
    rows, _, most = sliced(spark, folder)
    schema = "event_id bigint, user_id bigint, ts timestamp, value double, view_id bigint, view_ts timestamp, view_value double"
    pairs = _sink(out, schema)

    def joined(s):
        purchases = s.table("purchases").where("event_type = 'purchase'").select("event_id", "user_id", "ts", "value")
        views = s.table("views").where("event_type = 'view'")
        take = {"view_id": "event_id", "view_ts": "ts", "view_value": "value"}
        return as_of_join_stream(purchases, views, ["user_id"], "ts", "ts", take)

    path = f"{out}/events"
    add_slices(rows, path, range(SLICES + 1))
    files = len(spark.read.schema(INSTANTS).parquet(path).inputFiles())
    each = {"maxFilesPerTrigger": str(max(1, -(-files // (SLICES + 1))))}
    sides = [source(path, each, name) for name in ("purchases", "views")]
    statements = [*sides, pairs, Insert("out", joined)]
    _run(spark, "asof", out, statements)
    # A batch goes by the watermark of those before: the last probes need two more, whatever each takes.
    for days in (1, 2):
        _closed(spark, path, most, ["purchase", "view"], [days])
        _run(spark, "asof", out, statements)
    found = read_back(spark, pairs).where(F.coalesce(F.col("user_id"), F.lit(0)) != NOBODY)
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("ts", "view_ts")})


def session_stream(spark, folder):
    """Each user's sessions, written once they are over; a slice comes with every run of the job."""
    out = shared_dir(spark, "sessions")
    rows, _, most = sliced(spark, folder)
    path = f"{out}/events"
    schema = "session_start timestamp, session_end timestamp, user_id bigint, n bigint, smallest double, largest double"
    closed = _sink(out, schema)
    found = lambda s: session(s.table("events"), "ts", 6 * HOUR, ["user_id"], MEASURES)
    statements = [source(path), closed, Insert("out", found)]
    for number in range(SLICES + 1):
        add_slices(rows, path, [number])
        _run(spark, "sessions", out, statements)
    for days in (1, 2):
        _closed(spark, path, most, ["view"], [days])
        _run(spark, "sessions", out, statements)
    ended = read_back(spark, closed).where(F.coalesce(F.col("user_id"), F.lit(0)) != NOBODY)
    return ended.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")})


PV_UV = "category_id string, pv bigint, uv bigint"
SILENCE = timedelta(days=2)


def pv_uv_stream_forgetting(spark, folder):
    """Views and visitors per category, where a visitor silent for two days counts again."""
    out = shared_dir(spark, "forgetting")
    rows, _, _ = sliced(spark, folder)
    add_slices(rows, f"{out}/events", range(SLICES + 1))
    files = len(spark.read.schema(INSTANTS).parquet(f"{out}/events").inputFiles())
    events = source(f"{out}/events", {"maxFilesPerTrigger": str(max(1, -(-files // (SLICES + 1))))})
    sink = _sink(out, PV_UV, ("category_id",))
    counted = lambda s: pv_uv_running(s.table("user_log"), "category_id", "user_id", retention=SILENCE, buckets=8, by="ts")
    _run(spark, "visits", out, [events, View("user_log", lambda s: as_user_log(s.table("events"))), sink, Insert("out", counted, "update")])
    return read_back(spark, sink)


FORGETTING_SQL = f"""
    SELECT category_id, count(*) AS pv,
           count(*) FILTER (WHERE user_id IS NOT NULL AND ts IS NOT NULL AND (earlier IS NULL OR ts - earlier >= INTERVAL 2 DAY)) AS uv
    FROM (SELECT *, lag(ts) OVER (PARTITION BY category_id, user_id ORDER BY ts) AS earlier FROM {USER_LOG_SQL})
    GROUP BY category_id"""


class MeanOfCents(UserAggregate):
    """The mean of values in hundredths, summed as whole numbers: the same in any order."""

    def start(self):
        return 0, 0

    def add(self, state, values):
        known = values.dropna()
        return state[0] + int((known * 100).round().astype("int64").sum()), state[1] + len(known)

    def add_each(self, values, groups, count):
        groups, known = groups[values.notna()], values.dropna()
        cents = np.zeros(count, np.int64)
        np.add.at(cents, groups, (known * 100).round().astype("int64").to_numpy())
        return list(zip(cents.tolist(), np.bincount(groups, minlength=count).tolist()))

    def merge(self, state, other):
        return state[0] + other[0], state[1] + other[1]

    def finish(self, state):
        return state[0] / (100 * state[1]) if state[1] else None


def udaf_stream(spark, folder):
    """The mean of a user's values by a user aggregate, kept up to date on a stream."""
    out = shared_dir(spark, "means")
    rows, _, _ = sliced(spark, folder)
    events, sink = source(f"{out}/events"), _sink(out, "user_id bigint, mean double", ("user_id",))
    query = lambda s: aggregate_running(s.table("events"), ["user_id"], "value", MeanOfCents(), "mean", DoubleType())
    for numbers in (range(2), range(2, SLICES + 1)):
        add_slices(rows, f"{out}/events", numbers)
        _run(spark, "means", out, [events, sink, Insert("out", query, "update")])
    return read_back(spark, sink)


class Count(UserAggregate):
    """How many values there were."""

    def start(self):
        return 0

    def add(self, state, values):
        return state + int(values.notna().sum())

    def add_each(self, values, groups, count):
        return np.bincount(groups[values.notna()], minlength=count).tolist()

    def merge(self, state, other):
        return state + other

    def finish(self, state):
        return float(state)


class CountAndLargest(UserAggregate):
    """How many values, and the largest that came since this was asked: as text, for one column."""

    def start(self):
        return 0, None

    def add(self, state, values):
        known = values.dropna()
        return self.merge(state, (len(known), float(known.max()) if len(known) else None))

    def add_each(self, values, groups, count):
        groups, known = groups[values.notna()], values.dropna()
        counts, largest = np.bincount(groups, minlength=count), np.full(count, -np.inf)
        np.maximum.at(largest, groups, known.to_numpy())
        return [(n, most if n else None) for n, most in zip(counts.tolist(), largest.tolist())]

    def merge(self, state, other):
        return state[0] + other[0], max((v for v in (state[1], other[1]) if v is not None), default=None)

    def finish(self, state):
        return list(map(float, (state[0], float("-inf") if state[1] is None else state[1])))


#: Slices that the job before the change takes.
EARLIER = 2


def carried_over(spark, folder):
    """A job of counts stops with a savepoint; a changed one goes on with them and adds a measure."""
    out = shared_dir(spark, "carried")
    rows, _, _ = sliced(spark, folder)
    events = source(f"{out}/events")
    first, then = _sink(out, "user_id bigint, n double", ("user_id",), "first"), _sink(out, "user_id bigint, both array<double>", ("user_id",), "then")
    add_slices(rows, f"{out}/events", range(EARLIER))
    counts = lambda s: aggregate_running(s.table("events"), ["user_id"], "value", Count(), "n", DoubleType())
    handle = _run(spark, "counts", out, [events, first, Insert("first", counts, "update")])
    savepoint = handle.stop(f"{out}/savepoints")
    add_slices(rows, f"{out}/events", range(EARLIER, SLICES + 1))

    def changed(s):
        old = carried_states(s, s.conf.get("job.savepoint"), "insert-0", lambda n: (n, None))
        return aggregate_running(s.table("events"), ["user_id"], "value", CountAndLargest(), "both", ArrayType(DoubleType()), old)

    _run(spark, "more", out, [events, then, Insert("then", changed, "update")], restore_from=savepoint, on_mismatch="carry_state")
    a, b = read_back(spark, first).alias("a"), read_back(spark, then).alias("b")
    largest = F.expr("both[1]")
    return a.join(b, F.expr("a.user_id <=> b.user_id"), "full").select(
        F.coalesce("a.user_id", "b.user_id").alias("user_id"),
        F.coalesce(F.expr("both[0]"), "n").cast("long").alias("n"),
        F.when(largest > float("-inf"), largest).alias("largest_since"),
    )


CARRIED_SQL = f"""
    SELECT user_id, count(value) AS n, max(value) FILTER (WHERE slice >= {EARLIER}) AS largest_since
    FROM {slice_sql()} GROUP BY user_id"""


def stopped_and_restored(spark, folder):
    """Views and visitors of a job that stops with a savepoint half way, and of one that is restored from it."""
    out = shared_dir(spark, "restored")
    rows, _, _ = sliced(spark, folder)
    sink = _sink(out, PV_UV, ("category_id",))
    statements = [
        source(f"{out}/events"), View("user_log", lambda s: as_user_log(s.table("events"))), sink,
        Insert("out", lambda s: pv_uv_running(s.table("user_log"), "category_id", "user_id", buckets=8), "update"),
    ]
    add_slices(rows, f"{out}/events", range(2))
    savepoint = _run(spark, "visits", out, statements).stop(f"{out}/savepoints")
    add_slices(rows, f"{out}/events", range(2, SLICES + 1))
    # What the stopped job does after its savepoint does not count.
    _run(spark, "visits", out, statements)
    _run(spark, "visits", out, statements, checkpoint=f"{out}/anew", restore_from=savepoint)
    return read_back(spark, sink)


PAGE = 20


def preview_stream(spark, folder):
    """Events by user as a stream goes on: the first, the middle and the last page of two snapshots.

    Pages of the first are asked for after the second has been taken.
    """
    out = shared_dir(spark, "preview")
    rows, _, _ = sliced(spark, folder)
    found = "SELECT user_id, count(*) AS n, max(event_id) AS latest FROM events GROUP BY user_id"
    job = Job(JobSettings("look", bounded=True, attached=True), [source(f"{out}/events"), found])
    taken = []
    for numbers in (range(2), range(2, SLICES + 1)):
        add_slices(rows, f"{out}/events", numbers)
        taken.append(job.preview_stream(spark, ["n", "latest"], keys=["user_id"], folder=out).snapshot())
    pages = [
        s.page(number, PAGE).select(F.lit(s.number).alias("snapshot"), F.lit(number).alias("page"), "user_id", "n", "latest")
        for s in taken
        for number in sorted({1, s.n_pages(PAGE) // 2 + 1, max(1, s.n_pages(PAGE))})
    ]
    return reduce(DataFrame.unionAll, pages)


PREVIEW_SQL = f"""
    WITH fed AS (SELECT * FROM {slice_sql()}),
    found AS (SELECT snapshot, user_id, count(*) AS n, max(event_id) AS latest
              FROM fed JOIN (VALUES (1, 2), (2, {SLICES + 1})) s(snapshot, upto) ON slice < upto GROUP BY snapshot, user_id),
    placed AS (SELECT *, (row_number() OVER (PARTITION BY snapshot ORDER BY n, latest NULLS FIRST, user_id NULLS FIRST) - 1) // {PAGE} + 1 AS page,
                      (count(*) OVER (PARTITION BY snapshot) + {PAGE - 1}) // {PAGE} AS pages
               FROM found)
    SELECT CAST(snapshot AS INT) AS snapshot, CAST(page AS INT) AS page, user_id, n, latest
    FROM placed WHERE page IN (1, pages // 2 + 1, pages)"""

PV_UV_SQL = f"SELECT category_id, count(*) AS pv, count(DISTINCT user_id) AS uv FROM {USER_LOG_SQL} GROUP BY category_id"

CATALOG = {
    "late_rows": (late_rows, LATE_SQL),
    "session_stream": (session_stream, SESSION_SQL),
    "asof_join_stream": (asof_join_stream, _ASOF.format(how="LEFT")),
    "pv_uv_stream_forgetting": (pv_uv_stream_forgetting, FORGETTING_SQL),
    "udaf_stream": (
        udaf_stream,
        """SELECT user_id, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / (100 * count(value)) AS mean
           FROM events GROUP BY user_id""",
    ),
    "carried_over": (carried_over, CARRIED_SQL),
    "stopped_and_restored": (stopped_and_restored, PV_UV_SQL),
    "preview_stream": (preview_stream, PREVIEW_SQL),
}
