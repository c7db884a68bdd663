"""Stream jobs over the tables: run to the end of what is there, then read the sink."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from tidemark.operators import interval_join, pv_uv_approx, pv_uv_running, rolling_visitors, slide, tumble, uv_running, visitor_sketches
from tidemark.plans import Insert, Job, View
from tidemark.queries.feed import fed_in_order
from tidemark.queries.inputs import EVENTS, USER_LOG, USER_LOG_SQL, as_user_log, table
from tidemark.queries.timeline import INTERVAL_SQL, MEASURES, SLIDE_SQL, TUMBLE_SQL
from tidemark.queries.visits import PV_UV_SQL
from tidemark.session import shared_dir
from tidemark.sources import Table, encode_json, read_back
from tidemark.sources.changes import read_batches
from tidemark.streaming.settings import JobSettings

HOUR = timedelta(hours=1)
def _events(folder):
    # The table comes in batches of about a terabyte.
    return Table("events", EVENTS, "parquet", {"maxBytesPerTrigger": str(2**40)}, path=f"{folder}/event[s].parquet")


def run_into(spark, folder, name, schema, keys, query, mode="update", feed=None):
    """Run ``query`` over the events as a stream into a sink; returns the sink's rows and the job's handle.

    ``feed`` makes the source from a session, the folder of tables and a new one; by default
    the table is the source.
    """
    out = shared_dir(spark, name)
    source = feed(spark, folder, out) if feed else _events(folder)
    sink = Table("out", schema, "parquet", path=f"{out}/rows", keys=keys, role="sink")
    job = Job(
        JobSettings(name, bounded=True, attached=True, checkpoint=f"{out}/checkpoint"),
        [
            source,
            View("user_log", lambda s: as_user_log(s.table("events"))),
            sink,
            Insert("out", query, mode),
        ],
    )
    handle = job.run(spark)
    return read_back(spark, sink), handle


PV_UV = "category_id string, pv bigint, uv bigint"


def _pv_uv(name, operator):
    def query(spark, folder):
        rows, _ = run_into(
            spark,
            folder,
            name,
            PV_UV,
            ("category_id",),
            lambda s: operator(s.table("user_log"), "category_id", "user_id"),
        )
        return rows

    return query


def uv_stream(spark, folder):
    rows, _ = run_into(
        spark,
        folder,
        "uv",
        "category_id string, uv bigint",
        ("category_id",),
        lambda s: uv_running(s.table("user_log"), "category_id", "user_id"),
    )
    return rows


def _topic(spark, folder, out):
    """The user log as a topic of JSON messages, in files, with one broken message for every hundredth item."""
    log = as_user_log(table(spark, folder, "events")).withColumn("ts", F.col("ts").cast("timestamp"))
    whole = encode_json(log, key="user_id")
    broken = encode_json(log.where("item_id = '0'"), key="user_id").withColumn(
        "value", F.expr("substring(value, 1, 20)")
    )
    whole.unionAll(broken).write.parquet(f"{out}/topic")
    return Table(
        "user_log", USER_LOG, "parquet", {"maxBytesPerTrigger": str(2**40)}, path=f"{out}/topic",
        encoding="json", undecoded=f"{out}/undecoded",
    )


def topic_copy(spark, folder):
    """Four columns of every message that decodes, in the order of the sink."""
    out = shared_dir(spark, "copy")
    sink = Table(
        "copy", "user_id string, item_id string, category_id string, behavior string", "parquet",
        path=f"{out}/rows", role="sink",
    )
    job = Job(
        JobSettings("copy", bounded=True, attached=True, checkpoint=f"{out}/checkpoint"),
        [
            _topic(spark, folder, out),
            sink,
            Insert("copy", "SELECT user_id, item_id, category_id, behavior FROM user_log"),
        ],
    )
    job.run(spark)
    return read_back(spark, sink)


def topic_undecoded(spark, folder):
    """The messages that do not decode, from the side folder of the same job run as a batch."""
    out = shared_dir(spark, "undecoded")
    topic = _topic(spark, folder, out)
    sink = Table("copy", "user_id string", "parquet", path=f"{out}/rows", role="sink")
    Job(
        JobSettings("undecoded", streaming=False), [topic, sink, Insert("copy", "SELECT user_id FROM user_log")]
    ).run(spark)
    return read_batches(spark, topic.undecoded, "parquet", "value string").groupBy("value").count()


WINDOWS = "window_start timestamp, window_end timestamp, event_type string, n bigint, smallest double, largest double"


def _windows(name, operator):
    def query(spark, folder):
        rows, _ = run_into(
            spark,
            folder,
            name,
            WINDOWS,
            ("window_start", "event_type"),
            lambda s: operator(s.table("events").withColumn("ts", F.col("ts").cast("timestamp"))),
        )
        return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})

    return query


def interval_stream(spark, folder):
    def pairs(s):
        events = s.table("events")
        views = events.where("event_type = 'view'").select("user_id", F.col("event_id").alias("view_id"), "ts")
        clicks = events.where("event_type = 'click'").select("user_id", F.col("event_id").alias("click_id"), "ts")
        return interval_join(
            views, clicks, ["user_id"], "ts", "ts", timedelta(0), HOUR, {"click_id": "click_id", "click_ts": "ts"}
        )

    schema = "user_id bigint, view_id bigint, ts timestamp, click_id bigint, click_ts timestamp"
    rows, _ = run_into(spark, folder, "pairs", schema, (), pairs, "append", feed=fed_in_order)
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("ts", "click_ts")})


DAY, DAYS = timedelta(days=1), 7


def visitors_rolling(spark, folder):
    """Visitors of every seven days on end, from sketches that a stream stores per day and category.

    ``within`` tells whether the exact number, counted from the rows, is within the estimate's bounds.
    """
    stored, _ = run_into(
        spark,
        folder,
        "sketches",
        "window_start timestamp, category_id string, pv bigint, visitors binary",
        ("window_start", "category_id"),
        lambda s: visitor_sketches(s.table("user_log"), "ts", DAY, ["category_id"], "user_id").drop("window_end"),
    )
    estimated = rolling_visitors(stored, DAY, DAYS, ["category_id"])
    log = as_user_log(table(spark, folder, "events")).withColumn("ts", F.col("ts").cast("timestamp"))
    days = log.select(F.window("ts", "1 day")["start"].alias("day"), "category_id", "user_id").distinct()
    ends = F.explode(F.array(*[F.col("day") + F.expr(f"INTERVAL {i} DAY") for i in range(DAYS)]))
    exact = days.select(ends.alias("end"), F.col("category_id").alias("category"), "user_id")
    exact = exact.groupBy("end", "category").agg(F.countDistinct("user_id").alias("true_uv"))
    joined = estimated.join(exact, F.expr("window_start = end AND category_id <=> category"))
    return joined.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        "category_id",
        "pv",
        F.expr("true_uv BETWEEN uv_low AND uv_high").alias("within"),
    )


ROLLING_SQL = f"""
    SELECT day + INTERVAL 1 DAY * k AS window_start, category_id, count(*) AS pv, true AS within
    FROM (SELECT time_bucket(INTERVAL 1 DAY, ts) AS day, category_id FROM {USER_LOG_SQL}), range({DAYS}) r(k)
    GROUP BY ALL"""


def job_overview(spark, folder):
    _, handle = run_into(
        spark, folder, "overview", "user_id string, behavior string", (), "SELECT user_id, behavior FROM user_log", "append"
    )
    report = handle.metrics().groupBy("job").agg(F.sum("rows_in").alias("rows_in"), F.sum("late_rows").alias("late_rows"), F.sum("rows_out").alias("rows_out"))
    return report.withColumn("status", F.lit(handle.status()))


CATALOG = {
    "pv_uv_stream_exact": (_pv_uv("pvuv", pv_uv_running), PV_UV_SQL),
    "pv_uv_stream_retained": (
        _pv_uv("pvuv-retained", lambda df, k, u: pv_uv_running(df, k, u, retention=(timedelta(days=1), timedelta(days=2)), buckets=8)),
        PV_UV_SQL,
    ),
    "pv_uv_stream_approx": (_pv_uv("pvuv-approx", pv_uv_approx), None),
    "uv_stream_dedup": (
        uv_stream,
        f"SELECT category_id, count(DISTINCT user_id) AS uv FROM {USER_LOG_SQL} GROUP BY category_id",
    ),
    "tumble_stream": (_windows("tumble", lambda df: tumble(df, "ts", HOUR, ["event_type"], MEASURES)), TUMBLE_SQL),
    "slide_stream": (
        _windows("slide", lambda df: slide(df, "ts", HOUR, timedelta(minutes=15), ["event_type"], MEASURES)),
        SLIDE_SQL,
    ),
    "interval_join_stream": (interval_stream, INTERVAL_SQL),
    "visitors_rolling_stream": (visitors_rolling, ROLLING_SQL),
    "topic_copy_stream": (
        topic_copy,
        f"SELECT user_id, item_id, category_id, behavior FROM {USER_LOG_SQL}",
    ),
    "topic_undecoded": (
        topic_undecoded,
        f"""SELECT substring('{{"user_id":"' || user_id || '","item_id":"0"', 1, 20) AS value, count(*) AS count
            FROM {USER_LOG_SQL} WHERE item_id = '0' GROUP BY 1""",
    ),
    "job_overview": (
        job_overview,
        "SELECT 'overview' AS job, count(*) AS rows_in, 0 AS late_rows, count(*) AS rows_out, 'FINISHED' AS status FROM events",
    ),
}
