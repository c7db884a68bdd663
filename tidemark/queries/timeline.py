"""Joins and windows over time."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from tidemark.operators import as_of_join, interval_join, rate_and_gap, session, slide, tumble
from tidemark.queries.inputs import table

HOUR = timedelta(hours=1)


def _of_type(spark, folder, kind):
    return table(spark, folder, "events").where(F.col("event_type") == kind)


def _as_of(spark, folder, how):
    probes = _of_type(spark, folder, "purchase").select("event_id", "user_id", "ts", "value")
    return as_of_join(
        probes,
        _of_type(spark, folder, "view"),
        ["user_id"],
        "ts",
        "ts",
        {"view_id": "event_id", "view_ts": "ts", "view_value": "value"},
        how=how,
        slice_width=timedelta(days=1),
    )


def asof_left(spark, folder):
    return _as_of(spark, folder, "left")


def asof_inner(spark, folder):
    return _as_of(spark, folder, "inner")


def intervals(spark, folder):
    views = _of_type(spark, folder, "view").select("user_id", F.col("event_id").alias("view_id"), "ts")
    clicks = _of_type(spark, folder, "click").select("user_id", F.col("event_id").alias("click_id"), "ts")
    return interval_join(
        views, clicks, ["user_id"], "ts", "ts", timedelta(0), HOUR, {"click_id": "click_id", "click_ts": "ts"}
    )


MEASURES = {"n": ("count", "*"), "smallest": ("min", "value"), "largest": ("max", "value")}


def tumbling(spark, folder):
    return tumble(table(spark, folder, "events"), "ts", HOUR, ["event_type"], MEASURES)


def sliding(spark, folder):
    return slide(
        table(spark, folder, "events"), "ts", HOUR, timedelta(minutes=15), ["event_type"], MEASURES
    )


def sessions(spark, folder):
    return session(table(spark, folder, "events"), "ts", timedelta(hours=6), ["user_id"], MEASURES)


def rates(spark, folder):
    report = rate_and_gap(table(spark, folder, "events"), "ts", timedelta(days=1), ["event_type"])
    return report.withColumn("rate", F.round("rate", 9)).withColumn("gap_seconds", F.round("gap_seconds", 3))


_ASOF = """SELECT p.event_id, p.user_id, p.ts, p.value,
                  v.event_id AS view_id, v.ts AS view_ts, v.value AS view_value
           FROM (SELECT * FROM events WHERE event_type = 'purchase') p
           ASOF {how} JOIN (SELECT * FROM events WHERE event_type = 'view') v
             ON p.user_id = v.user_id AND p.ts >= v.ts"""
_MEASURES = "count(*) AS n, min(value) AS smallest, max(value) AS largest"

INTERVAL_SQL = """SELECT v.user_id, v.event_id AS view_id, v.ts, c.event_id AS click_id, c.ts AS click_ts
                  FROM events v JOIN events c ON v.user_id = c.user_id
                   AND c.ts BETWEEN v.ts AND v.ts + INTERVAL 1 HOUR
                  WHERE v.event_type = 'view' AND c.event_type = 'click'"""
TUMBLE_SQL = f"""SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
                        time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
                        event_type, {_MEASURES}
                 FROM events GROUP BY ALL"""
SLIDE_SQL = f"""SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, event_type, {_MEASURES}
                FROM (SELECT *, time_bucket(INTERVAL 15 MINUTE, ts) - INTERVAL 15 MINUTE * k AS window_start
                      FROM events, range(4) r(k))
                GROUP BY ALL"""
SESSION_SQL = f"""SELECT min(ts) AS session_start, max(ts) + INTERVAL 6 HOUR AS session_end, user_id, {_MEASURES}
                  FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s
                        FROM (SELECT *, CASE WHEN ts <= lag(ts) OVER (PARTITION BY user_id ORDER BY ts)
                                                        + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh
                              FROM events))
                  GROUP BY user_id, s"""

CATALOG = {
    "asof_join": (asof_left, _ASOF.format(how="LEFT")),
    "asof_join_inner": (asof_inner, _ASOF.format(how="")),
    "interval_join": (intervals, INTERVAL_SQL),
    "tumble": (tumbling, TUMBLE_SQL),
    "slide": (sliding, SLIDE_SQL),
    "session": (sessions, SESSION_SQL),
    "rate_and_gap": (
        rates,
        """SELECT window_start, event_type, n, round(n / 86400.0::DOUBLE, 9) AS rate,
                  round(date_diff('microsecond', lag(last_ts) OVER w, first_ts) / 1e6::DOUBLE, 3) AS gap_seconds
           FROM (SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, event_type, count(*) AS n,
                        min(ts) AS first_ts, max(ts) AS last_ts
                 FROM events GROUP BY ALL)
           WINDOW w AS (PARTITION BY event_type ORDER BY window_start)""",
    ),
}
