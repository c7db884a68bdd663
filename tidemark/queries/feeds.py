"""Messages, inserts, views and routing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import align, view, with_route
from tidemark.plans import Insert, Job, View, page
from tidemark.queries.inputs import EVENTS, FEED_SQL, USER_LOG, USER_LOG_SQL, as_user_log, change_feed, table, user_log
from tidemark.session import shared_dir
from tidemark.sources import Table, decode_json, decode_raw, encode_json, encode_raw, read_back
from tidemark.streaming.settings import JobSettings

REST = "unrouted"
ROUTES = {"people": ["dbo.signup"], "sales": ["dbo.purchase"], "traffic": ["dbo.view", "dbo.click"]}


def json_decode(spark, folder):
    events = table(spark, folder, "events").select("event_id", F.col("props").alias("value"))
    parsed = F.from_json("value", "k bigint")
    return events.select("event_id", parsed["k"].alias("k"))


def json_messages(spark, folder):
    stamped = user_log(spark, folder).withColumn("ts", F.col("ts").cast("timestamp"))
    messages = encode_json(stamped, key="user_id")
    return decode_json(messages, USER_LOG).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def bytes_cast(spark, folder):
    events = table(spark, folder, "events")
    return events.select("event_id", F.hex(F.col("event_type").cast("binary")).alias("type_hex"))


def raw_messages(spark, folder):
    feed = change_feed(table(spark, folder, "events"))
    sent = encode_raw(feed.select(F.col("key").cast("binary"), F.col("ums").cast("binary")))
    got = decode_raw(sent, ["messageKey", "message"])
    return got.select(F.hex("messageKey").alias("message_key"), F.hex("message").alias("message"))


def project_insert(spark, folder):
    rows = user_log(spark, folder).select("user_id", "item_id", "category_id", "behavior")
    return align(rows, "visitor string, item string, category string, action string")


def filter_in(spark, folder):
    events = table(spark, folder, "events")
    return events.where(F.col("event_type").isin("view", "purchase")).select("event_id", "event_type")


def view_chain(spark, folder):
    view("user_log", user_log(spark, folder))
    view("buys", spark.sql("SELECT user_id, item_id, category_id, behavior FROM user_log WHERE behavior = 'purchase'"))
    view("items", spark.sql("SELECT category_id, item_id FROM buys"), ["category", "item"])
    return spark.sql("SELECT category, item, count(*) AS n FROM items GROUP BY category, item")


def case_nulls(spark, folder):
    orders = table(spark, folder, "orders")
    price = F.col("o_totalprice")
    return orders.where((price > 1000) & (F.col("o_orderstatus") != "P")).select(
        "o_orderkey",
        F.when(price >= 300000, "high").when(price >= 100000, "middle").otherwise("low").alias("band"),
        F.coalesce(F.nullif(F.col("o_orderstatus"), F.lit("O")), F.lit("open")).alias("status"),
        (F.col("o_orderkey") * 2 + 1).alias("odd"),
    )


def route_by_table(spark, folder):
    feed = change_feed(table(spark, folder, "events"))
    return with_route(feed, "table", ROUTES).select("route", "key", "ums")


def _feed_job(folder, out, streaming):
    sink = "messageKey binary, message binary"
    options = {"maxBytesPerTrigger": str(2**40)} if streaming else {}
    statements = [Table("events", EVENTS, "parquet", options, path=f"{folder}/event[s].parquet")]
    statements.append(View("feed", lambda s: change_feed(s.table("events"))))
    for name, values in ROUTES.items():
        names = ", ".join(f"'{v}'" for v in values)
        statements.append(Table(name, sink, "parquet", path=f"{out}/{name}", role="sink"))
        statements.append(
            Insert(name, f"SELECT cast(key AS binary), cast(ums AS binary) FROM feed WHERE `table` IN ({names})")
        )
    known = ", ".join(f"'{v}'" for values in ROUTES.values() for v in values)
    statements.append(Table(REST, sink, "parquet", path=f"{out}/{REST}", role="sink"))
    rest = f"SELECT cast(key AS binary), cast(ums AS binary) FROM feed WHERE coalesce(`table` NOT IN ({known}), true)"
    statements.append(Insert(REST, rest))
    return Job(JobSettings("feed", streaming=streaming, bounded=True, attached=True), statements)


def _fan_out(spark, folder, streaming):
    job = _feed_job(folder, shared_dir(spark, "feed"), streaming)
    job.run(spark)
    parts = [
        read_back(spark, job.tables[name]).select(
            F.lit(name).alias("sink"),
            F.col("messageKey").cast("string").alias("key"),
            F.col("message").cast("string").alias("ums"),
        )
        for name in [*ROUTES, REST]
    ]
    return reduce(DataFrame.unionAll, parts)


def multi_sink(spark, folder):
    return _fan_out(spark, folder, streaming=False)


def multi_sink_stream(spark, folder):
    return _fan_out(spark, folder, streaming=True)


def preview_page(spark, folder):
    return page(user_log(spark, folder), ["ts", "user_id"], number=3, size=20)


def preview_insert(spark, folder):
    job = Job(
        JobSettings("look", streaming=False),
        [
            Table("events", EVENTS, "parquet", path=f"{folder}/events.parquet"),
            View("user_log", lambda s: as_user_log(s.table("events"))),
            Table("sales", "category_id string, n bigint", "parquet", path="unused", role="sink"),
            Insert(
                "sales",
                "SELECT category_id, count(*) AS n FROM user_log WHERE behavior = 'purchase' GROUP BY category_id",
            ),
        ],
    )
    return job.preview(spark)


_ROUTED = " UNION ALL ".join(
    f"""SELECT '{name}' AS {{label}}, key, ums FROM {FEED_SQL} WHERE "table" IN ({", ".join(f"'{v}'" for v in values)})"""
    for name, values in ROUTES.items()
)
_ROUTED += f""" UNION ALL SELECT '{REST}' AS {{label}}, key, ums FROM {FEED_SQL}
               WHERE "table" NOT IN ('dbo.signup', 'dbo.purchase', 'dbo.view', 'dbo.click')"""

CATALOG = {
    "json_decode": (json_decode, "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"),
    "encode_json_roundtrip": (
        json_messages,
        f"SELECT user_id, item_id, category_id, behavior, ts FROM {USER_LOG_SQL}",
    ),
    "bytes_cast": (bytes_cast, "SELECT event_id, hex(CAST(event_type AS BLOB)) AS type_hex FROM events"),
    "raw_messages": (
        raw_messages,
        f"SELECT hex(CAST(key AS BLOB)) AS message_key, hex(CAST(ums AS BLOB)) AS message FROM {FEED_SQL}",
    ),
    "project_insert": (
        project_insert,
        f"SELECT user_id AS visitor, item_id AS item, category_id AS category, behavior AS action FROM {USER_LOG_SQL}",
    ),
    "filter_in": (
        filter_in,
        "SELECT event_id, event_type FROM events WHERE event_type IN ('view', 'purchase')",
    ),
    "view_chain": (
        view_chain,
        f"""SELECT category_id AS category, item_id AS item, count(*) AS n FROM {USER_LOG_SQL}
            WHERE behavior = 'purchase' GROUP BY 1, 2""",
    ),
    "case_nulls": (
        case_nulls,
        """SELECT o_orderkey,
                  CASE WHEN o_totalprice >= 300000 THEN 'high' WHEN o_totalprice >= 100000 THEN 'middle'
                       ELSE 'low' END AS band,
                  coalesce(nullif(o_orderstatus, 'O'), 'open') AS status,
                  o_orderkey * 2 + 1 AS odd
           FROM orders WHERE o_totalprice > 1000 AND o_orderstatus <> 'P'""",
    ),
    "route_by_table": (route_by_table, _ROUTED.format(label="route")),
    "multi_sink": (multi_sink, _ROUTED.format(label="sink")),
    "multi_sink_stream": (multi_sink_stream, _ROUTED.format(label="sink")),
    "preview_page": (
        preview_page,
        f"""SELECT user_id, item_id, category_id, behavior, ts FROM (
              SELECT *, row_number() OVER (ORDER BY ts, user_id, item_id, category_id, behavior) AS place
              FROM {USER_LOG_SQL}) WHERE place BETWEEN 41 AND 60""",
    ),
    "preview_insert": (
        preview_insert,
        f"""SELECT category_id, count(*) AS n FROM {USER_LOG_SQL}
            WHERE behavior = 'purchase' GROUP BY category_id""",
    ),
}
