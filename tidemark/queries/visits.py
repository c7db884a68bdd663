"""Page views and visitors."""

from __future__ import annotations

from tidemark.operators import latest_per_key, merge_latest, pv_uv, pv_uv_approx
from tidemark.queries.inputs import USER_LOG_SQL, table, user_log

PV_UV_SQL = f"""SELECT category_id, count(*) AS pv, count(DISTINCT user_id) AS uv
FROM {USER_LOG_SQL} GROUP BY category_id"""


def pv_uv_by_category(spark, folder):
    return pv_uv(user_log(spark, folder), "category_id", "user_id")


def approximate(spark, folder):
    return pv_uv_approx(user_log(spark, folder), "category_id", "user_id")


def latest(spark, folder):
    events = table(spark, folder, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return latest_per_key(events, ["user_id"], ["ts", "event_id"])


def upsert_latest(spark, folder):
    """The last thing known of each customer: their orders, then the upsert of their events."""
    orders = table(spark, folder, "orders").selectExpr(
        "o_custkey AS customer", "o_orderkey AS id", "o_orderdate AS moment", "'order' AS kind"
    )
    touched = table(spark, folder, "events").selectExpr(
        "user_id AS customer", "event_id AS id", "ts AS moment", "'event' AS kind"
    )
    return merge_latest(orders, touched, ["customer"], ["moment", "kind", "id"])


CATALOG = {
    "pv_uv_by_category": (pv_uv_by_category, PV_UV_SQL),
    "pv_uv_approx": (approximate, None),
    "latest_per_key": (
        latest,
        """SELECT user_id, event_id, event_type, value, ts FROM events
           QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    ),
    "upsert_latest": (
        upsert_latest,
        """SELECT customer, id, moment, kind FROM (
             SELECT o_custkey AS customer, o_orderkey AS id, o_orderdate AS moment, 'order' AS kind FROM orders
             UNION ALL SELECT user_id, event_id, ts, 'event' FROM events)
           QUALIFY row_number() OVER (PARTITION BY customer ORDER BY moment DESC, kind DESC, id DESC) = 1""",
    ),
}
