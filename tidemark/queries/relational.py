"""Standard SQL that jobs may use; Spark's own operators throughout.

Money is summed as decimals, which add up the same in any order. Ranking, lag and
running totals work on calendar aggregates: the window sees one row per group and
day or month, however large the tables.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tidemark.functions import UserAggregate, aggregate_by_key, register
from tidemark.functions.tables import Runs
from tidemark.queries.inputs import table


def money(column):
    return F.col(column).cast("decimal(18,2)")


def total(column):
    return F.sum(money(column)).cast("double")


# -- joins -------------------------------------------------------------------


def _orders_and_customers(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    return orders, customers


def _joined(how):
    def query(spark, folder):
        orders, customers = _orders_and_customers(spark, folder)
        orders = orders.where("o_totalprice > 250000")
        customers = customers.where("c_acctbal > 0")
        joined = orders.join(customers, orders["o_custkey"] == customers["c_custkey"], how)
        return joined.select("o_orderkey", "o_custkey", "c_custkey", "c_name")

    return query


def _joined_sql(how):
    return f"""SELECT o_orderkey, o_custkey, c_custkey, c_name
               FROM (SELECT * FROM orders WHERE o_totalprice > 250000)
               {how} JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey"""


def join_star(spark, folder):
    orders, customers = _orders_and_customers(spark, folder)
    nations = table(spark, folder, "nation")
    regions = table(spark, folder, "region")
    return (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy("r_name", "n_name")
        .agg(F.count(F.lit(1)).alias("n"), total("o_totalprice").alias("revenue"))
    )


def join_semi(spark, folder):
    orders, customers = _orders_and_customers(spark, folder)
    large = orders.where("o_totalprice > 400000")
    return customers.join(large, customers["c_custkey"] == large["o_custkey"], "left_semi").select("c_custkey", "c_name")


def join_anti(spark, folder):
    orders, customers = _orders_and_customers(spark, folder)
    large = orders.where("o_totalprice > 400000")
    return customers.join(large, customers["c_custkey"] == large["o_custkey"], "left_anti").select("c_custkey", "c_name")


def join_theta(spark, folder):
    orders, customers = _orders_and_customers(spark, folder)
    covered = (orders["o_custkey"] == customers["c_custkey"]) & (
        orders["o_totalprice"] < customers["c_acctbal"] * 10
    )
    return orders.join(customers, covered).select("o_orderkey", "c_custkey")


def lateral_explode(spark, folder):
    table(spark, folder, "orders").createOrReplaceTempView("orders")
    return spark.sql(
        """SELECT o_orderkey, word FROM orders, LATERAL (SELECT explode(split(o_orderpriority, '-')) AS word)"""
    )


class SplitWords:
    def eval(self, text: str):
        for word in (text or "").split("-"):
            yield (word,)


def lateral_udtf(spark, folder):
    register(spark, "split_words", SplitWords, "table", "word string")
    table(spark, folder, "orders").createOrReplaceTempView("orders")
    return spark.sql("SELECT o_orderkey, word FROM orders, LATERAL split_words(o_orderpriority)")


def lateral_table_udtf(spark, folder):
    """Each user's events on end of one type, by a function that gets the table in order."""
    register(spark, "runs", Runs, "table")
    table(spark, folder, "events").createOrReplaceTempView("events")
    return spark.sql(
        """SELECT * FROM runs(TABLE(SELECT user_id, event_type, ts, event_id FROM events)
                              PARTITION BY user_id ORDER BY (ts, event_id), 'user_id', 'event_type', 'ts')"""
    )


RUNS_SQL = """
    SELECT user_id, event_type, count(*) AS n, min(ts) AS first_at, max(ts) AS last_at
    FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run
          FROM (SELECT *, CASE WHEN row_number() OVER w > 1 AND event_type IS NOT DISTINCT FROM lag(event_type) OVER w
                               THEN 0 ELSE 1 END AS fresh
                FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)))
    GROUP BY user_id, event_type, run"""

LATERAL_SQL = "SELECT o_orderkey, unnest(string_split(o_orderpriority, '-')) AS word FROM orders"

# -- aggregates --------------------------------------------------------------


def agg_basic(spark, folder):
    return (
        table(spark, folder, "lineitem")
        .where("l_shipdate <= timestamp_ntz'2001-01-01'")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            total("l_quantity").alias("quantity"),
            total("l_extendedprice").alias("price"),
            F.round(F.avg(money("l_discount")), 6).cast("double").alias("discount"),
            F.min("l_tax").alias("lowest_tax"),
            F.max("l_tax").alias("highest_tax"),
            F.count(F.lit(1)).alias("n"),
        )
    )


def agg_having(spark, folder):
    totals = table(spark, folder, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), total("o_totalprice").alias("spent")
    )
    return totals.where((F.col("n") > 10) & (F.col("spent") > 3000000))


def agg_global(spark, folder):
    return table(spark, folder, "lineitem").agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("l_orderkey").alias("orders"),
        total("l_extendedprice").alias("price"),
        F.max("l_shipdate").alias("last_shipped"),
    )


def distinct_rows(spark, folder):
    return table(spark, folder, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


def _sets(kind):
    def query(spark, folder):
        orders = table(spark, folder, "orders")
        grouped = getattr(orders, kind)("o_orderstatus", "o_orderpriority")
        return grouped.agg(
            F.grouping_id().cast("long").alias("level"),
            F.count(F.lit(1)).alias("n"),
            total("o_totalprice").alias("revenue"),
        )

    return query


def _sets_sql(kind):
    return f"""SELECT o_orderstatus, o_orderpriority,
                      CAST(grouping(o_orderstatus, o_orderpriority) AS BIGINT) AS level, count(*) AS n,
                      CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
               FROM orders GROUP BY {kind}"""


def grouping_sets(spark, folder):
    orders = table(spark, folder, "orders")
    return orders.groupingSets(
        [[F.col("o_orderstatus")], [F.col("o_orderpriority")]], F.col("o_orderstatus"), F.col("o_orderpriority")
    ).agg(
        F.grouping_id().cast("long").alias("level"),
        F.count(F.lit(1)).alias("n"),
        total("o_totalprice").alias("revenue"),
    )


# -- windows over calendar aggregates ------------------------------------------


def _by_month(spark, folder):
    return (
        table(spark, folder, "orders")
        .groupBy("o_orderpriority", F.trunc("o_orderdate", "month").alias("month"))
        .agg(F.count(F.lit(1)).alias("n"), total("o_totalprice").alias("revenue"))
    )


def rank_window(spark, folder):
    best = Window.partitionBy("o_orderpriority").orderBy(F.desc("n"))
    return _by_month(spark, folder).select(
        "o_orderpriority",
        "month",
        "n",
        F.row_number().over(best.orderBy(F.desc("n"), "month")).cast("long").alias("place"),
        F.rank().over(best).cast("long").alias("rank"),
        F.dense_rank().over(best).cast("long").alias("dense"),
    )


def lag_lead(spark, folder):
    by_month = Window.partitionBy("o_orderpriority").orderBy("month")
    whole = by_month.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return _by_month(spark, folder).select(
        "o_orderpriority",
        "month",
        F.lag("n").over(by_month).alias("before"),
        F.lead("n").over(by_month).alias("after"),
        F.first("n").over(whole).alias("first_n"),
        F.last("n").over(whole).alias("last_n"),
    )


def running_sum(spark, folder):
    days = (
        table(spark, folder, "orders")
        .groupBy("o_orderstatus", F.col("o_orderdate").cast("date").alias("day"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(money("o_totalprice")).alias("revenue"))
    )
    by_day = Window.partitionBy("o_orderstatus").orderBy("day")
    by_number = Window.partitionBy("o_orderstatus").orderBy(F.unix_date("day"))
    return days.select(
        "o_orderstatus",
        "day",
        F.sum("revenue").over(by_day.rowsBetween(Window.unboundedPreceding, 0)).cast("double").alias("so_far"),
        F.sum("n").over(by_day.rowsBetween(-2, 0)).alias("three_rows"),
        F.sum("n").over(by_number.rangeBetween(-6, 0)).alias("week"),
    )


def top_n(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


def top_n_per_group(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    best = Window.partitionBy("o_orderpriority").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return orders.withColumn("place", F.row_number().over(best).cast("long")).where("place <= 3")


# -- sets --------------------------------------------------------------------


def _two_sets(spark, folder):
    lineitem = table(spark, folder, "lineitem")
    returned = lineitem.where("l_returnflag = 'R'").select("l_partkey", "l_suppkey")
    cheap = lineitem.where("l_quantity < 10").select("l_partkey", "l_suppkey")
    return returned, cheap


def union_all(spark, folder):
    returned, cheap = _two_sets(spark, folder)
    return returned.unionByName(cheap)


def union_distinct(spark, folder):
    returned, cheap = _two_sets(spark, folder)
    return returned.unionByName(cheap).distinct()


def intersect_rows(spark, folder):
    returned, cheap = _two_sets(spark, folder)
    return returned.intersect(cheap)


def except_rows(spark, folder):
    returned, cheap = _two_sets(spark, folder)
    return returned.subtract(cheap)


def _set_sql(operator):
    return f"""SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R'
               {operator} SELECT l_partkey, l_suppkey FROM lineitem WHERE l_quantity < 10"""


# -- functions ---------------------------------------------------------------


def string_fns(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey",
        F.lower("c_name").alias("lower_name"),
        F.upper("c_mktsegment").alias("upper_segment"),
        F.substring("c_name", 10, 4).alias("piece"),
        F.concat_ws("/", "c_mktsegment", "c_name").alias("joined"),
        F.regexp_replace("c_name", "0+", "_").alias("squeezed"),
        F.trim(F.concat(F.lit("  "), "c_mktsegment", F.lit(" "))).alias("trimmed"),
        F.length("c_name").cast("long").alias("name_length"),
    )


def date_fns(spark, folder):
    day = F.col("o_orderdate")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.trunc(day, "month").alias("month"),
        F.year(day).cast("long").alias("year"),
        F.quarter(day).cast("long").alias("quarter"),
        F.dayofyear(day).cast("long").alias("day_of_year"),
        F.date_format(day, "yyyy-MM-dd").alias("text"),
        (day + F.expr("INTERVAL 3 DAYS")).alias("later"),
        F.datediff(F.lit("2005-01-01").cast("date"), day.cast("date")).cast("long").alias("days_left"),
    )


def math_fns(spark, folder):
    price = F.col("p_retailprice")
    return table(spark, folder, "part").select(
        "p_partkey",
        F.floor(price).cast("long").alias("whole"),
        F.ceil(price / 7).cast("long").alias("up"),
        F.abs(F.col("p_size") - 25).cast("long").alias("off"),
        F.round(F.pow("p_size", F.lit(2)), 3).alias("square"),
        F.round(F.sqrt(price), 6).alias("root"),
        (F.col("p_partkey") % 7).alias("rest"),
        F.greatest("p_size", F.lit(20)).cast("long").alias("at_least"),
    )


def json_fns(spark, folder):
    events = table(spark, folder, "events")
    packed = F.to_json(F.struct("event_id", "event_type"))
    return events.select(
        "event_id",
        F.get_json_object("props", "$.k").alias("k"),
        F.get_json_object(packed, "$.event_type").alias("kind"),
    )


def array_map_fns(spark, folder):
    words = F.split("p_name", " ")
    return table(spark, folder, "part").select(
        "p_partkey",
        F.size(words).cast("long").alias("words"),
        F.array_join(F.transform(words, F.upper), "+").alias("loud"),
        F.element_at(words, 1).alias("first_word"),
        F.element_at(F.map_from_arrays(F.array(F.lit("size"), F.lit("half")), F.array("p_size", F.floor(F.col("p_size") / 2))), "half")
        .cast("long")
        .alias("half"),
    )


def udf_scalar(spark, folder):
    def taxed_cents(price: pd.Series, tax: pd.Series) -> pd.Series:
        return (price * 100).round().astype("Int64") * (100 + (tax * 100).round().astype("Int64"))

    register(spark, "taxed_cents", taxed_cents, "scalar", "long")
    table(spark, folder, "lineitem").createOrReplaceTempView("lineitem")
    return spark.sql(
        """SELECT l_returnflag, sum(taxed_cents(l_extendedprice, l_tax)) AS price, count(*) AS n
           FROM lineitem GROUP BY l_returnflag"""
    )


class Mean(UserAggregate):
    def start(self):
        return 0.0, 0

    def add(self, state, values):
        return state[0] + float(values.sum()), state[1] + int(values.count())

    def add_each(self, values, groups, count):
        sums = np.bincount(groups, values.fillna(0).astype("float64"), count)
        return list(zip(sums.tolist(), np.bincount(groups[values.notna()], minlength=count).tolist()))

    def merge(self, state, other):
        return state[0] + other[0], state[1] + other[1]

    def finish(self, state):
        return state[0] / state[1] if state[1] else None


def udaf_mean(spark, folder):
    lineitem = table(spark, folder, "lineitem")
    means = aggregate_by_key(lineitem, ["l_suppkey"], "l_quantity", Mean(), "mean", DoubleType())
    return means.withColumn("mean", F.round("mean", 6))


CATALOG = {
    "join_inner": (_joined("inner"), _joined_sql("INNER")),
    "join_left": (_joined("left"), _joined_sql("LEFT")),
    "join_right": (_joined("right"), _joined_sql("RIGHT")),
    "join_full": (_joined("full"), _joined_sql("FULL")),
    "join_star": (
        join_star,
        """SELECT r_name, n_name, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
           FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey
           GROUP BY r_name, n_name""",
    ),
    "join_semi": (
        join_semi,
        """SELECT c_custkey, c_name FROM customer
           WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""",
    ),
    "join_anti": (
        join_anti,
        """SELECT c_custkey, c_name FROM customer
           WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)""",
    ),
    "join_theta": (
        join_theta,
        """SELECT o_orderkey, c_custkey FROM orders JOIN customer
           ON o_custkey = c_custkey AND o_totalprice < c_acctbal * 10""",
    ),
    "lateral_explode": (lateral_explode, LATERAL_SQL),
    "lateral_udtf": (lateral_udtf, LATERAL_SQL),
    "lateral_table_udtf": (lateral_table_udtf, RUNS_SQL),
    "agg_basic": (
        agg_basic,
        """SELECT l_returnflag, l_linestatus,
                  CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity,
                  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price,
                  round(CAST(sum(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) / count(*), 6) AS discount,
                  min(l_tax) AS lowest_tax, max(l_tax) AS highest_tax, count(*) AS n
           FROM lineitem WHERE l_shipdate <= TIMESTAMP '2001-01-01' GROUP BY l_returnflag, l_linestatus""",
    ),
    "agg_having": (
        agg_having,
        """SELECT o_custkey, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spent
           FROM orders GROUP BY o_custkey
           HAVING count(*) > 10 AND sum(CAST(o_totalprice AS DECIMAL(18,2))) > 3000000""",
    ),
    "agg_global": (
        agg_global,
        """SELECT count(*) AS n, count(DISTINCT l_orderkey) AS orders,
                  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price,
                  max(l_shipdate) AS last_shipped
           FROM lineitem""",
    ),
    "distinct_rows": (distinct_rows, "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem"),
    "cube": (_sets("cube"), _sets_sql("CUBE (o_orderstatus, o_orderpriority)")),
    "rollup": (_sets("rollup"), _sets_sql("ROLLUP (o_orderstatus, o_orderpriority)")),
    "grouping_sets": (grouping_sets, _sets_sql("GROUPING SETS ((o_orderstatus), (o_orderpriority))")),
    "rank_window": (
        rank_window,
        """SELECT o_orderpriority, month, n,
                  row_number() OVER (PARTITION BY o_orderpriority ORDER BY n DESC, month) AS place,
                  rank() OVER (PARTITION BY o_orderpriority ORDER BY n DESC) AS rank,
                  dense_rank() OVER (PARTITION BY o_orderpriority ORDER BY n DESC) AS dense
           FROM (SELECT o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n
                 FROM orders GROUP BY ALL)""",
    ),
    "lag_lead": (
        lag_lead,
        """SELECT o_orderpriority, month, lag(n) OVER w AS before, lead(n) OVER w AS after,
                  first_value(n) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS first_n,
                  last_value(n) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_n
           FROM (SELECT o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n
                 FROM orders GROUP BY ALL)
           WINDOW w AS (PARTITION BY o_orderpriority ORDER BY month)""",
    ),
    "running_sum": (
        running_sum,
        """SELECT o_orderstatus, day,
                  CAST(sum(revenue) OVER (w ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS so_far,
                  CAST(sum(n) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS BIGINT) AS three_rows,
                  CAST(sum(n) OVER (w RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW) AS BIGINT) AS week
           FROM (SELECT o_orderstatus, CAST(o_orderdate AS DATE) AS day, count(*) AS n,
                        sum(CAST(o_totalprice AS DECIMAL(18,2))) AS revenue
                 FROM orders GROUP BY ALL)
           WINDOW w AS (PARTITION BY o_orderstatus ORDER BY day)""",
    ),
    "top_n": (
        top_n,
        """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
           ORDER BY o_totalprice DESC, o_orderkey LIMIT 25""",
    ),
    "top_n_per_group": (
        top_n_per_group,
        """SELECT o_orderpriority, o_orderkey, o_totalprice,
                  row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS place
           FROM orders QUALIFY place <= 3""",
    ),
    "union_all": (union_all, _set_sql("UNION ALL")),
    "union_distinct": (union_distinct, _set_sql("UNION")),
    "intersect_rows": (intersect_rows, _set_sql("INTERSECT")),
    "except_rows": (except_rows, _set_sql("EXCEPT")),
    "string_fns": (
        string_fns,
        """SELECT c_custkey, lower(c_name) AS lower_name, upper(c_mktsegment) AS upper_segment,
                  substring(c_name, 10, 4) AS piece, concat_ws('/', c_mktsegment, c_name) AS joined,
                  regexp_replace(c_name, '0+', '_', 'g') AS squeezed,
                  trim('  ' || c_mktsegment || ' ') AS trimmed, length(c_name) AS name_length
           FROM customer""",
    ),
    "date_fns": (
        date_fns,
        """SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
                  extract(year FROM o_orderdate) AS year, extract(quarter FROM o_orderdate) AS quarter,
                  extract(doy FROM o_orderdate) AS day_of_year, strftime(o_orderdate, '%Y-%m-%d') AS text,
                  o_orderdate + INTERVAL 3 DAY AS later,
                  date_diff('day', CAST(o_orderdate AS DATE), DATE '2005-01-01') AS days_left
           FROM orders""",
    ),
    "math_fns": (
        math_fns,
        """SELECT p_partkey, CAST(floor(p_retailprice) AS BIGINT) AS whole,
                  CAST(ceil(p_retailprice / 7) AS BIGINT) AS up, CAST(abs(p_size - 25) AS BIGINT) AS off,
                  round(pow(p_size, 2), 3) AS square, round(sqrt(p_retailprice), 6) AS root,
                  p_partkey % 7 AS rest, CAST(greatest(p_size, 20) AS BIGINT) AS at_least
           FROM part""",
    ),
    "json_fns": (
        json_fns,
        "SELECT event_id, json_extract_string(props, '$.k') AS k, event_type AS kind FROM events",
    ),
    "array_map_fns": (
        array_map_fns,
        """SELECT p_partkey, len(string_split(p_name, ' ')) AS words,
                  array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w)), '+') AS loud,
                  string_split(p_name, ' ')[1] AS first_word, CAST(floor(p_size / 2) AS BIGINT) AS half
           FROM part""",
    ),
    "udf_scalar": (
        udf_scalar,
        """SELECT l_returnflag,
                  CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT) * (100 + CAST(round(l_tax * 100) AS BIGINT)))
                       AS BIGINT) AS price,
                  count(*) AS n
           FROM lineitem GROUP BY l_returnflag""",
    ),
    "udaf_mean": (
        udaf_mean,
        """SELECT l_suppkey, round(CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / count(*), 6) AS mean
           FROM lineitem GROUP BY l_suppkey""",
    ),
}
