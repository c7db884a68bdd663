"""The tables the queries read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
USER_LOG = "user_id string, item_id string, category_id string, behavior string, ts timestamp"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def as_user_log(events: DataFrame) -> DataFrame:
    item = F.get_json_object("props", "$.k")
    return events.select(
        F.col("user_id").cast("string").alias("user_id"),
        item.alias("item_id"),
        (item.cast("int") % 10).cast("string").alias("category_id"),
        F.col("event_type").alias("behavior"),
        "ts",
    )


def user_log(spark: SparkSession, folder: str) -> DataFrame:
    return as_user_log(table(spark, folder, "events"))


def change_feed(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").cast("string").alias("key"),
        F.col("props").alias("ums"),
        F.concat(F.lit("dbo."), "event_type").alias("table"),
    )


USER_LOG_SQL = """(
  SELECT CAST(user_id AS VARCHAR) AS user_id,
         json_extract_string(props, '$.k') AS item_id,
         CAST(CAST(json_extract_string(props, '$.k') AS INT) % 10 AS VARCHAR) AS category_id,
         event_type AS behavior,
         ts
  FROM events) user_log"""

FEED_SQL = """(
  SELECT CAST(event_id AS VARCHAR) AS key, props AS ums, 'dbo.' || event_type AS "table"
  FROM events) feed"""
