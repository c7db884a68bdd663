"""Page views and unique visitors per key."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.streaming.combine import count_within_task
from tidemark.streaming.retained import first_visits, visits_by_time


def pv_uv(df: DataFrame, key: str, user: str) -> DataFrame:
    """Rows and distinct non-null users per key; batch.

    Spark shuffles (key, user) pairs that were already combined in the map task, so
    one key with most of the rows is spread over its users.
    """
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("pv"), F.countDistinct(user).alias("uv"))


def pv_uv_approx(df: DataFrame, key: str, user: str, rsd: float = 0.05) -> DataFrame:
    """As ``pv_uv`` with a sketch for the users: fixed state per key, batch or stream."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("pv"), F.approx_count_distinct(user, rsd).alias("uv")
    )


def _pairs(df: DataFrame, key: str, user: str) -> DataFrame:
    """Distinct (key, user) with a user; on a stream, each once for ever."""
    known = df.select(key, user).where(F.col(user).isNotNull())
    if df.isStreaming:
        known = count_within_task(known, [key, user], "_n").select(key, user)
    return known.dropDuplicates([key, user])


def uv_running(df: DataFrame, key: str, user: str) -> DataFrame:
    """Exact distinct users per key, kept up to date on a stream (update mode)."""
    return _pairs(df, key, user).groupBy(key).agg(F.count(F.lit(1)).alias("uv"))


def pv_uv_running(
    df: DataFrame,
    key: str,
    user: str,
    retention: timedelta | tuple[timedelta, timedelta] | None = None,
    buckets: int = 64,
    by: str | None = None,
) -> DataFrame:
    """Exact page views and visitors per key, kept up to date on a stream (update mode).

    One pass over the source: one operator holds the visitors of each (key, bucket of users)
    and gives both counts. So no task owns all users of a busy key, and equal pairs are
    combined before the shuffle, so none gets all rows of a busy user.

    With ``retention`` a (key, user) pair that stays silent for that long is
    forgotten, and the user counts as new when coming back: ``uv`` then means
    visitors with pauses shorter than the retention. Given as (least, most), a pair
    is kept for the first and forgotten by the second; the wider apart, the fewer writes.
    Silence is by the wall clock, or with ``by`` by the rows' own times in that column, which
    needs a watermark; then the counts are the same whenever and in whatever order rows
    come. Zero or no retention keeps every pair for ever.
    """
    least, most = retention if isinstance(retention, tuple) else (retention, retention)
    if least is not None and most < least:
        raise ValueError(f"retention of at least {least} and at most {most}")
    if not df.isStreaming:
        if most:
            raise ValueError("retention forgets as a stream goes on, so it needs a stream")
        return pv_uv(df, key, user)
    if by is not None and not most:
        raise ValueError(f"{by} says when visitors are forgotten, so it needs a retention")
    if by is not None:
        steps = visits_by_time(df, key, user, by, most, buckets)
    else:
        steps = first_visits(df, key, user, least, most, buckets)
    return steps.groupBy(key).agg(F.sum("pv").alias("pv"), F.sum("uv").alias("uv"))
