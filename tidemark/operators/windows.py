"""Time windows.

Every result has ``window_start`` and ``window_end`` (``session_start`` and
``session_end`` for sessions), the keys and the measures. On a stream Spark's own
window expressions keep the state. In batch, sliding windows and sessions first
shrink the rows to small time slots with a map-side aggregation, so that a busy
key costs one row per slot and task, however many rows it has.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.measures import Measures, direct, merged, partial
from tidemark.operators.times import epoch, micros, shift, slot, text


def _bounds(df: DataFrame, column: str, keys: Sequence[str], measures: Measures, label: str) -> DataFrame:
    return df.select(
        F.col(f"{column}.start").alias(f"{label}_start"),
        F.col(f"{column}.end").alias(f"{label}_end"),
        *keys,
        *measures,
    )


def tumble(df: DataFrame, ts: str, width: timedelta, keys: Sequence[str], measures: Measures) -> DataFrame:
    """Fixed windows that do not overlap."""
    grouped = df.groupBy(F.window(ts, text(width)).alias("w"), *keys).agg(*direct(measures))
    return _bounds(grouped, "w", keys, measures, "window")


def slide(
    df: DataFrame, ts: str, width: timedelta, step: timedelta, keys: Sequence[str], measures: Measures
) -> DataFrame:
    """Fixed windows of ``width`` that start every ``step``."""
    if df.isStreaming or micros(width) % micros(step):
        grouped = df.groupBy(F.window(ts, text(width), text(step)).alias("w"), *keys).agg(*direct(measures))
        return _bounds(grouped, "w", keys, measures, "window")
    # One aggregate per step, then each step joins the windows that cover it: the
    # rows themselves are never copied into the overlapping windows.
    count = micros(width) // micros(step)
    panes = df.groupBy(F.window(ts, text(step)).alias("w"), *keys).agg(*partial(measures, df))
    starts = F.array(*[F.col("w.start") - shift(step * i) for i in range(count)])
    return (
        panes.withColumn("window_start", F.explode(starts))
        .groupBy("window_start", *keys)
        .agg(*merged(measures, df))
        .select("window_start", (F.col("window_start") + shift(width)).alias("window_end"), *keys, *measures)
    )


def session(df: DataFrame, ts: str, gap: timedelta, keys: Sequence[str], measures: Measures) -> DataFrame:
    """Runs of rows of a key that are at most ``gap`` apart; the end is the last row plus ``gap``."""
    if df.isStreaming:
        grouped = df.groupBy(F.session_window(ts, text(gap)).alias("w"), *keys).agg(*direct(measures))
        return _bounds(grouped, "w", keys, measures, "session")
    # Rows in one slot of length ``gap`` always share a session, so a key needs at
    # most one row per slot to find where its sessions break.
    to_micros = epoch(df, ts)
    slots = (
        df.where(F.col(ts).isNotNull())
        .groupBy(*keys, slot(to_micros(F.col(ts)), micros(gap)).alias("_slot"))
        .agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"), *partial(measures, df))
    )
    by_key = Window.partitionBy(*keys).orderBy("_slot")
    breaks = F.coalesce(F.col("_first") > F.lag("_last").over(by_key) + shift(gap), F.lit(True))
    numbered = slots.withColumn("_break", breaks.cast("long")).withColumn(
        "_session", F.sum("_break").over(by_key.rowsBetween(Window.unboundedPreceding, 0))
    )
    return (
        numbered.groupBy(*keys, "_session")
        .agg(F.min("_first").alias("session_start"), F.max("_last").alias("_last"), *merged(measures, df))
        .select("session_start", (F.col("_last") + shift(gap)).alias("session_end"), *keys, *measures)
    )


def rate_and_gap(df: DataFrame, ts: str, width: timedelta, keys: Sequence[str]) -> DataFrame:
    """Rows, rows per second, and the silence before each window, per key.

    ``gap_seconds`` runs from the last row of the key's previous non-empty window
    to the first row of this one; it is null for the first window.
    """
    per_window = tumble(
        df, ts, width, keys, {"n": ("count", "*"), "first_ts": ("min", ts), "last_ts": ("max", ts)}
    )
    # At most one row per window and key is left here.
    by_key = Window.partitionBy(*keys).orderBy("window_start")
    silence = F.expr("timestampdiff(MICROSECOND, _before, first_ts)") / F.lit(1e6)
    return (
        per_window.withColumn("_before", F.lag("last_ts").over(by_key))
        .withColumn("rate", F.col("n") / F.lit(width.total_seconds()))
        .withColumn("gap_seconds", silence)
        .select("window_start", *keys, "n", "rate", "gap_seconds")
    )
