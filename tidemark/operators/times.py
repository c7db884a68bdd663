"""Small helpers for durations and time columns."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def micros(width: timedelta) -> int:
    """The width in microseconds, as fine as Spark's times are."""
    if width <= timedelta(0):
        raise ValueError(f"need a positive width, got {width}")
    return width // timedelta(microseconds=1)


def text(width: timedelta) -> str:
    return f"{micros(width)} microseconds"


def shift(width: timedelta) -> Column:
    """``width`` as an interval column; may be zero or negative."""
    return F.make_dt_interval(secs=F.lit(width.total_seconds()).cast("decimal(18,6)"))


def same_clock(left: DataFrame, left_time: str, right: DataFrame, right_time: str) -> None:
    """Both columns must be instants, or both zone-free times."""
    kinds = dict(left.dtypes)[left_time], dict(right.dtypes)[right_time]
    if kinds[0] != kinds[1] or kinds[0] not in ("timestamp", "timestamp_ntz"):
        raise ValueError(f"need two timestamps of one kind, got {left_time} {kinds[0]} and {right_time} {kinds[1]}")


def epoch(df: DataFrame, column: str) -> Callable[[Column], Column]:
    """A function from a time column of ``df``'s type to microseconds.

    It never decreases as time grows. Zone-free times are counted from their
    calendar fields, so the session time zone has no say in them.
    """
    if dict(df.dtypes)[column] == "timestamp_ntz":
        return lambda c: (
            (F.unix_date(c.cast("date")).cast("long") * 86400 + F.hour(c) * 3600 + F.minute(c) * 60) * 1_000_000
            + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")
        )
    return lambda c: F.unix_micros(c)


def slot(time: Column, width: int) -> Column:
    """The number of the slot of ``width`` microseconds, in whole numbers throughout."""
    return ((time - F.pmod(time, F.lit(width).cast("long"))) / F.lit(width)).cast("long")
