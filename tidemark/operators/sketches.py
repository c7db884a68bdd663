"""Visitors in sketches that are stored per window and merged over any set of windows.

Distinct counts of windows do not add up: a user of two days is one visitor of both. A
sketch of the users does add up. It has a fixed size however many users there are, so a
table of sketches stays small beside the rows it stands for, and visitors of a week, of a
month or of several categories are read from it without the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.times import shift, text

#: Sketches have 2 ** LG_SIZE registers, some 4 KB when full; small ones list their users and are exact.
LG_SIZE = 12
#: Bounds are so many standard errors wide.
DEVIATIONS = 4.0


def standard_error(lg_size: int = LG_SIZE) -> float:
    """Relative standard error of the estimate of merged sketches."""
    return 1.04 / 2 ** (lg_size / 2)


def visitor_sketches(
    df: DataFrame, ts: str, width: timedelta, keys: Sequence[str], user: str, lg_size: int = LG_SIZE
) -> DataFrame:
    """(window_start, window_end, keys, ``pv``, ``visitors``): rows and a sketch of the non-null users per window.

    Batch or stream. Sketches are made in the map task, so a busy key costs one sketch per
    task and window. Rows without a time are in no window. On a stream every window is kept
    until the watermark passes it; a keyed table takes the newest state of each.
    """
    grouped = df.groupBy(F.window(ts, text(width)).alias("w"), *keys).agg(
        F.count(F.lit(1)).alias("pv"), F.hll_sketch_agg(user, lg_size).alias("visitors")
    )
    return grouped.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "pv", "visitors")


def merge_visitors(sketches: DataFrame, keys: Sequence[str], lg_size: int = LG_SIZE) -> DataFrame:
    """(keys, ``pv``, ``uv``, ``uv_low``, ``uv_high``) of the windows given, whichever they are.

    ``uv`` is an estimate. The true number lies between the bounds but for one time in some
    16,000; the sketches must have been made with ``lg_size`` or more.
    """
    merged = sketches.groupBy(*keys).agg(
        F.sum("pv").alias("pv"), F.hll_sketch_estimate(F.hll_union_agg("visitors", True)).alias("uv")
    )
    off = DEVIATIONS * standard_error(lg_size)
    return merged.withColumns({"uv_low": F.floor(F.col("uv") / (1 + off)), "uv_high": F.ceil(F.col("uv") / (1 - off))})


def rolling_visitors(
    sketches: DataFrame, width: timedelta, windows: int, keys: Sequence[str], lg_size: int = LG_SIZE
) -> DataFrame:
    """As ``merge_visitors`` for every ``windows`` windows on end, named by the start of the last (``window_start``).

    ``width`` is that of the sketches' windows. A key has a row wherever any of those
    windows has one. Sketches are copied, rows never.
    """
    ends = F.array(*[F.col("window_start") + shift(width * i) for i in range(windows)])
    spread = sketches.withColumn("window_start", F.explode(ends))
    return merge_visitors(spread, ["window_start", *keys], lg_size)
