"""Join of two feeds within a time bound."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.times import epoch, micros, same_clock, shift, slot


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    before: timedelta,
    after: timedelta,
    take: Mapping[str, str],
) -> DataFrame:
    """Pairs of equal ``keys`` with ``right_time`` in [left_time - before, left_time + after].

    ``take`` maps new column names to columns of ``right``. On streams both sides
    need a watermark on their time column; Spark then drops rows that can no longer
    match.

    Time slots as long as the bound are part of the join key: a left row is in
    one slot, a right row in the two it can reach. A busy key is therefore spread
    over its slots, and a row is compared with its neighbours in time only.
    """
    if before < timedelta(0) or after < timedelta(0):
        raise ValueError("before and after must not be negative")
    if clash := set(take) & set(left.columns):
        raise ValueError(f"columns {sorted(clash)} are already on the left")
    same_clock(left, left_time, right, right_time)
    width = micros(before + after) if before + after else 1_000_000
    keys = list(keys)

    of_left, of_right = epoch(left, left_time), epoch(right, right_time)
    lefts = left.withColumn("_slot", slot(of_left(F.col(left_time)), width))
    first = slot(of_right(F.col(right_time) - shift(after)), width)
    last = slot(of_right(F.col(right_time) + shift(before)), width)
    # The right time goes along once: a stream may have one event time column only.
    brought = dict(take) if right_time in take.values() else {**take, "_at": right_time}
    at = next(new for new, old in brought.items() if old == right_time)
    rights = right.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        *[F.col(old).alias(new) for new, old in brought.items()],
        F.explode(F.sequence(first, last)).alias("_reach"),
    )
    on = reduce(
        lambda a, b: a & b,
        [lefts[k] == rights[f"_k_{k}"] for k in keys],
        (lefts["_slot"] == rights["_reach"])
        & (rights[at] >= lefts[left_time] - shift(before))
        & (rights[at] <= lefts[left_time] + shift(after)),
    )
    return lefts.join(rights, on, "inner").select(
        *[lefts[c] for c in left.columns], *[rights[c] for c in take]
    )
