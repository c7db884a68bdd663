"""Temporal join: the version of each key that was valid at a row's time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.times import epoch, micros, same_clock, slot


def as_of_join(
    probes: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    probe_time: str,
    history_time: str,
    take: Mapping[str, str],
    how: str = "left",
    slice_width: timedelta = timedelta(hours=1),
) -> DataFrame:
    """Add to each probe the newest version of its key at or before its time.

    ``take`` maps new column names to columns of ``history``. ``how`` is ``left``
    (no version: nulls) or ``inner``. Of versions of one key at the same instant
    the greatest by ``take``'s columns counts. Rows without key or time match nothing.

    Only the distinct (key, instant) pairs of probes and history are matched, so many
    rows at one instant count once. The timeline of a key is cut into slices of
    ``slice_width``; each is handled by itself, with the newest earlier version carried
    in, so the work on a busy key is spread over its slices. The probes then join their
    pairs by equality, where Spark splits skewed partitions itself.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', got {how!r}")
    if clash := set(take) & set(probes.columns):
        raise ValueError(f"columns {sorted(clash)} are already in the probes")
    same_clock(probes, probe_time, history, history_time)
    keys, width = list(keys), micros(slice_width)

    def known(df: DataFrame, columns: Sequence[str]) -> DataFrame:
        return df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))

    to_micros = epoch(probes, probe_time)
    in_slice = slot(to_micros(F.col("_at")), width).alias("_slice")
    # A version is wrapped in a struct, so one whose values are null still counts.
    version = F.struct(*[F.col(old).alias(new) for new, old in take.items()])
    versions = known(history, [*keys, history_time]).select(
        *keys, F.col(history_time).alias("_at"), version.alias("_version"), F.lit(False).alias("_asked")
    )
    no_version = F.lit(None).cast(versions.schema["_version"].dataType).alias("_version")
    asked = known(probes, [*keys, probe_time]).select(
        *keys, F.col(probe_time).alias("_at"), no_version, F.lit(True).alias("_asked")
    )

    # One row per key and instant, combined in the map task: what is valid from then on,
    # if anything, and whether a probe asks for it.
    moments = (
        versions.unionAll(asked)
        .groupBy(*keys, in_slice, "_at")
        .agg(F.max("_asked").alias("_asked"), F.max("_version").alias("_version"))
    )
    # One row per key and slice: the newest version that starts in it.
    started = F.when(F.col("_version").isNotNull(), F.struct("_at", "_version"))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        moments.groupBy(*keys, "_slice")
        .agg(F.max(started).alias("_newest"), F.max("_asked").alias("_wanted"))
        .withColumn("_before", F.last("_newest", ignorenulls=True).over(earlier))
        .where(F.col("_wanted") & F.col("_before").isNotNull())
        .select(*keys, "_slice", "_before._at", F.lit(False).alias("_asked"), "_before._version")
    )
    so_far = (
        Window.partitionBy(*keys, "_slice").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    )
    matched = (
        moments.unionByName(carried)
        .withColumn("_version", F.last("_version", ignorenulls=True).over(so_far))
        .where(F.col("_asked") & F.col("_version").isNotNull())
        .select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_at").alias("_k_at"), "_version")
    )
    on = reduce(
        lambda a, b: a & b,
        [probes[k] == matched[f"_k_{k}"] for k in keys],
        probes[probe_time] == matched["_k_at"],
    )
    return probes.join(matched, on, how).select(
        *[probes[c] for c in probes.columns],
        *[F.col("_version")[new].alias(new) for new in take],
    )
