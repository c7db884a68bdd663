"""Temporal join of two streams: each probe with the version of its key that was valid at its time."""

from __future__ import annotations

import json
import math
import pickle
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DoubleType, FloatType, StructField, StructType

from tidemark.operators.times import epoch, same_clock
from tidemark.streaming.buckets import BUCKETS, bucket
from tidemark.streaming.keys import parsed, written

#: Rows without key or time match nothing; they are dealt into so many shares.
LOOSE_SHARES = 64


class Versions(StatefulProcessor):
    """Per bucket, for each key: the versions a probe may still ask for, and the probes that wait for the watermark.

    Rows at or before the watermark have all come, so probes up to there are answered. Then
    only the newest version up to there, and those after it, can be asked for: the others go.
    A timer wakes a bucket for its earliest waiting probe.
    """

    def __init__(self, fractions: Sequence[bool], inner: bool):
        self.fractions, self.inner = list(fractions), inner

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # One value for all, as each call to the store costs more than what is in it.
        self.held = handle.getValueState("held", "versions_and_waiting_by_key binary")

    def _rank(self, version: str) -> tuple:
        """The order of versions of one instant: as Spark orders their columns, nulls first and NaN last."""
        out = []
        for value, fraction in zip(json.loads(version).values(), self.fractions):
            if value is not None and fraction:
                value = float(value)
                out.append((2, 0) if math.isnan(value) else (1, value))
            else:
                out.append((0, 0) if value is None else (1, value) if isinstance(value, (int, float)) else (1, str(value)))
        return tuple(out)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held, found = self._held(), []
        for chunk in rows:
            # By place: Spark does not always hand on the names.
            for of, at, probe, version in zip(*[chunk.iloc[:, n] for n in (-4, -3, -2, -1)]):
                if version is not None:
                    held.setdefault(of, ([], []))[0].append((int(at), version))
                elif pd.isna(at):
                    found.append((probe, None))
                else:
                    held.setdefault(of, ([], []))[1].append((int(at), probe))
        yield from self._answered(held, timerValues, found)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._answered(self._held(), timerValues, [])

    def _held(self) -> dict[str, tuple[list[tuple[int, str]], list[tuple[int, str]]]]:
        held = self.held.get()
        return pickle.loads(held[0]) if held is not None else {}

    def _answered(self, held, timerValues, found) -> Iterator[pd.DataFrame]:
        known = timerValues.getCurrentWatermarkInMs() * 1000
        left = {of: self._answer(*mine, known, found) for of, mine in held.items()}
        left = {of: mine for of, mine in left.items() if any(mine)}
        if left:
            self.held.update((pickle.dumps(left),))
        elif held:
            self.held.clear()
        if later := [t for _, waiting in left.values() for t, _ in waiting]:  # a timer that is set already stays one
            self.handle.registerTimer(-(-min(later) // 1000))
        if self.inner:
            found = [(p, v) for p, v in found if v is not None]
        if found:
            yield pd.DataFrame(found, columns=["_probe", "_version"], dtype=object)

    def _answer(self, versions, waiting, known, found) -> tuple[list[tuple[int, str]], list[tuple[int, str]]]:
        """Adds the answers for one key to ``found``; what can still be asked for, and what waits."""
        newest: dict[int, str] = {}
        for at, version in versions:
            if at not in newest or self._rank(version) > self._rank(newest[at]):
                newest[at] = version
        order, at = sorted(newest), -1
        for asked, probe in sorted((w for w in waiting if w[0] <= known), key=lambda w: w[0]):
            while at + 1 < len(order) and order[at + 1] <= asked:
                at += 1
            found.append((probe, newest[order[at]] if at >= 0 else None))
        past = sum(t <= known for t in order)
        return [(t, newest[t]) for t in order[max(0, past - 1) :]], [w for w in waiting if w[0] > known]

    def close(self) -> None:
        pass


def as_of_join_stream(
    probes: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    probe_time: str,
    history_time: str,
    take: Mapping[str, str],
    how: str = "left",
    shares: int = 1,
    buckets: int = BUCKETS,
) -> DataFrame:
    """``as_of_join`` where both sides are streams with watermarks (append mode).

    A probe is answered once the watermark, the lesser of both sides', has reached its time,
    so rows may come in any order up to the lateness, on either side. Rows behind the
    watermark are dropped, as by all of Spark's operators. State per key is one version, those
    after the watermark, and the probes after the watermark, in ``buckets`` of keys; a job goes on
    from its checkpoint with the same number of them.

    With ``shares`` the probes of a key are dealt over so many tasks and its versions are
    copied to each: for busy keys with few versions. Keys are equal if they are written alike. Probes without key or time are answered
    at once, with nulls.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', got {how!r}")
    if not (probes.isStreaming and history.isStreaming):
        raise ValueError("both sides must be streams; as_of_join is for tables")
    if clash := set(take) & set(probes.columns):
        raise ValueError(f"columns {sorted(clash)} are already in the probes")
    if shares < 1 or buckets < 1:
        raise ValueError(f"need at least one share and one bucket, got {shares} and {buckets}")
    same_clock(probes, probe_time, history, history_time)
    keys = list(keys)
    taken = StructType([StructField(new, history.schema[old].dataType) for new, old in take.items()])

    def usable(df: DataFrame, time: str):
        return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*keys, time]])

    row = written(probes.columns)
    whole = usable(probes, probe_time)
    share = F.when(whole, F.pmod(F.xxhash64(row), F.lit(shares))).otherwise(F.pmod(F.xxhash64(row), F.lit(LOOSE_SHARES)))
    none = F.lit(None).cast("string")
    key = written([F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    dealt = bucket(key, buckets).alias("_bucket")
    micros = lambda df, time: epoch(df, time)(F.col(time))
    asked = probes.select(
        dealt,
        share.cast("int").alias("_share"),
        F.col(probe_time).alias("_at"),
        key.alias("_key"),
        F.when(whole, micros(probes, probe_time)).alias("_micros"),
        row.alias("_probe"),
        none.alias("_version"),
    )
    versions = history.where(usable(history, history_time)).select(
        dealt,
        F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("_share"),
        F.col(history_time).alias("_at"),
        key.alias("_key"),
        micros(history, history_time).alias("_micros"),
        none.alias("_probe"),
        written([F.col(old).alias(new) for new, old in take.items()]).alias("_version"),
    )
    fractions = [isinstance(f.dataType, (DoubleType, FloatType)) for f in taken.fields]
    found = (
        asked.unionByName(versions)
        .groupBy("_bucket", "_share")
        .transformWithStateInPandas(Versions(fractions, how == "inner"), "_probe string, _version string", "Append", "EventTime")
    )
    found = found.select(parsed("_probe", probes.schema).alias("_row"), parsed("_version", taken).alias("_taken"))
    return found.select("_row.*", *[F.col("_taken")[new].alias(new) for new in take])
