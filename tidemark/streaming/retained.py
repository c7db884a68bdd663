"""First visits from keyed state: kept for ever, or for a time by the clock or by the rows' own times."""

from __future__ import annotations

import pickle
from collections import defaultdict
from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from tidemark.operators.times import epoch
from tidemark.streaming.buckets import bucket
from tidemark.streaming.combine import count_within_task

# Reading all entries of a bucket in bulk beats asking for single ones up to this many
# entries per visitor.
SCAN_RATIO = 30
# Visits by time keep all visitors of a bucket in one value: buckets are this much finer.
FINER = 16


class FirstVisits(StatefulProcessor):
    """Per (place, bucket): how many visits came in, and how many visitors were new.

    State holds when each visitor was last noted. A visit within ``slack`` of that is
    not noted again, which saves most writes; entries live for ``least + slack``, so a
    visitor is kept for ``least`` and forgotten by then. Without ``least`` for ever.
    """

    def __init__(self, least_ms: int | None, slack_ms: int):
        self.least_ms, self.slack_ms = least_ms, slack_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        visitor = StructType([StructField("visitor", StringType())])
        number = StructType([StructField("number", LongType())])
        life = None if self.least_ms is None else self.least_ms + self.slack_ms
        self.noted = handle.getMapState("noted", visitor, number, life)
        self.size = handle.getValueState("size", number)  # about how many entries there are

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        visits, visitors = 0, set()
        for chunk in rows:
            visits += int(chunk["visits"].sum())
            visitors.update(chunk["visitor"].dropna())
        now = 0 if self.least_ms is None else timerValues.getCurrentProcessingTimeInMs()
        size = self.size.get()[0] if self.size.exists() else 0
        known = {}
        if size <= SCAN_RATIO * len(visitors):
            size = 0
            for (visitor,), (noted,) in self.noted.iterator():
                size += 1
                if visitor in visitors:
                    known[visitor] = noted
        else:
            for visitor in visitors:
                if (noted := self.noted.getValue((visitor,))) is not None:
                    known[visitor] = noted[0]
        for visitor in visitors:
            if visitor not in known or (self.least_ms is not None and now - known[visitor] >= self.slack_ms):
                self.noted.updateValue((visitor,), (now,))
        fresh = len(visitors) - len(known)
        self.size.update((size + fresh,))
        yield pd.DataFrame({"place": [key[0]], "pv": [visits], "uv": [fresh]})

    def close(self) -> None:
        pass


class VisitsByTime(StatefulProcessor):
    """Per (place, bucket): how many visits came in, and how many more times a visitor was new, by event time.

    A visitor is new if no earlier visit is nearer than the retention. State holds the stretches
    of a visitor's visits without such a pause that the watermark has not left behind. A row out
    of order may join two stretches, which takes one back: the sums of the steps are right
    in the end whatever the order. A timer for the earliest end removes stretches that no row
    in time can join any more. One value holds the stretches of all visitors of the bucket, as
    each call to the store costs more than what is in it.
    """

    def __init__(self, retention_us: int):
        self.retention = retention_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", StructType([StructField("stretches", BinaryType())]))
        self.wake = handle.getValueState("wake", StructType([StructField("at", LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        visits, times = 0, defaultdict(set)
        for chunk in rows:
            # By place: Spark does not always hand on the names.
            for visitor, at, n in zip(*[chunk.iloc[:, i] for i in (-4, -3, -2)]):
                visits += int(n)
                if visitor is not None and not pd.isna(at):
                    times[visitor].add(int(at))
        if times:
            step, stretches = 0, self._held()
            for visitor, mine in times.items():
                before = stretches.get(visitor, [])
                stretches[visitor] = after = self._joined(before + [[t, t] for t in mine])
                step += len(after) - len(before)
            self.open.update((pickle.dumps(stretches),))
            self._wake_at(min(stretches[visitor][0][1] for visitor in times))
        else:
            step = 0
        yield pd.DataFrame({"place": [key[0]], "pv": [visits], "uv": [step]})

    def _held(self) -> dict[str, list[list[int]]]:
        held = self.open.get()
        return pickle.loads(held[0]) if held is not None else {}

    def _joined(self, stretches: list[list[int]]) -> list[list[int]]:
        out: list[list[int]] = []
        for begin, end in sorted(stretches):
            if out and begin - out[-1][1] < self.retention:
                out[-1][1] = max(out[-1][1], end)
            else:
                out.append([begin, end])
        return out

    def _wake_at(self, end: int) -> None:
        """Once for the earliest end; one timer at a time."""
        at = (end + self.retention) // 1000 + 1
        held = self.wake.get()
        if held is None or at < held[0]:
            if held is not None:
                self.handle.deleteTimer(held[0])
            self.handle.registerTimer(at)
            self.wake.update((at,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        known = timerValues.getCurrentWatermarkInMs() * 1000
        self.wake.clear()
        alive = {v: [s for s in mine if s[1] + self.retention > known] for v, mine in self._held().items()}
        alive = {v: mine for v, mine in alive.items() if mine}
        if alive:
            self.open.update((pickle.dumps(alive),))
            self._wake_at(min(mine[0][1] for mine in alive.values()))
        else:
            self.open.clear()
        yield pd.DataFrame({"place": pd.Series([], dtype=object), "pv": pd.Series([], dtype="int64"), "uv": pd.Series([], dtype="int64")})

    def close(self) -> None:
        pass


STEPS = "place string, pv long, uv long"


def visits_by_time(df: DataFrame, key: str, user: str, time: str, retention: timedelta, buckets: int) -> DataFrame:
    """A stream of steps ``(key, pv, uv)``: a visitor counts again after a pause of ``retention`` or more.

    ``time`` needs a watermark. Rows without a user or a time count as views only.
    """
    at = epoch(df, time)(F.col(time))
    text = df.select(
        F.col(key).cast("string").alias("place"), F.col(user).cast("string").alias("visitor"), at.alias("at"), F.col(time).alias("when")
    )
    rows = count_within_task(text, ["place", "visitor", "at", "when"], "visits")
    rows = rows.select("place", bucket("visitor", buckets * FINER).alias("bucket"), "visitor", "at", "visits", "when")
    steps = rows.groupBy("place", "bucket").transformWithStateInPandas(
        VisitsByTime(retention // timedelta(microseconds=1)),
        outputStructType=StructType.fromDDL(STEPS),
        outputMode="Update",
        timeMode="EventTime",
    )
    return steps.select(F.col("place").cast(df.schema[key].dataType).alias(key), "pv", "uv")


def first_visits(
    df: DataFrame, key: str, user: str, least: timedelta | None, most: timedelta | None, buckets: int
) -> DataFrame:
    """A stream of steps ``(key, pv, uv)`` whose sums are the counts so far, from one pass.

    Needs the RocksDB state store. With an "available now" trigger also set
    ``spark.sql.streaming.noDataMicroBatches.enabled`` to false: a clock-driven
    state asks for one more empty batch for ever.
    """
    text = df.select(F.col(key).cast("string").alias("place"), F.col(user).cast("string").alias("visitor"))
    rows = count_within_task(text, ["place", "visitor"], "visits").withColumn("bucket", bucket("visitor", buckets))
    steps = rows.groupBy("place", "bucket").transformWithStateInPandas(
        FirstVisits(_ms(least), _ms(most - least)) if most else FirstVisits(None, 0),
        outputStructType=StructType.fromDDL(STEPS),
        outputMode="Update",
        timeMode="ProcessingTime" if most else "None",
    )
    return steps.select(F.col("place").cast(df.schema[key].dataType).alias(key), "pv", "uv")


def _ms(time: timedelta) -> int:
    return int(time.total_seconds() * 1000)
