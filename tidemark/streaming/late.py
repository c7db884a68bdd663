"""Late rows as data: set apart before an operator with state would drop them."""

from __future__ import annotations

import json
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import files
from tidemark.operators.times import epoch, slot

#: Columns of the side table beside the rows' own: how far behind the watermark, null for rows without a time.
LATE_BY = "late_by_seconds"


class Watermark:
    """The watermark of a pass, batch by batch, kept in a folder of its checkpoint.

    A batch is judged by what came before it, and what it adds counts from the next one on. The
    note of a batch is found again when the batch is replayed, so the same rows are late.
    """

    def __init__(self, spark: SparkSession, folder: str, lateness: timedelta):
        self.spark, self.folder, self.lateness = spark, folder, lateness

    def _note(self, batch_id: int) -> str:
        return f"{self.folder}/{batch_id % 10}.json"  # the last ten stay, for replays

    def before(self, batch_id: int) -> int | None:
        """Microseconds since the epoch; None before the first row with a time."""
        path = self._note(batch_id - 1)
        if batch_id == 0 or not files.exists(self.spark, path):
            return None
        held = json.loads(files.read_text(self.spark, path))
        if held["batch"] != batch_id - 1:
            raise ValueError(f"{path} is of batch {held['batch']}, not of {batch_id - 1}")
        newest = held["newest"]
        return None if newest is None else newest - self.lateness // timedelta(microseconds=1)

    def after(self, batch_id: int, newest: int | None) -> None:
        before = self.before(batch_id)
        known = None if before is None else before + self.lateness // timedelta(microseconds=1)
        held = max((t for t in (newest, known) if t is not None), default=None)
        files.write_text(self.spark, self._note(batch_id), json.dumps({"batch": batch_id, "newest": held}))


def split_late(rows: DataFrame, time: str, watermark: int | None, width: timedelta | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows in time, and the others with ``late_by_seconds``.

    A row is late if its time is at or behind the watermark, or, with ``width``, if the end of its
    window of that width is: then no operator has that window any more. Rows without a time
    belong to no window; they are set apart too, with a null.
    """
    to_micros = epoch(rows, time)
    at = to_micros(F.col(time))
    due = at
    if width is not None:
        size = width // timedelta(microseconds=1)
        due = (slot(at, size) + 1) * size
    known = F.lit(watermark).cast("long")
    late = F.coalesce(due <= known, F.lit(False))
    untimed = F.col(time).isNull()
    by = ((known - at) / 1_000_000).cast("double").alias(LATE_BY)
    return rows.where(~late & ~untimed), rows.where(late | untimed).select("*", by)


def newest_time(rows: DataFrame, time: str) -> int | None:
    return rows.agg(F.max(epoch(rows, time)(F.col(time)))).first()[0]

