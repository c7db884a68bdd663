"""The events as streams that come in order of time, or with some rows late."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from tidemark.queries.inputs import EVENTS, table
from tidemark.sources import Table

#: Equal stretches of time that the events come in.
SLICES = 4
LATENESS = timedelta(minutes=1)
INSTANTS = EVENTS.replace("timestamp_ntz", "timestamp")


def sliced(spark, folder, held_back=None):
    """The events with the number of the slice they come in, and the least and greatest time in order.

    Slices are equal stretches of time. Rows for which ``held_back`` holds come after all
    others, and so do rows without a time. One pass finds the bounds; nothing is shuffled.
    """
    events = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    in_order = F.col("ts").isNotNull()
    if held_back is not None:
        in_order &= ~F.coalesce(F.expr(held_back), F.lit(False))
    at = F.unix_micros("ts")
    least, most = events.where(in_order).select(F.min(at), F.max(at)).first()
    least, most = least or 0, most or 0
    number = F.floor((at - least) * SLICES / F.lit(most - least + 1)).cast("int")
    return events.withColumn("slice", F.when(in_order, number).otherwise(SLICES)), least, most


def slice_sql(held_back="false"):
    """SQL: the events with their slice, as ``sliced`` has them."""
    return f"""(
        SELECT *, CASE WHEN ts IS NULL OR {held_back} THEN {SLICES}
                       ELSE CAST(floor((epoch_us(ts) - least) * {SLICES} / (most - least + 1)) AS INT) END AS slice
        FROM events, (SELECT min(epoch_us(ts)) AS least, max(epoch_us(ts)) AS most
                      FROM events WHERE ts IS NOT NULL AND NOT {held_back}) bounds) sliced"""


def add_slices(rows, path, numbers):
    """Write slices into a folder, one after the other, each by as many tasks as hold rows of it."""
    names = [f.split()[0] for f in INSTANTS.split(", ")]
    for number in numbers:
        rows.where(F.col("slice") == number).select(*names).write.mode("append").parquet(path)


def fed_in_order(spark, folder, out):
    """A source that hands on about a slice at a time, the earliest first."""
    rows, _, _ = sliced(spark, folder)
    path = f"{out}/events"
    add_slices(rows, path, range(SLICES + 1))
    files = len(spark.read.schema(INSTANTS).parquet(path).inputFiles())
    return source(path, {"maxFilesPerTrigger": str(max(1, -(-files // (SLICES + 1))))})


def source(path, options=None, name="events", **more):
    """Everything that is there, in one micro-batch of up to a terabyte, unless ``options`` say otherwise."""
    return Table(name, INSTANTS, "parquet", options or {"maxBytesPerTrigger": str(2**40)}, path=path, event_time="ts", lateness=LATENESS, **more)
