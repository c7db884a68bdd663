"""Stream inputs for tests: the events as files in time order."""

import os
from datetime import timedelta
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq

from tidemark.sources import Table

EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


def events(data, utc=True):
    table = pq.read_table(f"{data}/events.parquet").sort_by("ts")
    if utc:
        at = table.schema.get_field_index("ts")
        stamped = pc.assume_timezone(table["ts"].cast(pa.timestamp("us")), "UTC")
        table = table.set_column(at, "ts", stamped)
    return table


def add_file(folder, table, number):
    """One more input file; later numbers are newer."""
    folder = Path(folder)
    folder.mkdir(parents=True, exist_ok=True)
    hidden, path = folder / f".{number}.tmp", folder / f"part-{number:03d}.parquet"
    pq.write_table(table, hidden)
    os.utime(hidden, (1_700_000_000 + number * 10,) * 2)
    hidden.rename(path)


def slices(table, count):
    size = -(-table.num_rows // count)
    return [table.slice(i * size, size) for i in range(count)]


def in_files(folder, table, count=4, order=None):
    parts = slices(table, count)
    for number, index in enumerate(order or range(count)):
        add_file(folder, parts[index], number)


def source(folder, lateness=None, name="events"):
    options = {"maxFilesPerTrigger": "1"}
    if lateness is None:
        return Table(name, EVENTS, "parquet", options, path=str(folder))
    return Table(name, EVENTS, "parquet", options, path=str(folder), event_time="ts", lateness=lateness)


MINUTE = timedelta(minutes=1)
