"""Declared tables: schema, connector, and how to read and write them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from tidemark.operators.views import align, as_schema
from tidemark.sources import changes, jdbc
from tidemark.sources.messages import decode_json, decode_raw, encode_json, encode_raw, split_undecoded
from tidemark.streaming.late import Watermark, split_late


@dataclass(frozen=True)
class Table:
    """A named table that can be a source, a sink, or both.

    ``connector`` is any Spark format (``kafka``, ``jdbc``, ``parquet`` ...) and
    ``options`` are its options; files also take ``path``. ``encoding`` is ``json`` or
    ``raw`` when the connector carries messages of bytes, else None. ``keys`` make a
    sink an upsert; ``order`` tells the newest of several rows of a key in one batch.
    ``event_time`` and ``lateness`` set a stream's watermark.
    ``undecoded`` is a folder for messages that do not decode; without it the first
    one fails the job. ``late`` is a folder for rows behind the watermark, with
    ``late_by_seconds``, and for rows without a time; inserts then see the others only.
    With ``late_width`` a row is late once its whole window of that width is behind.
    """

    name: str
    schema: StructType | str
    connector: str
    options: Mapping[str, str] = field(default_factory=dict, repr=False)
    path: str | None = None
    encoding: str | None = None
    keys: tuple[str, ...] = ()
    order: tuple[str, ...] = ()
    role: str = "source"
    event_time: str | None = None
    lateness: timedelta = timedelta(0)
    undecoded: str | None = None
    late: str | None = None
    late_width: timedelta | None = None

    def __post_init__(self):
        if self.late is not None and self.event_time is None:
            raise ValueError(f"table {self.name}: only rows with an event time can be late")
        if self.role not in ("source", "sink", "both"):
            raise ValueError(f"table {self.name}: role {self.role!r}")
        if self.encoding not in (None, "json", "raw"):
            raise ValueError(f"table {self.name}: encoding {self.encoding!r}")

    @property
    def fields(self) -> StructType:
        """The columns; needs a session if they were given as text."""
        schema = as_schema(self.schema)
        if not {*self.keys, *self.order} <= set(schema.names):
            raise ValueError(f"table {self.name}: keys {self.keys} or order {self.order} not all in {schema.names}")
        return schema

    @property
    def is_source(self) -> bool:
        return self.role in ("source", "both")

    @property
    def is_sink(self) -> bool:
        return self.role in ("sink", "both")


@dataclass(frozen=True)
class Done:
    """What an earlier run has read: the offsets of a topic as Spark writes them, or (path) of files."""

    offsets: str | None = None
    files: DataFrame | None = None


def json_topic(name: str, schema: StructType | str, topic: str, servers: str, group: str, **more) -> Table:
    """A topic of JSON messages, read from its start."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "kafka.group.id": group,
    }
    return Table(name, schema, "kafka", options, encoding="json", **more)


MESSAGE_SCHEMA = StructType([StructField("key", BinaryType()), StructField("value", BinaryType())])


def read(spark: SparkSession, table: Table, streaming: bool = False, done: Done | None = None) -> DataFrame:
    """The table as a batch or a streaming ``DataFrame``; a stream goes on after what is ``done``."""
    reader = (spark.readStream if streaming else spark.read).format(table.connector).options(**table.options)
    if done is not None and table.connector == "kafka":
        reader = reader.option("startingOffsets", done.offsets)

    def load(fields: StructType | None) -> DataFrame:
        loader = reader if fields is None else reader.schema(fields)
        df = loader.load(table.path) if table.path else loader.load()
        if done is None or table.connector == "kafka":
            return df
        # An address without a host is written with one slash or with three.
        plain = lambda path: F.regexp_replace(path, "^([A-Za-z][A-Za-z0-9+.-]*):///", "$1:/")
        return df.join(done.files, plain(df["_metadata.file_path"]) == plain(done.files["path"]), "left_anti")

    if table.encoding is None:
        df = load(None if table.connector in ("jdbc", "kafka") else table.fields).select(*table.fields.names)
    else:
        df = load(None if table.connector == "kafka" else MESSAGE_SCHEMA)
        if table.encoding == "raw":
            df = decode_raw(df, table.fields.names)
        else:
            df = decode_json(df, table.fields, keep_undecoded=table.undecoded is not None)
    if streaming and table.event_time:
        df = df.withWatermark(table.event_time, f"{table.lateness // timedelta(microseconds=1)} microseconds")
    return df


def good_rows(df: DataFrame, table: Table, writer: str, batch_id: int) -> DataFrame:
    """Write the messages that do not decode to the side folder; return the others."""
    if table.undecoded is None or table.encoding != "json":
        return df
    good, bad = split_undecoded(df)
    changes.write_batch(bad, table.undecoded, "parquet", writer, batch_id)
    return good


def rows_in_time(df: DataFrame, table: Table, writer: str, batch_id: int, watermark: Watermark) -> DataFrame:
    """Write the late and the untimed rows to the side folder; return the others."""
    in_time, late = split_late(df, table.event_time, watermark.before(batch_id), table.late_width)
    changes.write_batch(late, table.late, "parquet", writer, batch_id)
    return in_time


def write(df: DataFrame, table: Table, writer: str, batch_id: int = 0) -> tuple[int, int | None]:
    """Write one batch, rows fitted to the table by position; how many rows, and bytes if it is in files.

    Files, keyed database tables and those with the option ``ledger`` (a table of the batches
    written) take the same batch again without change.
    """
    if not table.is_sink:
        raise ValueError(f"table {table.name} is not a sink")
    rows = align(df, table.fields)
    if table.encoding == "json":
        rows = encode_json(rows, key=table.keys[0] if len(table.keys) == 1 else None)
    elif table.encoding == "raw":
        rows = encode_raw(rows)
    # Rows are counted on their way, in the job that writes them.
    counted = Observation()
    rows = rows.observe(counted, F.count(F.lit(1)).alias("rows"))
    size = None
    if table.connector == "jdbc":
        if table.keys:
            if not jdbc.upsert(rows, table.options, table.keys, table.order, writer, batch_id):
                return 0, None
        elif "ledger" in table.options:
            options = dict(table.options)
            if not jdbc.append_once(rows, options, options.pop("ledger"), writer, batch_id):
                return 0, None
        else:
            jdbc.append(rows, table.options)
    elif table.connector == "kafka":
        options = dict(table.options)
        options.setdefault("topic", options.get("subscribe", ""))
        rows.write.format("kafka").options(**options).save()
    else:
        if table.path is None:
            raise ValueError(f"table {table.name} has no path")
        size = changes.write_batch(rows, table.path, table.connector, writer, batch_id)
    return counted.get["rows"], size


def read_back(spark: SparkSession, table: Table) -> DataFrame:
    """What a sink in files holds now: all rows, or the newest per key."""
    if table.encoding is not None:
        rows = changes.read_batches(spark, table.path, table.connector, MESSAGE_SCHEMA)
        if table.encoding == "raw":
            return decode_raw(rows, table.fields.names)
        return decode_json(rows, table.fields)
    if table.keys:
        return changes.read_keyed(spark, table.path, table.connector, table.fields, table.keys, table.order)
    rows = changes.read_batches(spark, table.path, table.connector, table.fields)
    return rows.select(*table.fields.names)
