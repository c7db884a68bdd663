"""Look at the result of a running stream: snapshots that replace each other, and pages of one of them."""

from __future__ import annotations

import json
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from tidemark import files
from tidemark.plans.preview import check_page
from tidemark.sources import changes
from tidemark.sources.tables import Table, read_back
from tidemark.streaming.handle import FINAL, JobHandle

#: Rows of one range of a snapshot: what a page sorts.
RANGE_ROWS = 1_000_000
#: Snapshots whose pages can still be asked for.
KEPT = 2
RANGE, MARK = "_range", "counts.json"


class Snapshot:
    """A result at one moment, in ranges of its order with the number of rows in each.

    Its rows never change, so its pages hold each row once, however long after each other
    they are asked for. Page ``k`` reads and sorts the ranges that it touches.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, order: Sequence[str]):
        self.number = int(path.rsplit("/", 1)[1])
        self._counts = json.loads(files.read_text(spark, f"{path}/{MARK}"))["counts"]
        self._ends = list(accumulate(self._counts))
        self._spark, self._path, self._schema, self._order = spark, path, schema, order

    @property
    def n_rows(self) -> int:
        return self._ends[-1] if self._ends else 0

    def n_pages(self, size: int) -> int:
        return -(-self.n_rows // size)

    def rows(self) -> DataFrame:
        return self._stored().drop(RANGE)

    def page(self, number: int, size: int) -> DataFrame:
        """Page ``number`` (from 1) in the order of the preview, ties by the other columns."""
        check_page(number, size)
        start, stop = (number - 1) * size, min(number * size, self.n_rows)
        touched = [i for i, end in enumerate(self._ends) if end > start and end - self._counts[i] < stop]
        if not touched:
            return self.rows().limit(0)
        before = self._ends[touched[0]] - self._counts[touched[0]]
        rows = self._stored().where(F.col(RANGE).isin(touched))
        return rows.orderBy(RANGE, *sorting(self._schema, self._order)).offset(start - before).limit(size).drop(RANGE)

    def _stored(self) -> DataFrame:
        schema = StructType([*self._schema.fields]).add(RANGE, "integer")
        return self._spark.read.schema(schema).parquet(f"{self._path}/rows")


def sorting(schema: StructType, order: Sequence[str]) -> list[Column]:
    """The columns to sort by: those given, then all others. Maps have no order and sort as text."""
    types = {f.name: f.dataType for f in schema}
    names = [*order, *(n for n in types if n not in order)]
    return [F.to_json(F.struct(n)) if _has_map(types[n]) else F.col(n) for n in names]


def _has_map(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return _has_map(kind.elementType)
    return isinstance(kind, MapType) or isinstance(kind, StructType) and any(_has_map(f.dataType) for f in kind)


class StreamPreview:
    """A stream that writes its result into a table of its own, and the snapshots taken of that.

    Without keys the result is all rows that came; with keys it is the newest row of each.
    """

    def __init__(self, handle: JobHandle, result: Table, folder: str, order: Sequence[str]):
        unknown = set(order) - set(result.fields.names)
        if unknown:
            raise ValueError(f"the order names {sorted(unknown)}, not among {result.fields.names}")
        self.handle, self.order = handle, list(order)
        self._spark, self._result, self._folder = handle.session, result, f"{folder}/snapshots"

    @property
    def has_ended(self) -> bool:
        """Whether no further snapshot will differ from one taken from now on."""
        return self.handle.status() in FINAL

    def snapshot(self, range_rows: int = RANGE_ROWS) -> Snapshot:
        """What the result is now: a new snapshot, or the newest again if no batch has come since.

        Rows are stored in ranges of the order. Equal rows lie in any of their ranges, by their
        place in the files, so that many of them do not make one range large. Only the number of
        rows of each range comes to the driver. Beyond the ``KEPT`` newest, snapshots go.
        """
        newest = self._numbers()[-1:]
        seen = changes.counted(self._spark, self._result.path)
        if newest and json.loads(files.read_text(self._spark, f"{self._folder}/{newest[0]}/{MARK}"))["seen"] == seen:
            return self.get(newest[0])
        path = f"{self._folder}/{newest[0] + 1 if newest else 1}"
        rows, place = self._now(path)
        parts = max(1, -(-rows.count() // range_rows))
        keys = [*sorting(self._result.fields, self.order), place]
        ranged = rows.repartitionByRange(parts, *keys).select(*self._result.fields.names, F.spark_partition_id().alias(RANGE))
        ranged.write.mode("overwrite").partitionBy(RANGE).parquet(f"{path}/rows")
        found = self._spark.read.schema(f"{RANGE} int").parquet(f"{path}/rows").groupBy(RANGE).count().collect()
        held = {r[RANGE]: r["count"] for r in found}
        note = {"seen": seen, "counts": [held.get(i, 0) for i in range(parts)]}
        files.remove(self._spark, f"{path}/newest")
        files.write_text(self._spark, f"{path}/{MARK}", json.dumps(note))
        for old in self._numbers()[:-KEPT]:
            # First the mark, so that none is listed that lacks some of its rows.
            files.remove(self._spark, f"{self._folder}/{old}/{MARK}")
            files.remove(self._spark, f"{self._folder}/{old}")
        return self.get(int(path.rsplit("/", 1)[1]))

    def get(self, number: int) -> Snapshot:
        """One of the newest snapshots."""
        if number not in self._numbers():
            raise ValueError(f"snapshot {number} is not there; there are {self._numbers()}")
        return Snapshot(self._spark, f"{self._folder}/{number}", self._result.fields, self.order)

    def stop(self) -> None:
        """End the stream; snapshots taken stay."""
        self.handle.cancel()

    def _numbers(self) -> list[int]:
        return sorted(int(m.split("/")[-2]) for m in files.glob(self._spark, f"{self._folder}/*/{MARK}"))

    def _now(self, path: str) -> tuple[DataFrame, Column]:
        """The rows as stored in files, and a column that tells equal ones apart."""
        place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
        if self._result.keys:
            read_back(self._spark, self._result).write.mode("overwrite").parquet(f"{path}/newest")
            return self._spark.read.schema(self._result.fields).parquet(f"{path}/newest"), place
        rows = changes.read_batches(self._spark, self._result.path, self._result.connector, self._result.fields)
        return rows, place if rows.inputFiles() else F.lit(0)
