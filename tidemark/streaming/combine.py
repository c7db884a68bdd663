"""Combining rows before the shuffle of a stream.

A batch aggregate folds equal rows in the map task by itself; Spark's streaming
operators with state do not. Without this, a visitor who causes a third of all
rows would send them all to the one task that holds that visitor's state.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType


def count_within_task(df: DataFrame, columns: Sequence[str], count: str, hold: int = 500_000) -> DataFrame:
    """Rows of ``columns`` with how often each occurred; equal rows of a task become few.

    Only combines, never decides: the same row may still come from several tasks, or
    twice from a task with very many different rows. ``hold`` bounds the rows a task keeps.
    """
    columns = list(columns)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0
        for batch in batches:
            ones = pa.array([1] * batch.num_rows, pa.int64())
            held.append(pa.Table.from_batches([batch]).append_column(count, ones))
            size += batch.num_rows
            if size >= hold:
                folded = combined(held)
                if folded.num_rows > hold // 2:
                    yield from folded.to_batches()
                    held, size = [], 0
                else:
                    held, size = [folded], folded.num_rows
        if held:
            yield from combined(held).to_batches()

    def combined(tables: list[pa.Table]) -> pa.Table:
        grouped = pa.concat_tables(tables).group_by(columns).aggregate([(count, "sum")])
        return grouped.select([*columns, f"{count}_sum"]).rename_columns([*columns, count])

    fields = [*df.select(*columns).schema.fields, StructField(count, LongType())]
    return df.select(*columns).mapInArrow(fold, StructType(fields))
