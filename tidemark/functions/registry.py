"""Scalar, aggregate and table functions by name.

Each is registered in the session given, so jobs with a session of their own do not
see each other's functions.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import BinaryType, DataType, StructField, StructType

KINDS = ("scalar", "aggregate", "table")
NAN = float("nan")


class UserAggregate:
    """An aggregate in four steps, so that it can run in parts.

    ``add`` takes a column of values as a pandas Series and returns the new state; the
    state must be small and picklable, whatever the number of values.
    """

    def start(self) -> Any:
        raise NotImplementedError

    def add(self, state: Any, values: pd.Series) -> Any:
        raise NotImplementedError

    def add_each(self, values: pd.Series, groups: np.ndarray, count: int) -> Sequence[Any]:
        """The states of ``count`` groups, each of its own values alone; ``groups`` has the group of each value.

        One ``add`` for each group. Where groups are many and small that call is most of the work:
        override this with sums over all groups at once.
        """
        order = np.argsort(groups, kind="stable")
        ends = np.cumsum(np.bincount(groups, minlength=count)).tolist()
        sorted_values = values.iloc[order]
        return [self.add(self.start(), sorted_values.iloc[begin:end]) for begin, end in zip([0, *ends], ends)]

    def merge(self, state: Any, other: Any) -> Any:
        raise NotImplementedError

    def finish(self, state: Any) -> Any:
        raise NotImplementedError


def register(spark: SparkSession, name: str, function: Any, kind: str, returns: str | DataType | None = None) -> None:
    """Make ``function`` callable as ``name`` in SQL.

    ``scalar``: Series in, Series out. ``table``: a class with ``eval`` that yields rows; one
    with ``analyze`` finds its own columns, also from a table argument, and takes no ``returns``.
    ``aggregate``: a ``UserAggregate``; in SQL Spark hands a whole group to one task, so
    keep that for small groups and use ``aggregate_by_key`` elsewhere.
    """
    if returns is None and kind in ("scalar", "aggregate"):
        raise ValueError(f"{name}: what does it return?")
    if kind == "scalar":
        spark.udf.register(name, F.pandas_udf(function, returns))
    elif kind == "aggregate":
        if not isinstance(function, UserAggregate):
            raise ValueError(f"{name}: an aggregate must be a UserAggregate, got {type(function).__name__}")

        def whole(values: pd.Series) -> Any:
            return function.finish(function.add(function.start(), values))

        whole.__annotations__ = {"values": pd.Series, "return": float}
        spark.udf.register(name, F.pandas_udf(whole, returns))
    elif kind == "table":
        if (returns is None) != hasattr(function, "analyze"):
            raise ValueError(f"{name}: a table function has either a schema or its own `analyze`")
        # Rows go pickled: with Arrow, Spark makes and sends a batch of its own of what each single row gives.
        spark.udtf.register(name, F.udtf(function, returnType=returns, useArrow=False))
    else:
        raise ValueError(f"{name}: unknown kind {kind!r} of {type(function).__name__}; known are {KINDS}")


def partial_states(df: DataFrame, keys: Sequence[str], column: str, aggregate: UserAggregate) -> DataFrame:
    """(keys, ``_state``): every input partition's rows folded to one state per key; batch or stream."""
    keys = list(keys)
    rows = df.select(*keys, F.col(column).alias("_value"))
    key_fields = [df.schema[k] for k in keys]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[tuple, Any] = {}
        for table in gathered(batches):
            for key, state in by_key(table):
                states[key] = aggregate.merge(states[key], state) if key in states else state
            # Hand states on before they fill the worker; they are merged later anyway.
            if len(states) > 100_000:
                yield packed(states)
                states = {}
        yield packed(states)

    def gathered(batches: Iterator[pa.RecordBatch], rows: int = 200_000) -> Iterator[pa.Table]:
        """Fewer, larger tables: each costs one call per key."""
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(len(b) for b in held) >= rows:
                yield pa.Table.from_batches(held)
                held = []
        if held:
            yield pa.Table.from_batches(held)

    def by_key(table: pa.Table) -> Iterator[tuple[tuple, Any]]:
        """A state for each key. Keys stay Arrow values: pandas would turn integers beside a null into floats."""
        codes = pd.DataFrame(
            {i: table.column(k).combine_chunks().dictionary_encode("encode").indices.to_numpy() for i, k in enumerate(keys)}
        )
        groups = codes.groupby(list(codes.columns), sort=False).ngroup().to_numpy()
        count = int(groups.max()) + 1 if len(groups) else 0
        first = np.empty(count, np.int64)
        first[groups[::-1]] = np.arange(len(groups))[::-1]  # what is written last stays: the first row
        found = zip(*[map(plain, table.column(k).take(pa.array(first)).to_pylist()) for k in keys])
        yield from zip(found, aggregate.add_each(table.column("_value").to_pandas(), groups, count))

    def packed(states: dict[tuple, Any]) -> pa.RecordBatch:
        columns = [pa.array([key[i] for key in states], type_) for i, type_ in enumerate(key_types)]
        columns.append(pa.array([pickle.dumps(s) for s in states.values()], pa.binary()))
        return pa.RecordBatch.from_arrays(columns, [*keys, "_state"])

    key_types = [to_arrow_type(f.dataType) for f in key_fields]
    return rows.mapInArrow(fold, StructType([*key_fields, StructField("_state", BinaryType())]))


def aggregate_by_key(
    df: DataFrame, keys: Sequence[str], column: str, aggregate: UserAggregate, name: str, returns: DataType
) -> DataFrame:
    """``aggregate`` of ``column`` per key, in two phases.

    Every input partition first folds its rows to one state per key; only the states
    are shuffled. A busy key then costs one small state per partition. States come sorted by key,
    so a task merges them as they pass and holds one, however many keys and states there are.
    """
    keys = list(keys)
    result_type = to_arrow_type(returns)
    key_types = [to_arrow_type(df.schema[k].dataType) for k in keys]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, state = None, None
        for batch in batches:
            over = []  # keys whose last state has passed
            parts = batch.column("_state").to_pylist()
            for key, part in zip(zip(*[map(plain, batch.column(k).to_pylist()) for k in keys]), parts):
                if key != held:
                    if held is not None:
                        over.append((held, aggregate.finish(state)))
                    held, state = key, aggregate.start()
                state = aggregate.merge(state, pickle.loads(part))
            yield finished(over)
        if held is not None:
            yield finished([(held, aggregate.finish(state))])

    def finished(over: list[tuple[tuple, Any]]) -> pa.RecordBatch:
        columns = [pa.array([key[i] for key, _ in over], type_) for i, type_ in enumerate(key_types)]
        return pa.RecordBatch.from_arrays([*columns, pa.array([value for _, value in over], result_type)], [*keys, name])

    states = partial_states(df, keys, column, aggregate).repartition(*keys).sortWithinPartitions(*keys)
    return states.mapInArrow(merge, StructType([*[df.schema[k] for k in keys], StructField(name, returns)]))


def plain(value: Any) -> Any:
    """One NaN and one zero for all, so that equal keys meet in a dictionary, and beside each other."""
    if not isinstance(value, float):
        return value
    return NAN if value != value else value + 0.0
