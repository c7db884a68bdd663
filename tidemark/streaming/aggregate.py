"""User aggregates on streams, from keyed state that a later job can take over."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DataType, StringType, StructField, StructType

from tidemark.functions.registry import UserAggregate, partial_states
from tidemark.streaming.buckets import BUCKETS, bucket
from tidemark.streaming.keys import parsed, written

STATE = "folded"


class Running(StatefulProcessor):
    """Per bucket the state of each of its keys; gives the results of the keys that rows came of."""

    def __init__(self, aggregate: UserAggregate):
        self.aggregate = aggregate

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.folded = handle.getValueState(STATE, "states binary")

    def _merged(self, rows: Iterator[pd.DataFrame]) -> dict:
        """The states, after the rows, of the keys that have rows."""
        held = self.folded.get()
        states = pickle.loads(held[0]) if held is not None else {}
        came = {}
        for chunk in rows:
            # By place: Spark does not always hand on the names.
            for key, part in zip(chunk.iloc[:, -2], chunk.iloc[:, -1]):
                state = states[key] if key in states else self.aggregate.start()
                came[key] = states[key] = self.aggregate.merge(state, pickle.loads(part))
        self.folded.update((pickle.dumps(states),))
        return came

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self._merged(iter([initialState]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        results = [(k, self.aggregate.finish(state)) for k, state in self._merged(rows).items()]
        yield pd.DataFrame(results, columns=["_key", "_result"], dtype=object)

    def close(self) -> None:
        pass


def aggregate_running(
    df: DataFrame, keys: Sequence[str], column: str, aggregate: UserAggregate, name: str, returns: DataType,
    initial: DataFrame | None = None, buckets: int = BUCKETS,
) -> DataFrame:
    """``aggregate_by_key`` on a stream: the result of every key that a micro-batch has rows of (update mode).

    Each task of a batch folds its rows to one state per key before the shuffle, so a busy key
    costs one small state per task, and one state per key is kept, in ``buckets`` of keys; a job
    goes on from its checkpoint with the same number of them. ``initial`` holds states to
    begin with, (``_key``, ``_state``), as ``carried_states`` reads them from a savepoint: the
    first rows of a key are then added to what an earlier job had. Keys without rows since
    give nothing, as their result is still the earlier one.
    """
    if not df.isStreaming:
        raise ValueError("a running aggregate needs a stream; aggregate_by_key is for tables")
    keys = list(keys)
    fields = StructType([df.schema[k] for k in keys])
    dealt = lambda states: states.select(bucket("_key", buckets).alias("_bucket"), "_key", "_state").groupBy("_bucket")
    states = partial_states(df, keys, column, aggregate).select(written(keys).alias("_key"), "_state")
    begun = None if initial is None else dealt(initial)
    results = dealt(states).transformWithStateInPandas(
        Running(aggregate), StructType([StructField("_key", StringType()), StructField("_result", returns)]), "Update", "None", begun
    )
    return results.select(parsed("_key", fields).alias("_row"), "_result").select("_row.*", F.col("_result").alias(name))


def carried_states(spark: SparkSession, savepoint: str, part: str, change: Callable | None = None) -> DataFrame:
    """(``_key``, ``_state``) of an ``aggregate_running`` in a savepoint, read by Spark's reader of state.

    ``change`` makes the new job's state of the old one's, for an aggregate that has changed.
    It runs in tasks; states never meet in one place.
    """
    stored = spark.read.format("statestore").option("path", f"{savepoint}/{part}").option("stateVarName", STATE).load()

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for held in batch.column(0).to_pylist():
                states = pickle.loads(held)
                packed = [pickle.dumps(state if change is None else change(state)) for state in states.values()]
                yield pa.RecordBatch.from_arrays([pa.array(list(states), pa.string()), pa.array(packed, pa.binary())], ["_key", "_state"])

    return stored.select("value.states").mapInArrow(unpacked, "_key string, _state binary")
