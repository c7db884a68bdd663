"""Moving packed hashes between groups of documents and parts of the hash space.

Each group of documents sends, to every part, one row with the hashes it has there. A part
sees all groups' hashes, so it can tell which occur in several, and answers each group with
those that matter. A group has each hash once however often it occurs in it, so a frequent
passage never makes one part large.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BODY, KEY, parts_for, text_bytes

GROUP = "_group"
#: Bytes of text in one group of documents, and for each part of the hash space.
GROUP_BYTES, PART_BYTES = 8 << 20, 16 << 20
#: A null id counts as larger than all others.
NO_ID = np.iinfo(np.int64).max

LISTS = "part int, source int, kind int, a binary, b binary, c binary"
_SCHEMA = pa.schema([("part", pa.int32()), ("source", pa.int32()), ("kind", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())])


def in_groups(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """Documents dealt into groups by id, and a fitting number of parts.

    All passes over the texts use this same frame; Spark shuffles it once and reuses that.
    """
    spark, size = docs.sparkSession, text_bytes(docs, text_col)
    n = parts_for(spark, size, GROUP_BYTES)
    body = F.coalesce(docs[text_col], F.lit(""))
    key = docs[id_col].cast("long")
    group = F.pmod(F.xxhash64(key, F.octet_length(body)), F.lit(n)).cast("int")
    frame = docs.select(key.alias(KEY), body.alias(BODY), group.alias(GROUP)).repartition(n, GROUP)
    return frame, parts_for(spark, size, PART_BYTES)


def lists(rows: list[tuple]) -> pa.Table:
    """Rows (part, source, kind, a, b, c) of packed arrays; None for an array not needed."""
    columns = list(zip(*rows)) if rows else [()] * 6
    packed = [[None if x is None else x.tobytes() for x in column] for column in columns[3:]]
    return pa.table([pa.array(v, t.type) for v, t in zip([*columns[:3], *packed], _SCHEMA)], schema=_SCHEMA)


def dealt(source: int, kind: int, part: np.ndarray, *arrays: np.ndarray) -> list[tuple]:
    """Rows for :func:`lists`, one for each part; entries must be in order of their parts."""
    if not len(part):
        return []
    cuts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True])))
    rows = []
    for start, end in zip(cuts[:-1], cuts[1:]):
        row = [array[start:end] for array in arrays]
        rows.append((int(part[start]), source, kind, *row, *[None] * (3 - len(row))))
    return rows


def column(table: pa.Table, name: str, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All packed values of a column in a row, and how many each row has."""
    parts = [np.frombuffer(x, kind) if x is not None else np.zeros(0, kind) for x in table.column(name).to_pylist()]
    sizes = np.array([len(p) for p in parts], np.int64)
    return (np.concatenate(parts) if parts else np.zeros(0, kind)), sizes


def of_kind(table: pa.Table, *kinds: int) -> pa.Table:
    wanted = np.isin(table.column("kind").to_numpy(zero_copy_only=False), kinds)
    return table.filter(pa.array(wanted))


def first_pass(frame: DataFrame, use: Callable[[pa.Table], pa.Table], schema: str = LISTS) -> DataFrame:
    return frame.groupBy(GROUP).applyInArrow(use, schema)


def met(sent: DataFrame, use: Callable[[pa.Table], pa.Table]) -> DataFrame:
    """What each part makes of the lists sent to it; ``source`` of its rows names the group to answer."""
    return sent.groupBy("part").applyInArrow(use, LISTS)


def next_pass(frame: DataFrame, answers: DataFrame, use: Callable[[pa.Table, pa.Table], pa.Table], schema: str = LISTS) -> DataFrame:
    """Each group of documents with the answers to it."""
    return frame.groupBy(GROUP).cogroup(answers.groupBy("source")).applyInArrow(use, schema)


def ids(table: pa.Table) -> np.ndarray:
    return table.column(KEY).fill_null(NO_ID).to_numpy()
