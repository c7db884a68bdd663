"""Tables in files, written batch by batch.

Every micro-batch has a folder of its own, ``writer=<run>/batch_id=<n>``, which is
overwritten when the batch is replayed: writing a batch twice is the same as
writing it once. A keyed table is the newest row per key: by the table's own order
columns if it has any, then by run and batch. Run labels begin with their start time.

A run restored from a savepoint has a label of its own and notes beside each sink
which run it goes on from and after which batch. Later batches of that run are then
no longer part of the table: the restored run writes the same rows again.

Folders do not add up for ever. A snapshot folds all batches of its time into one; batches that
the oldest kept snapshot holds are removed, and so are older snapshots. A run can be restored to
any batch that no kept snapshot has, or that only newer ones have.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemark import files
from tidemark.operators.latest import latest_per_key
from tidemark.operators.views import as_schema


def new_writer(job: str) -> str:
    """A label for a new run of a job."""
    return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{job}"


def write_batch(df: DataFrame, path: str, fmt: str, writer: str, batch_id: int) -> int:
    """Returns the bytes of the batch's files."""
    folder = f"{path}/writer={writer}/batch_id={batch_id}"
    df.write.format(fmt).mode("overwrite").save(folder)
    return files.size(df.sparkSession, folder)


def _stamped(schema: StructType | str) -> StructType:
    return StructType([*as_schema(schema).fields]).add("writer", "string").add("batch_id", "long")


def read_batches(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: StructType | str,
    without: Callable[[tuple[str, int]], bool] = lambda place: False,
) -> DataFrame:
    """All rows with ``writer`` and ``batch_id``, of completely written batches that count.

    ``without`` tells of a batch, as (writer, batch), whether a snapshot has it already.
    """
    done = [d for d in _counted(spark, path) if not without(_place(d))]
    if not done:
        return spark.createDataFrame([], _stamped(schema))
    return spark.read.format(fmt).schema(_stamped(schema)).option("basePath", path).load(done)


def note_restore(spark: SparkSession, path: str, writer: str, parent: str, last: int) -> None:
    """From now on ``writer`` goes on from batch ``last`` of ``parent`` (-1: from its start)."""
    files.write_text(spark, f"{path}/_restored/{writer}.json", json.dumps({"parent": parent, "last": last}))


def counted(spark: SparkSession, path: str) -> dict[str, list[int]]:
    """How many batches of each run count, and the last of them."""
    held: dict[str, list[int]] = {}
    for writer, batch in map(_place, _counted(spark, path)):
        n, last = held.get(writer, (0, -1))
        held[writer] = [n + 1, max(last, batch)]
    return held


def _counted(spark: SparkSession, path: str) -> list[str]:
    """Folders of complete batches, but those that a restored run has superseded."""
    ends = _ends(spark, path)
    done = [m.rsplit("/", 1)[0] for m in files.glob(spark, f"{path}/writer=*/batch_id=*/_SUCCESS")]
    places = {d: _place(d) for d in done}
    return [d for d, (writer, batch) in places.items() if writer not in ends or batch <= ends[writer]]


def _ends(spark: SparkSession, path: str) -> dict[str, int]:
    """The last batch that counts of each run that another goes on from."""
    ends: dict[str, int] = {}
    for name in files.glob(spark, f"{path}/_restored/*.json"):
        note = json.loads(files.read_text(spark, name))
        ends[note["parent"]] = min(note["last"], ends.get(note["parent"], note["last"]))
    return ends


def _place(folder: str) -> tuple[str, int]:
    writer, batch = folder.split("/")[-2:]
    return writer.removeprefix("writer="), int(batch.removeprefix("batch_id="))


#: Snapshots of a keyed table that are kept, for readers that have listed them and for restored runs.
SNAPSHOTS_KEPT = 3
REMOVED = "_snapshots/_removed"


def newest_snapshot(spark: SparkSession, path: str) -> str | None:
    """Folder of the newest complete snapshot; their names count up."""
    return next(reversed(_snapshots(spark, path)), None)


def _folded(spark: SparkSession, snapshot: str) -> dict[str, list[list[int]]]:
    return json.loads(files.read_text(spark, f"{snapshot}/folded.json"))


def _holds(folded: Mapping[str, Sequence[Sequence[int]]], place: tuple[str, int]) -> bool:
    return any(first <= place[1] <= last for first, last in folded.get(place[0], ()))


def _snapshots(spark: SparkSession, path: str) -> list[str]:
    """Folders of complete snapshots, the oldest first; their names count up."""
    marks = files.glob(spark, f"{path}/_snapshots/*/folded.json")
    return sorted((m.rsplit("/", 1)[0] for m in marks), key=lambda d: int(d.rsplit("/", 1)[1]))


def _base(spark: SparkSession, path: str) -> tuple[str, dict[str, list[list[int]]]] | None:
    """The newest snapshot that holds no batch which a restored run has superseded, and what it holds."""
    ends = _ends(spark, path)
    found = _snapshots(spark, path)
    for folder in reversed(found):
        folded = _folded(spark, folder)
        if all(spans[-1][1] <= ends.get(writer, spans[-1][1]) for writer, spans in folded.items()):
            return folder, folded
    if found and files.exists(spark, f"{path}/{REMOVED}"):
        raise ValueError(f"{path}: a run was restored to before the oldest snapshot kept, whose batches are gone")
    return None


def _rows(spark: SparkSession, path: str, fmt: str, schema: StructType | str) -> DataFrame:
    """The newest snapshot that counts and all batches that it does not hold."""
    base = _base(spark, path)
    if base is None:
        return read_batches(spark, path, fmt, schema)
    folder, folded = base
    rows = read_batches(spark, path, fmt, schema, without=lambda place: _holds(folded, place))
    return spark.read.format(fmt).schema(_stamped(schema)).load(f"{folder}/rows").unionByName(rows)


def read_keyed(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: StructType | str,
    keys: Sequence[str],
    order: Sequence[str] = (),
) -> DataFrame:
    """Newest row per key: greatest by ``order`` first, then of the last run and batch."""
    newest = latest_per_key(_rows(spark, path, fmt, schema), keys, [*order, "writer", "batch_id"])
    return newest.select(*as_schema(schema).names)


def snapshot(
    spark: SparkSession, path: str, fmt: str, schema: StructType | str, keys: Sequence[str], order: Sequence[str] = ()
) -> None:
    """Fold all batches of now, so that readers skip their folders; remove those folded long ago.

    The snapshot names the batches it holds, so batches that other runs write later count
    whatever their labels. Of two snapshots taken at once under one number the last stays whole.
    """
    base = _base(spark, path)
    held: dict[str, list[list[int]]] = {}
    for writer, batch in map(_place, _counted(spark, path)):
        held.setdefault(writer, []).append([batch, batch])
    folded = _merged(base[1] if base else {}, held)
    newest = latest_per_key(_rows(spark, path, fmt, schema), keys, [*order, "writer", "batch_id"])
    last = newest_snapshot(spark, path)
    target = f"{path}/_snapshots/{int(last.rsplit('/', 1)[1]) + 1 if last else 1}"
    newest.write.format(fmt).mode("overwrite").save(f"{target}/rows")
    files.write_text(spark, f"{target}/folded.json", json.dumps(folded))
    _remove_folded(spark, path)


def _merged(one: Mapping[str, list], other: Mapping[str, list]) -> dict[str, list[list[int]]]:
    """Batches of either, as spans."""
    out: dict[str, list[list[int]]] = {}
    for writer in sorted({*one, *other}):
        for first, last in sorted([*one.get(writer, ()), *other.get(writer, ())]):
            mine = out.setdefault(writer, [])
            if mine and mine[-1][1] >= first - 1:
                mine[-1][1] = max(last, mine[-1][1])
            else:
                mine.append([first, last])
    return out


def _remove_folded(spark: SparkSession, path: str) -> None:
    """Remove snapshots older than those kept, and the batches that the oldest kept one holds."""
    found = _snapshots(spark, path)
    if len(found) < SNAPSHOTS_KEPT:
        return
    oldest = _folded(spark, found[-SNAPSHOTS_KEPT])
    for folder in found[:-SNAPSHOTS_KEPT]:
        files.remove(spark, f"{folder}/folded.json")  # first, so that none is listed that lacks rows
        files.remove(spark, folder)
    for mark in files.glob(spark, f"{path}/writer=*/batch_id=*/_SUCCESS"):
        folder = mark.rsplit("/", 1)[0]
        if _holds(oldest, _place(folder)):
            files.write_text(spark, f"{path}/{REMOVED}", folder)
            files.remove(spark, mark)
            files.remove(spark, folder)
