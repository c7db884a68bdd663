"""Savepoints: copies of a job's checkpoint folder, taken while nothing writes to it."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark import files
from tidemark.session import shared_dir
from tidemark.sources.tables import Done

WRITER, SEEDING, SEEDED = "writer", "seeding", "seeded"


@dataclass(frozen=True)
class Origin:
    """What a restored run goes on from: the run of the savepoint, and its last batch of each part."""

    savepoint: str
    writer: str
    last: dict[str, int]


def _part_and_rest(name: str) -> tuple[str, str]:
    part, _, rest = name.partition("/")
    return part, rest


def save(spark: SparkSession, checkpoint: str, directory: str | None, job: str) -> str:
    """Copy the checkpoint below ``directory`` (default: the shared folder) and return the copy's name."""
    if directory and directory.strip():
        target = f"{directory.rstrip('/')}/{job}-{_stamp()}"
    else:
        target = shared_dir(spark, f"savepoint-{job}")
    files.copy_tree(spark, checkpoint, target, keep=lambda n: not n.endswith(".tmp"))
    return target


def _stamp() -> str:
    from tidemark.sources.changes import new_writer

    return new_writer("savepoint")


def has_state(spark: SparkSession, savepoint: str, part: str) -> bool:
    return files.exists(spark, f"{savepoint}/{part}/state")


def restore(
    spark: SparkSession, savepoint: str, checkpoint: str, stateful: dict[str, bool], on_mismatch: str
) -> Origin | None:
    """Seed a new checkpoint from a savepoint; returns the run and batches it goes on from.

    A checkpoint that this savepoint has seeded goes on as it is, and None is returned. One
    that was begun otherwise is an error, as the savepoint could not be applied; one that
    was seeded half is seeded again.

    ``stateful`` says for each part of the new job whether it keeps state. State that
    no part can take over is an error, unless ``drop_state`` is given and the part is
    stateless: it then goes on from the offsets. A stateful part cannot start with
    foreign state; give it explicit starting offsets or let it read again.
    """
    if not files.exists(spark, savepoint):
        raise FileNotFoundError(f"no savepoint at {savepoint}")
    dropped = set()
    for folder in files.glob(spark, f"{savepoint}/*/state"):
        part = folder.split("/")[-2]
        if part not in stateful:
            if on_mismatch != "drop_state":
                raise ValueError(f"{part}: the savepoint has state of a part this job does not have")
            dropped.add(part)
    for part, keeps in stateful.items():
        had = has_state(spark, savepoint, part)
        known = files.exists(spark, f"{savepoint}/{part}")
        if keeps and known and not had:
            raise ValueError(f"{part}: keeps state, but the savepoint has none for it")
        if had and not keeps:
            if on_mismatch != "drop_state":
                raise ValueError(f"{part}: the savepoint has state that this job does not use")
            dropped.add(part)

    def keep(name: str) -> bool:
        part, rest = _part_and_rest(name)
        return part not in (WRITER, SEEDING, SEEDED) and not (part in dropped and rest.startswith("state/"))

    mark = f"{checkpoint}/{SEEDED}"
    if files.exists(spark, mark):
        if files.read_text(spark, mark) != savepoint:
            raise ValueError(f"{checkpoint} goes on from another savepoint")
        return None
    begun = f"{checkpoint}/{SEEDING}"
    if files.exists(spark, f"{checkpoint}/{WRITER}") and not files.exists(spark, begun):
        raise ValueError(f"{checkpoint} is a checkpoint already; restore into a new one")
    files.write_text(spark, begun, savepoint)
    files.copy_tree(spark, savepoint, checkpoint, keep)
    last = {part: _last_batch(spark, savepoint, part) for part in stateful}
    return Origin(savepoint, files.read_text(spark, f"{savepoint}/{WRITER}"), last)


def seeded(spark: SparkSession, checkpoint: str, savepoint: str) -> None:
    """Note that the checkpoint is complete and the sinks know of it."""
    files.write_text(spark, f"{checkpoint}/{SEEDED}", savepoint)


def _last_batch(spark: SparkSession, savepoint: str, part: str) -> int:
    names = [p.rsplit("/", 1)[1] for p in files.glob(spark, f"{savepoint}/{part}/commits/*")]
    return max((int(n) for n in names if n.isdigit()), default=-1)


def done(spark: SparkSession, savepoint: str, part: str, source: int, topic: bool) -> Done:
    """What ``part`` had read of its source number ``source`` when the savepoint was taken."""
    last = _last_batch(spark, savepoint, part)
    if last < 0:
        raise ValueError(f"{part}: the savepoint has no finished batch")
    offset = files.read_text(spark, f"{savepoint}/{part}/offsets/{last}").splitlines()[2 + source]
    if topic:
        return Done(offsets=offset)
    # The log of a file source: each file with the number of the offset it came with.
    entries = spark.read.schema("path string, batchId long").json(f"{savepoint}/{part}/sources/{source}/*")
    read = entries.where(F.col("path").isNotNull() & (F.col("batchId") <= json.loads(offset)["logOffset"]))
    return Done(files=read.select("path").distinct())


def origin(spark: SparkSession, savepoint: str) -> Origin:
    """The run of a savepoint and the last batch of each of its parts."""
    if not files.exists(spark, savepoint):
        raise FileNotFoundError(f"no savepoint at {savepoint}")
    parts = [p.split("/")[-2] for p in files.glob(spark, f"{savepoint}/*/commits")]
    return Origin(savepoint, files.read_text(spark, f"{savepoint}/{WRITER}"), {p: _last_batch(spark, savepoint, p) for p in parts})
