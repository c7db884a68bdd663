"""Settings of a job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import timedelta

CHECKPOINT_INTERVAL = timedelta(minutes=10)  # when the job names none


@dataclass(frozen=True)
class JobSettings:
    """How to run a job.

    ``checkpoint`` is the job's folder for progress and state; by default a new one in
    the shared folder of the session. Each micro-batch is a checkpoint, so
    ``checkpoint_interval`` is the trigger; unset or not positive means ten minutes.
    ``bounded`` processes what is there now and ends. ``restore_from`` names a savepoint;
    ``on_mismatch="drop_state"`` lets a stateless job start from the savepoint of a
    stateful one, from its offsets alone. ``on_mismatch="carry_state"`` starts a changed job
    with new state after what the savepoint's job has read; its queries read the old state
    from ``job.savepoint`` with ``carried_states`` and hand it to their own. ``parallelism`` is the number of shuffle
    partitions; a stream keeps it for the life of its checkpoint. ``catalog`` is made current.
    ``artifacts`` are Python files or archives and jars that only this job sees.
    ``params`` can be read by its functions as ``job.<name>`` settings.
    """

    name: str
    streaming: bool = True
    checkpoint: str | None = None
    checkpoint_interval: timedelta | None = None
    bounded: bool = False
    attached: bool = False
    parallelism: int | None = None
    restore_from: str | None = None
    on_mismatch: str = "fail"
    savepoint_dir: str | None = None
    restarts: int = 3
    restart_delay: timedelta = timedelta(seconds=10)
    catalog: str | None = None
    artifacts: Sequence[str] = ()
    params: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if self.on_mismatch not in ("fail", "drop_state", "carry_state"):
            raise ValueError(f"on_mismatch {self.on_mismatch!r}")

    def trigger(self) -> dict:
        if self.bounded:
            return {"availableNow": True}
        interval = self.checkpoint_interval
        if interval is None or interval <= timedelta(0):
            interval = CHECKPOINT_INTERVAL
        return {"processingTime": f"{int(interval.total_seconds() * 1000)} milliseconds"}
