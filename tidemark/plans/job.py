"""A job: tables, views and inserts in order, run as a batch or as a stream."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from typing import Union

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

from tidemark import files
from tidemark.operators.views import align, view
from tidemark.plans.preview import evaluate, preview, preview_statement
from tidemark.plans.snapshots import StreamPreview
from tidemark.session import job_session, shared_dir
from tidemark.sources import changes
from tidemark.sources.messages import split_undecoded
from tidemark.sources.tables import Table, good_rows, read, rows_in_time, write
from tidemark.streaming import savepoints
from tidemark.streaming.handle import JobHandle
from tidemark.streaming.inspect import is_row_wise
from tidemark.streaming.late import Watermark, newest_time
from tidemark.streaming.settings import JobSettings

#: Micro-batches of a keyed table in files between two snapshots.
SNAPSHOT_EVERY = 100

Query = Union[str, Callable[[SparkSession], DataFrame]]


@dataclass(frozen=True)
class View:
    """A named query. The query's column names stay unless ``columns`` is given."""

    name: str
    query: Query
    columns: Sequence[str] | None = None


@dataclass(frozen=True)
class Insert:
    """Write a query's rows into a table.

    On a stream, ``mode`` is Spark's output mode: ``append`` for rows that never change,
    ``update`` for a changing result, which needs a target with keys.

    With ``each_batch`` the query sees every micro-batch as a table of its own. That
    is right when a row's result depends on that row and on static tables only,
    and it allows what Spark refuses on streams: an as-of join with a static history.
    A query whose rows are not each made from one row of the stream is refused.
    """

    target: str
    query: Query
    mode: str = "append"
    each_batch: bool = False

    def __post_init__(self):
        if self.mode not in ("append", "update"):
            raise ValueError(f"insert into {self.target}: mode {self.mode!r}")


class Job:
    """Tables, views and inserts, registered in the order given.

    ``static`` names source tables that a streaming job reads whole, as a batch.
    ``staged`` names sources or views that a batch job computes once, into a table in
    the shared folder, for all inserts to read: worth it where decoding or a join
    comes first, not where each insert can push its filter into the source.
    """

    def __init__(
        self,
        settings: JobSettings,
        statements: Sequence,
        static: Sequence[str] = (),
        staged: Sequence[str] = (),
    ):
        self.settings, self.statements = settings, list(statements)
        self.static, self.staged = set(static), set(staged)
        self.tables: dict[str, Table] = {}
        for table in (s for s in self.statements if isinstance(s, Table)):
            if table.name in self.tables:
                raise ValueError(f"two tables are named {table.name}")
            self.tables[table.name] = table

    # -- names --------------------------------------------------------------

    def bind(
        self,
        session: SparkSession,
        streaming: bool = False,
        given: Mapping[str, DataFrame] | None = None,
        stage: bool = False,
    ) -> SparkSession:
        """Register sources and views in ``session``; ``given`` replaces sources."""
        given = given or {}
        staged = self.staged if stage else set()
        for statement in self.statements:
            if isinstance(statement, Table) and statement.is_source:
                name = statement.name
                rows = given.get(name)
                if rows is None:
                    rows = read(session, statement, streaming and name not in self.static)
                    if statement.undecoded:
                        rows, _ = split_undecoded(rows)
                view(name, self._stage(name, rows) if name in staged else rows)
            elif isinstance(statement, View):
                rows = view(statement.name, evaluate(session, statement.query), statement.columns)
                if statement.name in staged:
                    view(statement.name, self._stage(statement.name, rows))
        return session

    @staticmethod
    def _stage(name: str, rows: DataFrame) -> DataFrame:
        path = shared_dir(rows.sparkSession, f"staged-{name}")
        rows.write.parquet(path)
        return rows.sparkSession.read.schema(rows.schema).parquet(path)

    def inserts(self) -> list[Insert]:
        found = []
        for statement in self.statements:
            if isinstance(statement, Insert):
                if statement.target not in self.tables or not self.tables[statement.target].is_sink:
                    raise ValueError(f"insert into {statement.target}: not a sink of this job")
                if statement.mode == "update" and not self.tables[statement.target].keys:
                    raise ValueError(f"insert into {statement.target}: a changing result needs a table with keys")
                found.append(statement)
            elif not isinstance(statement, (Table, View)):
                raise TypeError(f"a job runs tables, views and inserts; use preview for {statement!r}")
        if not found:
            raise ValueError(f"job {self.settings.name} has no insert")
        return found

    def _session(self, spark: SparkSession) -> SparkSession:
        session = job_session(spark, self.settings.params)
        if self.settings.parallelism:
            session.conf.set("spark.sql.shuffle.partitions", str(self.settings.parallelism))
        if self.settings.catalog:
            session.catalog.setCurrentCatalog(self.settings.catalog)
        for path in self.settings.artifacts:
            session.addArtifacts(path, pyfile=not path.endswith(".jar"))
        if self.settings.bounded:
            session.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
        return session

    # -- runs ---------------------------------------------------------------

    def run(self, spark: SparkSession) -> JobHandle | None:
        """Start the job. A batch is done on return; a stream returns its handle."""
        inserts = self.inserts()
        session = self._session(spark)
        if not self.settings.streaming:
            self._run_batch(session, inserts)
            return None
        handle = self._stream(session, inserts).start()
        if self.settings.attached:
            handle.wait()
        return handle

    def _run_batch(self, session: SparkSession, inserts: Sequence[Insert]) -> None:
        writer = changes.new_writer(self.settings.name)
        given = {
            t.name: good_rows(read(session, t), t, writer, 0)
            for t in self.tables.values()
            if t.is_source and t.undecoded
        }
        self.bind(session, given=given, stage=True)
        for number, insert in enumerate(inserts):
            target = self.tables[insert.target]
            write(evaluate(session, insert.query), target, self._label(writer, number, inserts))

    @staticmethod
    def _label(writer: str, number: int, inserts: Sequence[Insert]) -> str:
        """Two inserts into one table in one job must not share a folder."""
        shared = sum(i.target == inserts[number].target for i in inserts) > 1
        return f"{writer}.{number}" if shared else writer

    def _stream(self, session: SparkSession, inserts: Sequence[Insert]) -> JobHandle:
        checkpoint = self.settings.checkpoint or shared_dir(session, self.settings.name)
        streams = [t for t in self.tables.values() if t.is_source and t.name not in self.static]
        carries = self.settings.restore_from and self.settings.on_mismatch == "carry_state"
        self.bind(session, streaming=True, given=self._after_savepoint(session, streams) if carries else None)
        if any(i.each_batch for i in inserts) and len(streams) != 1:
            raise ValueError("inserts for each batch need exactly one stream")
        for insert in (i for i in inserts if i.each_batch):
            if not is_row_wise(evaluate(session, insert.query), lookups=True):
                raise ValueError(f"insert into {insert.target}: its rows are not made from one row of the stream each")
        results = [None if i.each_batch else evaluate(session, i.query) for i in inserts]
        for insert, df in zip(inserts, results):
            if df is not None:
                align(df, self.tables[insert.target].fields)
                if not df.isStreaming:
                    raise ValueError(f"insert into {insert.target} reads no stream; run it as a batch")
        keeps = [df is not None and not is_row_wise(df) for df in results]
        # Inserts that are row by row share one pass over their source; Spark runs or refuses the others.
        together = [n for n, k in enumerate(keeps) if not k and len(streams) == 1]
        alone = [n for n in range(len(inserts)) if n not in together]
        names = {n: f"insert-{n}" for n in alone}
        # The shared pass also writes what does not decode; without one a query does only that.
        aside = [t for t in streams if t.undecoded and not together]
        stateful = {names[n]: keeps[n] for n in alone}
        stateful.update({f"undecoded-{t.name}": False for t in aside})
        if together:
            stateful["shared"] = False
        if any(t.late for t in streams) and alone:
            raise ValueError("late rows are set apart in a pass row by row; insert into a table and read that with state")
        origin = None
        if carries:
            if together or aside:
                raise ValueError("a job that carries state over has inserts with state only")
            origin = self._carried_origin(session, checkpoint)
        elif self.settings.restore_from:
            origin = savepoints.restore(
                session, self.settings.restore_from, checkpoint, stateful, self.settings.on_mismatch
            )
        writer = self._writer(session, checkpoint, new=origin is not None)
        if origin is not None:
            part_of = {n: "shared" if n in together else names[n] for n in range(len(inserts))}
            for n, insert in enumerate(inserts):
                target = self.tables[insert.target]
                if target.path is not None:
                    mine, theirs = self._label(writer, n, inserts), self._label(origin.writer, n, inserts)
                    last = origin.last.get(part_of[n], -1) if carries else origin.last[part_of[n]]
                    changes.note_restore(session, target.path, mine, theirs, last)
            for table in streams:
                for folder in filter(None, (table.undecoded, table.late)):
                    part = "shared" if together else f"undecoded-{table.name}"
                    changes.note_restore(session, folder, writer, origin.writer, origin.last[part])
            savepoints.seeded(session, checkpoint, origin.savepoint)

        handles: list[JobHandle] = []

        def starter(part: str, df: DataFrame, mode: str, each: Callable[[DataFrame, int], list]):
            def each_noted(batch: DataFrame, batch_id: int) -> None:
                written = each(batch, batch_id)
                handles[0].note_out(part, batch_id, written)
                handles[0].note_last(part)

            def begin():
                return (
                    df.writeStream.queryName(f"{self.settings.name}.{part}")
                    .outputMode(mode)
                    .option("checkpointLocation", f"{checkpoint}/{part}")
                    .trigger(**self.settings.trigger())
                    .foreachBatch(each_noted)
                    .start()
                )

            return begin

        parts = {}
        if together:
            source = streams[0]
            chosen = [(n, inserts[n]) for n in together]

            lateness = Watermark(session, f"{checkpoint}/late-{source.name}", source.lateness)

            def all_inserts(batch: DataFrame, batch_id: int) -> list:
                written = []
                many = len(chosen) > 1 or source.undecoded or source.late
                if many:
                    batch.persist()
                try:
                    rows = good = good_rows(batch, source, writer, batch_id)
                    if source.late:
                        rows = rows_in_time(good, source, writer, batch_id, lateness)
                    inner = self.bind(batch.sparkSession, given={source.name: rows})
                    for n, insert in chosen:
                        df = evaluate(inner, insert.query)
                        written.append(self._write(df, self.tables[insert.target], self._label(writer, n, inserts), batch_id))
                    if source.late:
                        lateness.after(batch_id, newest_time(good, source.event_time))
                finally:
                    if many:
                        batch.unpersist()
                return written

            parts["shared"] = starter("shared", read(session, source, streaming=True), "append", all_inserts)
        for n in alone:
            target, label = self.tables[inserts[n].target], self._label(writer, n, inserts)
            parts[names[n]] = starter(
                names[n],
                results[n],
                inserts[n].mode,
                lambda batch, batch_id, target=target, label=label: [self._write(batch, target, label, batch_id)],
            )
        for table in aside:
            _, bad = split_undecoded(read(session, table, streaming=True))
            parts[f"undecoded-{table.name}"] = starter(
                f"undecoded-{table.name}",
                bad,
                "append",
                lambda batch, batch_id, path=table.undecoded: [
                    (0, changes.write_batch(batch, path, "parquet", writer, batch_id))
                ],
            )
        handles.append(JobHandle(session, self.settings, checkpoint, parts))
        return handles[0]

    def _after_savepoint(self, session: SparkSession, streams: Sequence[Table]) -> dict[str, DataFrame]:
        """The one stream of a job that carries state over, from where the savepoint's job has stopped."""
        savepoint = self.settings.restore_from
        parts = [p for p, last in savepoints.origin(session, savepoint).last.items() if last >= 0]
        if len(streams) != 1 or len(parts) != 1 or streams[0].undecoded:
            raise ValueError("state is carried over between jobs with one part and one stream that decodes whole")
        session.conf.set("job.savepoint", savepoint)
        source = streams[0]
        done = savepoints.done(session, savepoint, parts[0], 0, source.connector == "kafka")
        return {source.name: read(session, source, True, done)}

    def _carried_origin(self, session: SparkSession, checkpoint: str) -> savepoints.Origin | None:
        """None if this checkpoint has been begun from the savepoint already."""
        savepoint, mark = self.settings.restore_from, f"{checkpoint}/{savepoints.SEEDED}"
        if not files.exists(session, mark):
            return savepoints.origin(session, savepoint)
        if files.read_text(session, mark) != savepoint:
            raise ValueError(f"{checkpoint} goes on from another savepoint")
        return None

    @staticmethod
    def _write(df: DataFrame, target: Table, label: str, batch_id: int) -> tuple[int, int | None]:
        """One micro-batch; now and then the folders of a keyed table in files are folded into a snapshot."""
        written = write(df, target, label, batch_id)
        if target.keys and target.path and target.encoding is None and batch_id % SNAPSHOT_EVERY == SNAPSHOT_EVERY - 1:
            changes.snapshot(df.sparkSession, target.path, target.connector, target.fields, target.keys, target.order)
        return written

    def _writer(self, session: SparkSession, checkpoint: str, new: bool = False) -> str:
        """The label of this run: kept in the checkpoint, so restarts go on under it. A restored run has a new one."""
        path = f"{checkpoint}/{savepoints.WRITER}"
        if new or not files.exists(session, path):
            files.write_text(session, path, changes.new_writer(self.settings.name))
        return files.read_text(session, path)

    def preview(self, spark: SparkSession, cap: int | None = None) -> DataFrame:
        """Rows of the one SELECT or insert among the statements, read as a batch; all of them, or up to ``cap``."""
        query = preview_statement(self.statements)
        session = self.bind(self._session(spark))
        return preview(evaluate(session, query), cap)

    def preview_stream(
        self, spark: SparkSession, order: Sequence[str], keys: Sequence[str] = (), folder: str | None = None
    ) -> StreamPreview:
        """Start the one SELECT or insert among the statements as a stream whose result can be looked at.

        Its rows go to a table in ``folder``, by default a new shared one; started again there,
        the stream goes on. A changing result needs the ``keys`` that tell which row replaces
        which. Pages are in the order given.
        """
        query = preview_statement(self.statements)
        session = self.bind(self._session(spark), streaming=True)
        # Columns lose the marks of event time, which belong to the stream.
        fields = StructType([StructField(f.name, f.dataType) for f in evaluate(session, query).schema])
        folder = folder or shared_dir(session, f"{self.settings.name}-preview")
        result = Table("_preview", fields, "parquet", path=f"{folder}/result", keys=tuple(keys), role="sink")
        settings = replace(self.settings, checkpoint=self.settings.checkpoint or f"{folder}/checkpoint")
        named = [s for s in self.statements if isinstance(s, (Table, View))]
        insert = Insert(result.name, query, "update" if keys else "append")
        handle = Job(settings, [*named, result, insert], static=self.static).run(spark)
        if handle is None:
            raise ValueError("a batch is looked at with preview")
        return StreamPreview(handle, result, folder, order)
