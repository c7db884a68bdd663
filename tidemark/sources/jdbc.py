"""Database sinks.

Plain appending is Spark's own JDBC write, at least once. Exactly once goes through a
staging table of the batch: the executors fill it in parallel, then the database itself
takes its rows over and notes the batch number, in one transaction; a keyed write deletes
the old rows there too. A batch whose number is already noted is skipped. Staged rows are
numbered, so those that a repeated task has staged again are taken over once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import files
from tidemark.operators.latest import latest_per_key
from tidemark.session import shared_dir

FLUSH_ROWS = 5000  # rows per round trip when the table does not say
ROW, COPY = "_row", "_copy"


def _plain(options: Mapping[str, str]) -> dict[str, str]:
    if missing := {"url", "dbtable"} - set(options):
        raise ValueError(f"database table without {sorted(missing)}")
    return {"batchsize": str(FLUSH_ROWS), **options}


def append(df: DataFrame, options: Mapping[str, str]) -> None:
    """Add the rows. A retried task may add some twice, as the database sees each partition as a transaction."""
    df.write.format("jdbc").options(**_plain(options)).mode("append").save()


def quoted(name: str, mark: str = '"') -> str:
    return ".".join(mark + part.replace(mark, mark * 2) + mark for part in name.split("."))


def backticked(name: str) -> str:
    return quoted(name, "`")


def quoting(url: str):
    """How the database at ``url`` quotes names."""
    return backticked if url.startswith(("jdbc:mysql:", "jdbc:mariadb:")) else quoted


def staging_name(table: str, writer: str, batch_id: int) -> str:
    """A staging table for each batch of each writer, so that none overwrites another's rows."""
    return f"{table}_staging_{hashlib.sha256(writer.encode()).hexdigest()[:8]}_{batch_id}"


def taken_over(table: str, staging: str, columns: Sequence[str], quote=quoted) -> str:
    """SQL that inserts every staged row once, however often it was staged."""
    listed = ", ".join(quote(c) for c in columns)
    numbered = f"ROW_NUMBER() OVER (PARTITION BY {quote(ROW)} ORDER BY {quote(ROW)}) AS {quote(COPY)}"
    return (
        f"INSERT INTO {quote(table)} ({listed}) SELECT {listed} FROM "
        f"(SELECT {listed}, {numbered} FROM {quote(staging)}) staged WHERE {quote(COPY)} = 1"
    )


def noted(ledger: str, quote=quoted) -> list[str]:
    """SQL that notes the batch; both take the writer first."""
    return [
        f"DELETE FROM {quote(ledger)} WHERE {quote('writer')} = ?",
        f"INSERT INTO {quote(ledger)} ({quote('writer')}, {quote('batch_id')}) VALUES (?, ?)",
    ]


def upsert_statements(
    table: str, staging: str, ledger: str, columns: Sequence[str], keys: Sequence[str], quote=quoted
) -> list[str]:
    """Standard SQL that moves a staged batch into its table; the last one takes (writer, batch)."""
    if not keys or not set(keys) <= set(columns):
        raise ValueError(f"keys {list(keys)} must be columns of the table {list(columns)}")
    same = " AND ".join(
        f"{quote(staging)}.{quote(k)} = {quote(table)}.{quote(k)}" for k in keys
    )
    return [
        f"DELETE FROM {quote(table)} WHERE EXISTS (SELECT 1 FROM {quote(staging)} WHERE {same})",
        taken_over(table, staging, columns, quote),
        *noted(ledger, quote),
    ]


def last_batch(connection, ledger: str, writer: str, quote=quoted) -> int:
    """The newest batch noted for the writer, or -1."""
    query = connection.prepareStatement(
        f"SELECT {quote('batch_id')} FROM {quote(ledger)} WHERE {quote('writer')} = ?"
    )
    query.setString(1, writer)
    rows = query.executeQuery()
    found = rows.getLong(1) if rows.next() else -1
    query.close()
    return found


def move(connection, statements: Sequence[str], writer: str, batch_id: int) -> None:
    """Run the statements as one transaction."""
    connection.setAutoCommit(False)
    try:
        for statement in statements:
            prepared = connection.prepareStatement(statement)
            for place in range(1, statement.count("?") + 1):
                if place == 1:
                    prepared.setString(1, writer)
                else:
                    prepared.setLong(2, batch_id)
            prepared.executeUpdate()
            prepared.close()
        connection.commit()
    except Exception:
        connection.rollback()
        raise


def _connect(df: DataFrame, options: Mapping[str, str]):
    """A connection of the driver program, for statements that move no rows through it."""
    jvm = df.sparkSession._jvm
    properties = jvm.java.util.Properties()
    for name in ("user", "password"):
        if name in options:
            properties.setProperty(name, options[name])
    if "driver" not in options:
        return jvm.java.sql.DriverManager.getConnection(options["url"], properties)
    loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
    connection = loader.loadClass(options["driver"]).newInstance().connect(options["url"], properties)
    if connection is None:
        raise ValueError(f"{options['driver']} does not know the url of {options['dbtable']}")
    return connection


def _fill(df: DataFrame, options: Mapping[str, str]) -> None:
    """Put the rows into a staging table, each with a number that a repeated task gives it again.

    Numbers follow from places in files, which do not change as an order of shuffled rows may.
    """
    folder = shared_dir(df.sparkSession, "staged")
    df.write.parquet(folder)
    try:
        rows = df.sparkSession.read.schema(df.schema).parquet(folder)
        numbered = rows.withColumn(ROW, F.monotonically_increasing_id())
        numbered.write.format("jdbc").options(**options).mode("overwrite").save()
    finally:
        files.remove(df.sparkSession, folder)


def _once(df, options, statements, ledger, writer, batch_id, connect, fill) -> bool:
    """Stage the rows and run ``statements(staging, quote)`` with the note of the batch, unless it is noted."""
    staging = staging_name(options["dbtable"], writer, batch_id)
    quote = quoting(options["url"])
    drop = f"DROP TABLE IF EXISTS {quote(staging)}"
    connection = connect(df, options)
    try:
        new = last_batch(connection, ledger, writer, quote) < batch_id
        if new:
            fill(df, {**options, "dbtable": staging})
            move(connection, statements(staging, quote), writer, batch_id)
        # A run that ended between the transaction and this has left its staging table.
        move(connection, [drop], writer, batch_id)
        return new
    finally:
        connection.close()


def append_once(
    df: DataFrame, options: Mapping[str, str], ledger: str, writer: str, batch_id: int, connect=_connect, fill=_fill
) -> bool:
    """Add the rows, once however often the batch or a task of it is run; false if it was written before.

    The table and the ledger ``(writer, batch_id)`` must exist. Equal rows of a batch all count.
    """
    options = _plain(options)

    def statements(staging: str, quote) -> list[str]:
        return [taken_over(options["dbtable"], staging, df.columns, quote), *noted(ledger, quote)]

    return _once(df, options, statements, ledger, writer, batch_id, connect, fill)


def upsert(
    df: DataFrame,
    options: Mapping[str, str],
    keys: Sequence[str],
    order: Sequence[str],
    writer: str,
    batch_id: int,
    connect=_connect,
    fill=_fill,
) -> bool:
    """Replace the rows of the keys in ``df``; false if this batch was written before.

    ``order`` says which row of a key is newest; those columns are written too. Rows
    with a null key cannot be matched by the database and are refused there by its
    key. The table and the ledger ``<dbtable>_batches(writer, batch_id)`` must exist.
    """
    options = _plain(options)
    table = options["dbtable"]
    ledger = f"{table}_batches"
    newest = latest_per_key(df, keys, order) if order else df

    def statements(staging: str, quote) -> list[str]:
        return upsert_statements(table, staging, ledger, df.columns, keys, quote)

    return _once(newest, options, statements, ledger, writer, batch_id, connect, fill)
