"""Look at a result without writing it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def preview(df: DataFrame, cap: int | None = None) -> DataFrame:
    """All rows, or at most ``cap`` of them; ``is_cut`` tells whether that leaves any out."""
    return df if cap is None else df.limit(cap)


def is_cut(df: DataFrame, cap: int) -> bool:
    """Whether there are more than ``cap`` rows."""
    return not df.offset(cap).isEmpty()


def page(df: DataFrame, order: Sequence[str], number: int, size: int) -> DataFrame:
    """Page ``number`` (from 1) of the rows in the order given, ties by the other columns.

    Spark keeps the first ``number * size`` rows of each task and merges those, so
    the first pages of a large result sort little. Far pages sort more; those of a
    ``Snapshot`` do not.
    """
    check_page(number, size)
    start = (number - 1) * size
    rest = [c for c in df.columns if c not in order]
    return df.orderBy(*order, *rest).offset(start).limit(size)


def check_page(number: int, size: int) -> None:
    if number < 1 or size < 1:
        raise ValueError("pages are numbered from 1 and hold at least one row")


def preview_statement(statements: Sequence) -> "str | callable":
    """The one query to preview: a SELECT given as text or function, or the query of an insert."""
    from tidemark.plans.job import Insert, View
    from tidemark.sources.tables import Table

    inserts = [s for s in statements if isinstance(s, Insert)]
    selects = [s for s in statements if not isinstance(s, (Insert, View, Table))]
    if inserts and selects:
        raise ValueError("preview either a query or an insert, not both")
    if not inserts and not selects:
        raise ValueError("nothing to preview: give a query or an insert")
    if len(inserts) + len(selects) > 1:
        raise ValueError("preview one statement at a time")
    return selects[0] if selects else inserts[0].query


def evaluate(session: SparkSession, query) -> DataFrame:
    """A query is SQL text or a function of the session."""
    return session.sql(query) if isinstance(query, str) else query(session)
