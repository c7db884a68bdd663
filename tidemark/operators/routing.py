"""Split one feed into several outputs by a column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Routes = Mapping[str, Sequence[str]]


def _route(column: str, routes: Routes, rest: str) -> Column:
    seen: dict[str, str] = {}
    for name, values in routes.items():
        for value in values:
            if value in seen:
                raise ValueError(f"{value!r} is routed to both {seen[value]!r} and {name!r}")
            seen[value] = name
    if rest in routes:
        raise ValueError(f"{rest!r} names both a route and the catch-all")
    choice = F.lit(rest)
    for name, values in routes.items():
        choice = F.when(F.col(column).isin(*values), F.lit(name)).otherwise(choice)
    return choice


def with_route(df: DataFrame, column: str, routes: Routes, rest: str = "unrouted") -> DataFrame:
    """Add the column ``route``; rows of no route, nulls included, get ``rest``."""
    return df.withColumn("route", _route(column, routes, rest))


def split_by(df: DataFrame, column: str, routes: Routes, rest: str = "unrouted") -> dict[str, DataFrame]:
    """One ``DataFrame`` per route and one for the rest; each row is in exactly one.

    The routes are plain filters on ``column``, so they reach the scan.
    """
    _route(column, routes, rest)
    parts = {name: df.where(F.col(column).isin(*values)) for name, values in routes.items()}
    every = [value for values in routes.values() for value in values]
    parts[rest] = df.where(F.col(column).isNull() | ~F.col(column).isin(*every)) if every else df
    return parts


def write_routed(df: DataFrame, column: str, routes: Routes, path: str, rest: str = "unrouted") -> None:
    """Write all routes in one pass and without a shuffle, one folder per route.

    Readers of one route prune the other folders.
    """
    with_route(df, column, routes, rest).write.mode("overwrite").partitionBy("route").parquet(path)
